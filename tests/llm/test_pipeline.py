"""The corpus pipeline: each stage against brute force on what the stage before has left, and all of them in one run."""

import random
import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pytest
from compare import SF_SMALL
from test_text_operators import BLANKS, brute_fingerprint, brute_removed, lower

from ridepulse.llm import toxicity
from ridepulse.llm.common import stored
from ridepulse.llm.queries import toxicity_model

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def planted(docs, items):
    """Exact and near copies, shared passages, benchmark passages and awkward texts, under ids of their own."""
    rng = random.Random(5)
    word = lambda: f"q{rng.randrange(10**9)}"
    prose = lambda n: " ".join(word() for _ in range(n))
    texts = [r[1] for r in docs if r[1]]
    base, passage = prose(900), prose(60)
    # One changed word, at the first place where that moves one or two bits: a near copy by the stage's contract.
    changed = ([*base.split()[:k], word(), *base.split()[k + 1:]] for k in range(0, 900, 10))
    near = next(w for w in changed if 0 < (brute_fingerprint(" ".join(w)) ^ brute_fingerprint(base)).bit_count() <= 2)
    item = next(t for _, t in items if t and len(re.findall(r"\w+", t)) >= 13)
    new = [texts[0], texts[0], texts[1], base, " ".join(near), f"{prose(30)} {passage} {prose(30)}", f"{passage} {prose(40)}",
           f"{prose(30)} {item} {prose(20)}", f"{item.upper()} {prose(5)}", f"{prose(3000)} {item}", None, "", "  \t ", "one",
           "Éa  b\tc\nd ", prose(4000)]
    rows = [(10_000 + i, t, "en", "planted", len(t or "")) for i, t in enumerate(new)]
    return [*rows, (None, prose(50), None, None, None), rows[5]]  # a null id and a repeated row


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("pipeline"))
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").write.parquet(f"{out}/{name}.parquet")
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{out}/benchmark.parquet").collect()]
    spark.createDataFrame([*docs, *planted(docs, items)], SCHEMA).repartition(5).write.parquet(f"{out}/documents.parquet")
    return out


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """Name -> (rows that the stage got, its result): the stages chained by hand."""
    docs, found = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, sf_dir), f"test-{name}")
        found[name] = ([tuple(r) for r in docs.collect()], out)
        docs = out
    return found


def rows(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def test_columns_between_the_stages(stages):
    for name, _ in corpus_pipeline.STAGES[:-1]:
        out = stages[name][1]
        assert [(f.name, f.dataType.simpleString()) for f in out.schema] == \
            [tuple(c.split()) if "long" not in c else (c.split()[0], "bigint") for c in SCHEMA.split(", ")]


def test_toxic_documents_go(spark, stages, sf_dir):
    got, out = stages["toxicity"]
    docs = spark.createDataFrame(got, SCHEMA)
    scored = toxicity.score(docs, toxicity_model(spark, docs, sf_dir)).collect()
    assert rows(out) == sorted(repr(tuple(r[c] for c in docs.columns)) for r in scored if r.predicted == 0)
    assert set(range(10_000, 10_016)) <= {r.doc_id for r in out.collect()}  # nothing planted is toxic


def test_toxic_documents_go_and_clean_ones_stay(spark):
    larger = SF_SMALL.replace("sf0.001", "sf0.01")  # enough labels to learn from; both counts below are held out
    left = {r.doc_id for r in corpus_pipeline.reject_toxic(spark, spark.read.parquet(f"{larger}/documents.parquet"), larger)
            .select("doc_id").collect()}
    labels = [r for r in spark.read.parquet(f"{larger}/labels.parquet").collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    toxic = [r.doc_id not in left for r in labels if r.toxic == 1]
    clean = [r.doc_id in left for r in labels if r.toxic == 0]
    assert toxic and sum(toxic) >= 0.8 * len(toxic) and sum(clean) >= 0.95 * len(clean), (sum(toxic), len(toxic), sum(clean), len(clean))


def test_one_document_of_each_group_stays(stages):
    got, out = stages["simhash_near_dedup"]
    fps = np.array([brute_fingerprint(r[1]) for r in got], np.uint64)
    group = list(range(len(got)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(got)):
        for j in np.flatnonzero(np.bitwise_count(fps[i + 1:] ^ fps[i]) <= 2) + i + 1:
            a, b = root(i), root(int(j))
            group[max(a, b)] = min(a, b)
    members = defaultdict(list)
    for i in range(len(got)):
        members[root(i), got[i][0] is None].append(got[i][0])  # rows without an id are deduplicated among themselves
    keep = Counter(None if none else min(ids) for (_, none), ids in members.items())
    assert Counter(r.doc_id for r in out.collect()) == keep and len(keep) < len(got)
    left = {r.doc_id for r in out.collect()}
    assert len({10_000, 10_001} & left) == 0 and 10_003 in left and 10_004 not in left


def test_repeated_passages_are_cut(spark, stages):
    got, out = stages["substring_dedup"]
    docs = spark.createDataFrame(got, SCHEMA).selectExpr("*", "xxhash64(text) AS tie").collect()
    gone = brute_removed([(r.doc_id, r.text, r.tie) for r in docs], 20)
    expected = []
    for r in docs:
        kept, n = gone[(-(1 << 63) if r.doc_id is None else r.doc_id, r.tie)]
        cut = len(kept) < n
        expected.append((r.doc_id, " ".join(kept) if cut else r.text, r.lang, r.source, len(" ".join(kept)) if cut else r.n_chars))
    assert rows(out) == sorted(map(repr, expected))
    text = {r.doc_id: r.text for r in out.collect()}
    assert len(text[10_005].split()) == 120 and len(text[10_006].split()) == 40


def test_contaminated_documents_go(spark, stages, sf_dir):
    got, out = stages["benchmark_decontamination"]
    table = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))
    windows = set()
    for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect():
        b = table(r.text)
        windows |= {tuple(b[i:i + 13]) for i in range(max(1, len(b) - 12))} if b else set()
    expected = []
    for r in got:
        w, hit = table(r[1]), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit.update(range(k, k + n))
        if not (hit and 20 * len(hit) >= len(w)):
            expected.append(r)
    assert rows(out) == sorted(map(repr, expected))
    left = {r.doc_id for r in out.collect()}
    assert {10_007, 10_008} & left == set() and 10_009 in left  # the last holds a passage of under a twentieth


def packed(out):
    pieces = defaultdict(list)
    for p in out.collect():
        pieces[p.doc_id].append((p.start, bytes(p.ids)))
    return {d: b"".join(i for _, i in sorted(found)) for d, found in pieces.items()}


def test_everything_left_is_packed(stages, tokenizer):
    from tokenizers import Tokenizer

    got, out = stages["packing"]
    plain = Tokenizer.from_file(tokenizer)
    expected = {r[0]: np.array(plain.encode(r[1] or "", add_special_tokens=False).ids + [0], "<u4").tobytes() for r in got}
    assert len(expected) == len(got) and packed(out) == expected
    ends = defaultdict(int)
    for p in out.collect():
        ends[p.sequence_id] += p.length
    assert all(n <= 1024 and n & (n - 1) == 0 for n in ends.values())


def test_run_is_the_stages_in_order(spark, stages, sf_dir):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "substring_dedup",
                                                      "benchmark_decontamination", "packing"]
    assert packed(corpus_pipeline.run(spark, sf_dir)) == packed(stages["packing"][1])


def test_run_on_empty_documents(spark, sf_dir, tmp_path):
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
