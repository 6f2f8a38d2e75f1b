"""Each operator against a brute-force version on small tables with awkward rows, and on empty tables."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import xxhash
from helpers import DOCS, awkward, frame, prose

from ridepulse.llm import decontaminate, fingerprints, langid, packing, quality, simhash, substrings, toxicity
from ridepulse.llm.fmindex import FMIndex

BLANKS = r"[^\x20\x09-\x0D]+"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


# --- SimHash


def brute_fingerprint(text, shingle=3):
    w = re.findall(BLANKS, lower(text or ""))
    if not w:
        return 0
    parts = [" ".join(w[i:i + shingle]) for i in range(max(1, len(w) - shingle + 1))]
    hs = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_simhash_fingerprints(spark):
    rows = awkward()
    got = simhash.fingerprints(frame(spark, rows)).collect()
    expected = sorted((r[0] is None, r[0] or 0, brute_fingerprint(r[1])) for r in rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.fp & (1 << 64) - 1) for r in got) == expected


def brute_components(values, radius=2):
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= radius:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(values))]


def test_simhash_links_connect_everything_in_reach():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    values = np.unique(np.concatenate([base] + [base ^ np.uint64(1 << int(b)) for b in rng.integers(0, 64, 40)]))
    src, dst = simhash.spanning_links(values, values, True, 2, rows=7)
    assert len(src) < len(values)
    place = {int(v): i for i, v in enumerate(values)}
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in zip(src, dst):
        assert (int(a) ^ int(b)).bit_count() <= 2
        parent[find(place[int(a)])] = find(place[int(b)])
    mine = [find(i) for i in range(len(values))]
    theirs = brute_components([int(v) for v in values])
    assert len(set(zip(mine, theirs))) == len(set(mine)) == len(set(theirs))


def test_simhash_components_over_tiles(spark):
    rng = np.random.default_rng(2)
    values = [int(v) for v in rng.integers(0, 1 << 63, 60, dtype=np.uint64)]
    for v in values[:10]:  # chains: each link within 2 bits, their ends far apart
        for step in range(12):
            v ^= 0b11 << (5 * step)
            values.append(v)
    values = sorted(set(values))
    fps = spark.createDataFrame([(i, int(np.uint64(v).astype(np.int64))) for i, v in enumerate(values)],
                                "doc_id long, fp long")
    low = fps.selectExpr("fp", "struct(false AS none, doc_id AS first, fp AS tie) AS low")
    found = simhash.components(simhash.links(fps.select("fp"), tile=5), low).collect()
    got = {int(np.int64(r.fp).astype(np.uint64)): r.low.first for r in found}
    roots = brute_components(values)
    least = {}
    for i, r in enumerate(roots):
        least[r] = min(i, least.get(r, i))
    assert got == {v: least[roots[i]] for i, v in enumerate(values)}


def test_simhash_deduplicate_keeps_one(spark):
    rows = awkward()
    docs = frame(spark, rows)
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    groups = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect() if r.doc_id is not None}
    assert sorted(i for i in ids if i is not None) == sorted(set(groups.values()))
    assert ids.count(None) == 1
    assert simhash.deduplicate(frame(spark, [])).count() == 0


def test_simhash_deduplicate_keeps_a_row_of_every_group(spark):
    base = [prose(random.Random(k), 60, 5000) for k in range(4)]
    rows = [(5, base[0]), (5, base[1]), (6, base[0]), (None, base[1]), (None, base[2]), (None, base[2]), (9, base[3]),
            (9, base[3]), (None, base[3])]
    docs = spark.createDataFrame([(*r, {"k": 1}) for r in rows], "doc_id long, text string, extra map<string,int>")
    for n in (1, 4):
        got = simhash.deduplicate(docs.repartition(n))
        assert got.columns == docs.columns
        # Both texts of id 5 (two groups) and id 9 once; of the null ids, one row of each group.
        assert sorted(((r.doc_id or 0, r.text) for r in got.collect())) == sorted(
            [(5, base[0]), (5, base[1]), (0, base[1]), (0, base[2]), (9, base[3]), (0, base[3])])


# --- packing


def test_packing_holds_every_id_once(spark, tokenizer):
    from tokenizers import Tokenizer

    rows = awkward()
    out = packing.pack(frame(spark, rows).repartition(5), tokenizer, size=64, open_windows=3, fan_in=2).collect()
    plain = Tokenizer.from_file(tokenizer)
    ids = {r[0]: plain.encode(r[1] or "", add_special_tokens=False).ids + [0] for r in rows}
    times = defaultdict(int)
    for r in rows:
        times[r[0]] += 1
    pieces, sequences = defaultdict(list), defaultdict(list)
    for p in out:
        part = np.frombuffer(p.ids, "<u4").tolist()
        assert part == ids[p.doc_id][p.start:p.start + p.length]
        assert p.ids_crc32 == zlib.crc32(p.ids) and p.doc_tokens == len(ids[p.doc_id])
        pieces[p.doc_id].append((p.start, p.length))
        sequences[p.sequence_id].append((p.offset, p.length))
    for doc, found in pieces.items():
        covered = sorted(x for a, n in found for x in range(a, a + n))
        assert covered == sorted(list(range(len(ids[doc]))) * times[doc])
    sizes = []
    for found in sequences.values():
        at = 0
        for offset, n in sorted(found):
            assert offset == at
            at += n
        sizes.append(at)
    assert all(s <= 64 and s & (s - 1) == 0 for s in sizes)
    assert sum(s != 64 for s in sizes) <= 6
    assert packing.pack(frame(spark, []), tokenizer).count() == 0


def test_chunked_tokenising_equals_whole(tokenizer):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer)
    coder = packing.ChunkTokenizer(tokenizer)
    texts = ["", " ", "  a", "a  b", "a\tb", "a \n b", "\n", " lead", "tail ", "it's we're I'll", "²x ½ y", "日本 語",
             "a<|endoftext|>b", "don't  stop\r\n ok", "x\x1c y", "  a b\u0085c", "é é", "1234 5,6.7", "'s 's"]
    for text, ids in zip(texts, coder.encode(texts)):
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids, text


# --- fingerprints


def test_prefix_hash_spans_and_extensions():
    text = "abracadabra abracadabra!"
    f = fingerprints.Fingerprint(text)
    for a in range(len(text)):
        for b in range(len(text)):
            n = 0
            while a + n < len(text) and b + n < len(text) and text[a + n] == text[b + n]:
                n += 1
            assert fingerprints.common_extension(f.hashes, a, f.hashes, b) == n


def test_next_edit(spark):
    rows = awkward(n=20)
    got = fingerprints.with_next_edit(frame(spark, rows).repartition(7)).collect()
    assert len(got) == len(rows)
    unique = sorted({(r[0], r[1] or "") for r in rows if r[0] is not None}, reverse=True)
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    for k, (doc, text) in enumerate(unique[:-1]):
        if doc == rows[-1][0] or len(by[doc]) > 1:
            continue
        following = unique[k + 1][1]
        n = len(text) // 3
        new = text[:len(text) - n] + following[:n]
        r = by[doc][0]
        assert r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest() and r.n_chars == len(text)
        assert r.fingerprint == str(fingerprints.Fingerprint(text))
        assert r.edited_fingerprint == str(fingerprints.Fingerprint(new))
        assert r.near_edited == fingerprints.likeness(r.fingerprint, r.edited_fingerprint)
        assert r.near_next == fingerprints.likeness(r.fingerprint, str(fingerprints.Fingerprint(following)))
    one = fingerprints.with_next_edit(frame(spark, [(5, "abcdef", None, None, None, None)])).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and one.near_next == 1.0
    assert fingerprints.with_next_edit(frame(spark, [])).count() == 0


# --- substrings


def brute_removed(rows, width):
    """(id, text) -> removed words; rows of one id go by the hash order that the operator states."""
    docs = sorted({((-(1 << 63)) if r[0] is None else r[0], r[2], r[1]) for r in rows})
    seen, gone = {}, {}
    for doc, tie, text in docs:
        w = re.findall(BLANKS, text or "")
        out = set()
        for i in range(len(w) - width + 1):
            key = tuple(w[i:i + width])
            if key in seen:
                out.update(range(i, i + width))
            seen.setdefault(key, (doc, tie, i))
        gone[(doc, tie)] = [x for k, x in enumerate(w) if k not in out], len(w)
    return gone


def test_substrings_against_brute_force(spark):
    rows = awkward()
    docs = frame(spark, rows)
    ties = {(r.doc_id, r.text): r.tie for r in docs.selectExpr("doc_id", "text", "xxhash64(text) AS tie").collect()}
    for width in (5, 20):
        gone = brute_removed([(r[0], r[1], ties[(r[0], r[1])]) for r in rows], width)
        got = substrings.remove_repeats(docs, width=width, shard_bytes=1000)
        assert got.columns == [*docs.columns, "n_words", "n_removed", "removed"]
        got = got.withColumn("tie", got.start * 0).collect()
        left = sorted(" ".join(gone[((-(1 << 63)) if r[0] is None else r[0], ties[(r[0], r[1])])][0]) for r in rows)
        assert sorted(r.text for r in got) == left
        assert all(r.n_words - r.n_removed == len(r.text.split()) for r in got)
    assert substrings.remove_repeats(frame(spark, [])).count() == 0


def phrase_in_contexts(n=400):
    """Documents that share one 4-word phrase in ever different contexts; every tenth repeats a window of the first."""
    rng = np.random.default_rng(3)
    other = lambda k: [f"u{x}" for x in rng.integers(0, 1 << 40, k)]
    first = other(18)
    rows = []
    for i in range(n):
        around = first if i % 10 == 0 else other(18)
        rows.append((i, " ".join([*other(3), *around[:9], "all", "rights", "reserved", "here", *around[9:], *other(3)])))
    return rows


def test_hot_phrase_is_dealt_over_shards(spark, monkeypatch):
    rows = phrase_in_contexts()
    # The phrase is the least group of every window that holds it.
    hashes = {w: substrings._HASHES[w] for w in (b"all", b"rights", b"reserved", b"here")}
    phrase = substrings.group_hashes(np.array(list(hashes.values()), np.uint64), 4)[0]
    real = substrings.group_hashes
    monkeypatch.setattr(substrings, "group_hashes", lambda h, g: (lambda m: np.where(m == phrase, np.uint64(5), m))(real(h, g)))
    hot = frozenset({5 % 640})
    loads, texts = defaultdict(int), {}
    for i, text in rows:
        substrings._fold(((t, (i, 0, s), n, m) for s, n, m, t in substrings.segments(text.encode().split(), 20, 4)), texts, [])
    assert sum(len(t) for t, (_, _, m) in texts.items() if m == 5) > 20_000  # one minimiser holds what a shard may not
    parts = list(substrings._windows(texts, hot, 640, 20))
    assert not any(m == 5 for _, _, m in texts.values())
    for part, _ in parts:
        assert all(len(t.split()) == 20 for t in part)
        for t, (_, _, m) in part.items():
            loads[m % 64] += len(t)
    assert len(loads) == 64 and max(loads.values()) < 3 * sum(loads.values()) / 64


def test_hot_phrases_against_brute_force(spark):
    rows = phrase_in_contexts()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    gone = brute_removed([(i, t, 0) for i, t in rows], 20)
    plain = docs.selectExpr("doc_id AS id", "0L AS tie", "CAST(text AS binary) AS body")
    weights = substrings.segment_weights(plain, width=20, group=4, bins=64).collect()
    assert max(r["bytes"] for r in weights) > 1000  # with shards of 4000 bytes such bins are hot
    for size in (400, 4000, 64 << 20):  # all bins hot, some, none
        got = {r.doc_id: r.text.split() for r in substrings.remove_repeats(docs, shard_bytes=size).collect()}
        assert got == {i: gone[(i, 0)][0] for i, _ in rows}
        assert sum(len(t.split()) for _, t in rows) > sum(map(len, got.values()))


def test_backward_search_counts():
    rng = np.random.default_rng(0)
    pieces = [rng.integers(1, 5, 60) for _ in range(6)]
    text = np.concatenate([np.append(p, 0) for p in pieces])
    index = FMIndex(text, 6)
    starts = np.arange(6) * 61
    at, low, high = index.repeats(text, starts, starts + 54, 6)
    counts = defaultdict(list)
    for i, p in enumerate(pieces):
        for k in range(55):
            counts[tuple(p[k:k + 6])].append(61 * i + k)
    expected = {k: sorted(v) for v in counts.values() if len(v) > 1 for k in v}
    assert {int(a): sorted(index.order[x:y].tolist()) for a, x, y in zip(at, low, high)} == expected


# --- decontamination


def brute_matches(text, items, window):
    table = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))
    w, hit, found = table(text), set(), set()
    for item, body in items:
        b = table(body)
        for i in range(max(1, len(b) - window + 1)) if b else []:
            win = b[i:i + window]
            for k in range(len(w) - len(win) + 1):
                if w[k:k + len(win)] == win:
                    hit.update(range(k, k + len(win)))
                    found.add("null" if item is None else str(item))
    return len(w), len(hit), sorted(found)


def test_decontamination_against_brute_force(spark):
    rows = [r for r in awkward() if r[1] is None or len(r[1]) < 5000]
    long = next(r[1] for r in rows if r[1] and len(r[1].split()) >= 60)
    items = [(1, " ".join(long.split()[5:40])), (2, "W3 w3"), (10, "one"), (3, None), (4, ""), (None, "same same"),
             (1, "Éa b"), (7, " ".join(long.split()[20:34]).upper())]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = frame(spark, rows)
    for size in (8 << 20, 60):  # one block, and several
        got = decontaminate.matches(docs, bench, window=13, block_bytes=size).collect()
        mine = sorted(map(str, ((r.doc_id, r.n_words, r.n_hit, r.hit_items) for r in got)))
        assert mine == sorted(map(str, ((r[0], *brute_matches(r[1], items, 13)) for r in rows)))
    kept = decontaminate.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    bad = [r for r in rows if (m := brute_matches(r[1], items, 13))[1] and 20 * m[1] >= m[0]]
    assert kept.count() == len(rows) - len(bad) and bad
    assert decontaminate.decontaminate(docs, bench.limit(0)).count() == len(rows)
    assert decontaminate.matches(frame(spark, []), bench).count() == 0


def test_longest_match_is_of_one_item(spark):
    a, b = ([f"{x}{k}" for k in range(25)] for x in "ab")
    items = [(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(["z"] * 5 + a[2:16])), (4, "y y"), (None, None)]
    texts = [" ".join(["x", *a[3:23], *b[1:21], "x", *b[2:24]]), " ".join(["x", *a[:20], *b[:20]]), " ".join(a[:14]),
             "x y y y x", "nothing", None]
    expected = [(22, 42, "2", 2), (20, 1, "1", 0), (14, 0, "1", 0), (2, 1, "4", 0), (0, None, None, None),
                (0, None, None, None)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for size in (8 << 20, 60):
        got = decontaminate.matches(docs, bench, block_bytes=size).collect()
        assert [(r.longest_match, r.longest_at, r.longest_item, r.longest_item_at)
                for r in sorted(got, key=lambda r: r.doc_id)] == expected


# --- classifiers


LANGS = {"aa": "la ro mi te su", "bb": "xen kul vor zak pum", "cc": "иде дом лес мир сон"}


def language_rows(n=40):
    import random

    rng = random.Random(3)
    return [(f"{lang}", "".join(rng.choice(s.split()) + rng.choice(["", " "]) for _ in range(80)))
            for lang, s in LANGS.items() for _ in range(n)]


def test_language_id(spark):
    rows = language_rows()
    train = spark.createDataFrame([(l, t) for k, (l, t) in enumerate(rows) if k % 2] + [(None, "x"), ("aa", None)],
                                  "lang string, text string")
    model = langid.fit(train, centroids=2)
    assert set(model["langs"]) == set(LANGS)
    test = spark.createDataFrame([(l, t, 0.5) for k, (l, t) in enumerate(rows) if not k % 2],
                                 "lang string, text string, score double")
    got = langid.predict(test, model).collect()
    assert all(r.lang == r.lang_pred and 0 <= r.score <= 1 for r in got)
    odd = spark.createDataFrame([(None,), ("",), ("12 34 !",), ("ωψχ " * 50,)], "text string")
    none = langid.predict(odd, model).collect()
    assert [r.lang_pred for r in none[:3]] == ["und"] * 3 and all(r.rejected for r in none)
    empty = langid.fit(train.limit(0))
    assert {r.lang_pred for r in langid.predict(test, empty).collect()} == {"und"}
    assert langid.counts("ab " * 300_000).sum() == sum(900_001 - k for k in range(3))  # pieces lose no n-gram


def test_quality_votes(spark):
    good = [("The cat sat on the mat. A dog ran by %s." % ("far " * k), 1) for k in range(30)]
    bad = [("BUY!! NOW!! " * (k + 3), 0) for k in range(30)]
    sample = spark.createDataFrame(good + bad, "text string, label int")
    model = quality.fit(sample, quality.document_frequencies(sample), rank=8)
    docs = spark.createDataFrame([("A bird flew over the house. It sang.",), ("SELL!! IT!! ALL!! NOW!!",), (None,), ("",)],
                                 "text string")
    got = [r.score for r in quality.score(docs, model).collect()]
    assert got[0] > 0.9 and got[1] < 0.1 and got[2] == got[3] and all(0 <= x <= 1 for x in got)
    empty = quality.fit(sample.limit(0), quality.document_frequencies(sample.limit(0)))
    assert {r.score for r in quality.score(docs, empty).collect()} == {0.5}
    assert quality.score(docs.limit(0), model).count() == 0


def test_toxicity(spark):
    import random

    rng = random.Random(4)
    clean = [" ".join(f"{c}{rng.choice('aeiou')}{rng.randrange(9)}lo" for c in rng.choices("bdfgk", k=40)) for _ in range(300)]
    toxic = [f"{t} {rng.choice(['zork', 'blarg'])} grumpf{rng.choice('abc')} grumpf{rng.choice('abc')}" for t in clean[:60]]
    sample = spark.createDataFrame([(t, 0) for t in clean] + [(t, 1) for t in toxic], "text string, label int")
    model = toxicity.fit(sample)
    docs = spark.createDataFrame([(k, t, 9) for k, t in enumerate([toxic[0] + " more", clean[80] + " more", None, ""])],
                                 "doc_id int, text string, predicted int")
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert got[0].predicted == 1 and all(got[k].predicted == 0 for k in (1, 2, 3))
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 3]
    assert {r.predicted for r in kept.collect()} == {9}
    one_sided = toxicity.fit(sample.where("label = 0"))
    assert toxicity.score(docs, one_sided).where("predicted = 1").count() == 0
    assert toxicity.score(docs, toxicity.fit(sample.limit(0))).count() == 4


def test_label_model_recovers_accuracies():
    rng = np.random.default_rng(5)
    truth = rng.random(6000) < 0.2
    votes = np.column_stack([np.where(truth, rng.random(6000) < 0.6, rng.random(6000) < 0.05) for _ in range(3)])
    votes = np.column_stack([votes, votes[:, 0]]).astype(float)  # a copy of the first voter
    votes = np.column_stack([votes, 1 - votes.any(axis=1)])
    real = (votes.T @ truth) / votes.sum(axis=0)
    start = np.clip(real + rng.normal(0, 0.05, 5), 0.01, 0.99)
    accuracy, correlation, post = toxicity.label_model(votes, 0.2, start)
    assert np.abs(accuracy - real).max() < 0.12 and correlation[0, 3] > 0.9 and correlation[0, 1] < 0.3
    # Abstentions carry no weight, so a single vote decides; that still beats the base rate of 0.8.
    assert ((post > 0.5) == truth).mean() > 0.85


def test_word_memory_does_not_change_the_ids(monkeypatch):
    """Chunk by chunk with a memory that is emptied again and again, against whole texts."""
    import random

    import public_tokenizers

    from ridepulse.llm import packing

    monkeypatch.setattr(packing, "CACHE", 60)
    pick = random.Random(7)
    signs = [*"ab'.,\n\n \t\r é9<|", *" " * 6, "<|endoftext|>", "the ", "it's", "un.\nDeux "]
    coder = packing.ChunkTokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    for _ in range(400):
        texts = ["".join(pick.choice(signs) for _ in range(pick.randrange(30))) for _ in range(5)]
        whole = [coder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert [ids.tolist() for ids in coder.encode(texts)] == whole
