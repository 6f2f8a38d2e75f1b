"""Licence scan, periodic runs and hard negatives against brute force, with awkward rows and empty tables."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from helpers import awkward, frame, prose
from pyspark.sql import functions as F

from ridepulse.llm import licenses, negatives, queries, runs

# --- periodic runs


def longest_lyndon(s, i):
    best = 1
    for j in range(i + 1, len(s) + 1):
        w = s[i:j]
        if all(w < w[k:] for k in range(1, len(w))):
            best = j - i
    return best


def brute_runs(s, least=4, shortest=6):
    out = []
    for q in range(1, len(s) // least + 1):
        i = 0
        while i + q < len(s):
            if s[i] != s[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(s) and s[j] == s[j + q]:
                j += 1
            m, w = j + q - i, s[i:j + q]
            if m >= max(shortest, least * q) and not any(
                    all(w[x] == w[x + p] for x in range(m - p)) for p in range(1, q)):
                out.append((i, m, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def looped(rng, n, symbols):
    s = [rng.randrange(symbols) for _ in range(n)]
    if n and rng.random() < 0.7:
        a, p = rng.randrange(n), rng.randrange(1, max(2, n // 4))
        s = [x if i < a else s[a + (i - a) % p] for i, x in enumerate(s)]
    return s


def test_lyndon_lengths():
    rng = random.Random(1)
    for _ in range(400):
        s = [rng.randrange(rng.choice([1, 2, 3, 6])) for _ in range(rng.randrange(16))]
        assert runs.lyndon_lengths(s) == [longest_lyndon(s, i) for i in range(len(s))]


@pytest.mark.parametrize("least,shortest", [(4, 6), (2, 2), (3, 9)])
def test_runs_equal_brute_force(least, shortest):
    rng = random.Random(least)
    for _ in range(150):
        texts = [looped(rng, rng.randrange(60), rng.choice([1, 2, 3, 8])) for _ in range(5)]
        got = runs.find_runs([np.array(t, np.int32) for t in texts], least=least, shortest=shortest)
        assert got == [brute_runs(t, least, shortest) for t in texts]


def brute_collapse(words, found):
    gone = {i for s, m, p in found for i in range(s + p, s + m)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_collapse_of_awkward_rows(spark):
    rng = random.Random(3)
    rows = awkward() + [(900 + k, " ".join(f"x{v}" for v in looped(rng, 80, 3)), None, None, k, None) for k in range(20)]
    # A tie in length / period: the smaller start wins, then the smaller period.
    rows += [(950, "a a a a a a b c d e e e e e e", None, None, 0, None), (951, "a b " * 60_000, None, None, 0, None)]
    got = runs.collapse(frame(spark, rows)).collect()
    expected = []
    for r in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")
        found = [(0, 120_000, 2)] if r[0] == 951 else brute_runs(words) if len(words) < 2000 else []
        best = min(found, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=None)
        expected.append((r[0] or -1, len(words), tuple(found), best, brute_collapse(words, found)))
    assert sorted(map(repr, expected)) == sorted(
        repr((r.doc_id or -1, r.n_words, tuple(map(tuple, r.runs)), r.best and tuple(r.best), r.text)) for r in got)
    assert runs.collapse(frame(spark, [])).count() == 0


def test_periodic_runs_query_on_a_fixture(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, prose(rng, rng.randrange(0, 120), 30), "en", None, None, None) for i in range(200)]
    rows += [(1000, None, None, None, None, None), (1001, "", None, None, None, None), rows[7]]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    expected = []
    for doc_id, text, *_ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        found = brute_runs(words)
        best = min(found, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=(None,) * 3)
        expected.append((doc_id, len(found), *best, None if best[0] is None else 1000 * best[1] // best[2],
                         hashlib.sha256("".join("%d,%d,%d\n" % r for r in found).encode()).hexdigest(),
                         hashlib.sha256(brute_collapse(words, found).encode()).hexdigest()))
    got = [tuple(r) for r in queries.op12_periodic_runs(spark, str(tmp_path)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))
    assert sum(r[1] > 0 for r in got) > 3


# --- licence scan

TEMPLATES = [licenses.phrase("cc-by", "cc by"), licenses.phrase("rep", "x x x"),
             licenses.notice("note", "one two three four five six", "three four"), licenses.notice("short", "Zeta")]


def brute_scan(rows, templates, slack=2, anchors=4, agree=3):
    texts = [licenses.split_words(r[1] or "") for r in rows]
    df = {w: sum(w in t for t in texts) for t in templates for w in t.words}
    out = []
    for r, w in zip(rows, texts):
        found = []
        for t in templates:
            places = sorted((df[x], x, i) for i, x in enumerate(t.words))
            kept = places if t.exact else [p for p in places if p[0]][:anchors]
            need = len(t.words) if t.exact else min(agree, len(t.words))
            for s in range(-len(t.words), len(w)):
                n = sum(0 <= s + i < len(w) and w[s + i] == x for _, x, i in kept)
                keys = all(any(b >= 0 and w[b:b + len(k)] == k for b in range(s - slack, s + len(t.words) + slack))
                           for k in t.keys)
                if kept and len(kept) >= need and n >= need and (t.exact or keys):
                    found.append((t.label, t.exact, s, n, len(kept)))
        out.append((r[0], len(w), found))
    return out


def test_license_scan_equals_brute_force(spark):
    rng = random.Random(5)
    vocabulary = "cc by x one two three four five six Zeta filler CC-BY é".split()
    rows = awkward() + [(500 + k, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 60))), None, None, k, None)
                        for k in range(60)]
    rows += [(600 + k, "words before One two, THREE four five! six after", None, None, k, None) for k in range(5)]
    rows += [(700, "three four five six", None, None, 0, None), (701, "one two three gap four five six", None, None, 0, None),
             (702, "cc by " * 20_000, None, None, 0, None), (703, "x " * 9, None, None, 0, None)]
    docs = frame(spark, rows)
    entries = licenses.index(TEMPLATES, licenses.frequencies(docs, TEMPLATES))
    got = licenses.scan(docs, entries).collect()
    expected = brute_scan(rows, TEMPLATES)
    assert sorted(repr((r.doc_id, r.n_words, [tuple(m) for m in r.matches])) for r in got) == sorted(map(repr, expected))
    assert any(m[0] == "note" for _, _, found in expected for m in found)


def test_license_scan_without_rows_or_templates(spark):
    empty = frame(spark, [])
    assert licenses.frequencies(empty, TEMPLATES) == {}
    assert licenses.scan(empty, licenses.index(TEMPLATES, {})).count() == 0
    docs = frame(spark, awkward())
    assert all(r.matches == [] for r in licenses.scan(docs, []).collect())
    named = docs.select("doc_id", "text", F.lit("a").alias("w"), F.lit(1).alias("matches"), F.lit(2).alias("n_words"))
    entries = licenses.index(TEMPLATES, licenses.frequencies(named, TEMPLATES))
    assert licenses.scan(named, entries).columns == ["doc_id", "n_words", "matches"]
    with pytest.raises(ValueError):
        licenses.frequencies(docs, TEMPLATES * 200)


# --- hard negatives

VECTORS = "vec_id long, label int, v array<double>, score double, `group` int, block string"


def brute_mine(rows, chosen, positives=5, negs=5, low=80, high=100):
    kept = {}
    for i, label, v, *_ in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        key = (label, [int(np.floor(256 * x)) for x in v])
        kept[i] = min(kept.get(i, key), key)

    def dot(a, b):
        return sum(x * y for x, y in zip(a, b))

    out = []
    for a, (label, v) in kept.items():
        if not chosen(a):
            continue
        scores = sorted(((-dot(v, w), i, other) for i, (other, w) in kept.items() if i != a))
        for p, i, _ in [s for s in scores if s[2] == label][:positives]:
            window = [(-s, j) for s, j, other in scores if other != label and low * -p <= 100 * -s <= high * -p][:negs]
            out += [(a, i, k + 1, j, -p, s) for k, (s, j) in enumerate(window)]
    return sorted(out)


@pytest.mark.parametrize("seed", [0, 1])
def test_hard_negatives_equal_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(4, 12)) * seed
    rows = [(int(i), int(rng.integers(0, 4)), [float(x) for x in rng.normal(size=12) + centre[i % 4]], None, 1, "b")
            for i in range(240)]
    rows += [(300 + i, i % 2, rows[5][2], None, 1, "b") for i in range(40)]  # many copies of one vector
    rows += [(400, 3, [], None, 1, "b"), (401, 3, [0.0] * 12, None, 1, "b"), (402, 7, [1.0] * 12, None, 1, "b"),
             (403, None, [1.0], None, 1, "b"), (404, 1, None, None, 1, "b"), (405, 1, [None, 1.0], None, 1, "b"),
             (406, 1, [float("nan")], None, 1, "b"), (407, 1, [float("inf")], None, 1, "b"), (None, 1, [1.0], None, 1, "b"),
             (410, 2, [1.0, 2.0], None, 1, "b"), rows[0], rows[20], (20, 0, [3.0] * 12, None, 1, "b")]
    df = negatives.whole_vectors(spark.createDataFrame(rows, VECTORS), id_col="vec_id", label_col="label", vector_col="v")
    got = sorted(tuple(r) for r in negatives.mine(df, F.col("vec_id") % 10 == 0).collect())
    assert got == brute_mine(rows, lambda i: i % 10 == 0)
    assert got


def test_hard_negatives_of_empty_tables(spark):
    empty = spark.createDataFrame([], VECTORS)
    df = negatives.whole_vectors(empty, id_col="vec_id", label_col="label", vector_col="v")
    assert negatives.mine(df, F.col("vec_id") % 10 == 0).count() == 0
    one = spark.createDataFrame([(0, 1, [1.0], None, 0, "b")], VECTORS)
    df = negatives.whole_vectors(one, id_col="vec_id", label_col="label", vector_col="v")
    assert negatives.mine(df, F.col("vec_id") % 10 == 0).count() == 0


def test_norm_index_finds_every_pair():
    rng = np.random.default_rng(2)
    rows, asked = rng.integers(-200, 200, (300, 20)), rng.integers(-200, 200, (70, 20))
    rows[:40, 5:] = 0
    exact = asked @ rows.T
    for threshold in (0, 30_000, 120_000, 10 ** 9):
        low = np.full(len(asked), threshold) + rng.integers(0, 5_000, len(asked))
        index = negatives.NormIndex(rows, np.sqrt((asked.astype(float) ** 2).sum(axis=1)).max(), low.min())
        a, r, score = index.join(asked, low)
        assert set(zip(a.tolist(), r.tolist())) == set(zip(*map(np.ndarray.tolist, np.nonzero(exact >= low[:, None]))))
        assert (score == exact[a, r]).all()
    big = np.array([[2 ** 40, 3]])
    assert negatives.exact_products(big, np.array([[2 ** 20, 1]]), np.array([0]), np.array([0])).tolist() == [2 ** 60 + 3]
