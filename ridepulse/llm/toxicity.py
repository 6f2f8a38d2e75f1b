"""Toxicity by weak supervision.

Many small voters look at a text: lexicon voters (does one of a few words occur?) and pattern voters (is a word
beginning dense in the text?). Their words and beginnings are found by counting terms of a bounded labelled sample on
Spark. A voter says "toxic" or abstains; one more voter, silence, speaks when all abstain. A generative label model
estimates by expectation-maximisation how often each voter is right, and from what remains correlated between two
voters given the label, how far their votes count double. Its posterior labels train a linear classifier on the voters'
counts and densities, which scores every text.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridepulse.llm.common import arrow_schema, bounded_batches, free_name

_WORD = re.compile(r"[^\W\d_]+")
#: Lengths of the word beginnings that pattern voters look for, and the share of words that makes one dense.
BEGINNINGS = (4, 5, 6, 7)
DENSE = 0.008


def words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def candidate_terms(sample: DataFrame, *, least_ratio: float = 25.0, least_support: float = 0.006,
                    lexicon: int = 60, patterns: int = 24) -> tuple[list[str], list[str], float]:
    """Words that occur in, and word beginnings that are dense in, toxic texts more than in others, and the base rate.

    Counts run on Spark over all rows of ``sample`` (``text``, ``label``); only the strongest terms come back.
    """
    schema = T.StructType([T.StructField("kind", T.StringType()), T.StructField("term", T.StringType()),
                           T.StructField("toxic", T.LongType()), T.StructField("clean", T.LongType())])
    target = arrow_schema(schema)

    def count(batches):
        seen: dict[tuple[str, str], list[int]] = {}
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = Counter(words(text))
                n = sum(found.values())
                keys = {("word", w) for w in found}
                heads: Counter = Counter()
                for w, c in found.items():
                    for k in BEGINNINGS:
                        if len(w) >= k:
                            heads[w[:k]] += c
                keys.update(("head", h) for h, c in heads.items() if c >= 2 and c >= DENSE * n)
                for key in keys:
                    seen.setdefault(key, [0, 0])[1 - label] += 1
            if len(seen) > 300_000:
                yield _counts(seen, target)
                seen = {}
        yield _counts(seen, target)

    sizes = sample.groupBy("label").count().collect()
    totals = {r.label: r["count"] for r in sizes}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    if not n1 or not n0:
        return [], [], 0.5 if not n1 + n0 else n1 / (n1 + n0)
    ratio = ((F.col("toxic") + 0.5) / (n1 + 1)) / ((F.col("clean") + 0.5) / (n0 + 1))
    strong = (sample.select("text", "label").mapInArrow(count, schema).groupBy("kind", "term")
              .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
              .where((F.col("toxic") >= max(3, least_support * n1)) & (ratio >= least_ratio))
              .withColumn("weight", F.col("toxic") * F.log(ratio)).orderBy(F.desc("weight"), "kind", "term"))
    chosen = [r.term for r in strong.where("kind = 'word'").limit(lexicon).collect()]
    heads: list[str] = []
    for r in strong.where("kind = 'head'").limit(20 * patterns).collect():
        if len(heads) < patterns and not any(r.term.startswith(h) or h.startswith(r.term) for h in heads):
            heads.append(r.term)
    return chosen, heads, n1 / (n1 + n0)


def _counts(seen: dict, target: pa.Schema) -> pa.RecordBatch:
    keys = list(seen)
    return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()),
                                       pa.array([k[1] for k in keys], pa.string()),
                                       pa.array([seen[k][0] for k in keys], pa.int64()),
                                       pa.array([seen[k][1] for k in keys], pa.int64())], schema=target)


class Voters:
    """Lexicon and pattern voters over a list of words and of word beginnings."""

    def __init__(self, lexicon: list[str], heads: list[str], lexicons: int = 20):
        self.lexicon = {w: k % lexicons for k, w in enumerate(lexicon)}  # dealt out by strength
        self.n_lexicons = min(lexicons, len(lexicon))
        self.heads = {h: k for k, h in enumerate(heads)}
        self.lengths = sorted({len(h) for h in heads})
        self.n = self.n_lexicons + len(heads)

    def read(self, text: str | None) -> tuple[np.ndarray, int]:
        """Hits of each voter and the number of words."""
        found = words(text)
        hits = np.zeros(self.n)
        for w in self.lexicon.keys() & set(found):
            hits[self.lexicon[w]] += found.count(w)
        for k in self.lengths:
            heads = Counter(w[:k] for w in found)
            for h in heads.keys() & self.heads.keys():
                if len(h) == k:
                    hits[self.n_lexicons + self.heads[h]] += heads[h]
        return hits, len(found)

    def votes(self, hits: np.ndarray, n_words: np.ndarray) -> np.ndarray:
        """1 where a voter says toxic, else 0; the last column is silence."""
        fired = hits > 0
        dense = (hits >= 2) & (hits >= DENSE * n_words[:, None])
        fired[:, self.n_lexicons:] = dense[:, self.n_lexicons:]
        return np.column_stack([fired, ~fired.any(axis=1)]).astype(float)

    def features(self, hits: np.ndarray, n_words: np.ndarray) -> np.ndarray:
        """Votes, log counts and densities, and what the lexicons and the patterns say together."""
        rate = np.minimum(100 * hits / np.maximum(n_words, 1)[:, None], 5.0)
        lex, pat = hits[:, :self.n_lexicons].sum(axis=1), rate[:, self.n_lexicons:].max(axis=1, initial=0)
        return np.column_stack([self.votes(hits, n_words), np.log1p(hits), rate, np.log1p(lex), pat])


def label_model(votes: np.ndarray, base: float, start: np.ndarray, rounds: int = 25, anchor: float = 8.0):
    """Accuracies, correlations and posterior labels from the votes.

    ``start`` holds each voter's share of toxic texts among those it fires on, from the labelled sample; it enters
    with ``anchor`` times the weight of the posterior labels, which alone would drift to certainty. Of the voters that fire on a text the strongest counts in full, and each
    further one only by what is not correlated with the stronger ones given the label.
    """
    n = votes.shape[1]
    accuracy, correlation = start.copy(), np.zeros((n, n))
    prior = np.log(base / (1 - base))
    post = np.full(len(votes), base)
    for _ in range(rounds):
        odds = np.log(accuracy / (1 - accuracy)) - prior
        rank = np.argsort(np.argsort(-np.abs(odds), kind="stable"), kind="stable")
        share = np.where(rank[:, None] < rank[None, :], np.log(1 - np.minimum(correlation, 0.999)), 0.0)
        post = 1 / (1 + np.exp(-np.clip(prior + (votes * np.exp(votes @ share)) @ odds, -30, 30)))
        fired = votes.sum(axis=0)
        new = np.clip((votes.T @ post + anchor * fired * start) / ((1 + anchor) * fired + 1e-9), 0.001, 0.999)
        # Residuals given the label: what two voters share beyond it.
        toxic = (votes * post[:, None]).sum(axis=0) / max(post.sum(), 1e-9)
        clean = (votes * (1 - post)[:, None]).sum(axis=0) / max((1 - post).sum(), 1e-9)
        rest = votes - (post[:, None] * toxic + (1 - post)[:, None] * clean)
        spread = np.sqrt((rest ** 2).mean(axis=0)) + 1e-9
        correlation = np.clip((rest.T @ rest) / len(votes) / np.outer(spread, spread), 0, 1)
        np.fill_diagonal(correlation, 0)
        moved = np.abs(new - accuracy).max()
        accuracy = new
        if moved < 1e-5:
            break
    return accuracy, correlation, post


def logistic(x: np.ndarray, target: np.ndarray, ridge: float = 1.0, rounds: int = 30):
    """Linear classifier for soft labels by Newton steps."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    penalty = np.full(z.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p) + 1e-6)[:, None]).T @ z + np.diag(penalty),
                               z.T @ (target - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1] / scale, float(w[-1] - (w[:-1] * mean / scale).sum())


def fit(sample: DataFrame) -> dict:
    """The model from a bounded labelled sample (``text``, ``label``). Without both labels it scores the base rate."""
    bounded_batches(sample.sparkSession)
    lexicon, heads, base = candidate_terms(sample)
    voters = Voters(lexicon, heads)
    base = min(max(base, 0.001), 0.999)
    model = {"voters": voters, "weights": None, "bias": float(np.log(base / (1 - base)))}
    if not voters.n:
        return model
    schema = T.StructType([T.StructField("label", T.IntegerType()), T.StructField("words", T.LongType()),
                           T.StructField("hits", T.ArrayType(T.DoubleType()))])
    target = arrow_schema(schema)

    def read(batches):
        for batch in batches:
            got = [voters.read(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([g[1] for g in got], pa.int64()),
                                              pa.array([g[0].tolist() for g in got], target.field(2).type)],
                                             schema=target)

    rows = sorted(sample.select("text", "label").mapInArrow(read, schema).collect())
    hits, n = np.array([r.hits for r in rows]), np.array([r.words for r in rows])
    label = np.array([r.label for r in rows], float)
    votes = voters.votes(hits, n)
    start = np.clip((votes.T @ label + 2 * base) / (votes.sum(axis=0) + 2), 0.001, 0.999)
    accuracy, correlation, post = label_model(votes, base, start)
    weights, bias = logistic(voters.features(hits, n), post)
    return model | {"weights": weights, "bias": bias, "accuracy": accuracy, "correlation": correlation}


def score(docs: DataFrame, model: dict, *, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: toxic is likelier) and ``predicted`` (1 from ``threshold`` on).

    Null and empty texts are texts without words. Rows are neither merged nor dropped; columns with the added names
    are replaced.
    """
    bounded_batches(docs.sparkSession)
    added = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    own = [f for f in docs.schema.fields if f.name not in ("score", "predicted")]
    schema = T.StructType([*own, *added])
    target = arrow_schema(schema)
    body_name = free_name(schema.names, "text_in")
    source = docs.select(*[F.col(f"`{f.name}`") for f in own], F.col(f"`{text_col}`").cast("string").alias(body_name))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        voters: Voters = m["voters"]
        for batch in batches:
            got = [voters.read(t) for t in batch.column(body_name).to_pylist()]
            linear = np.full(len(got), m["bias"])
            if m["weights"] is not None and got:
                linear = linear + voters.features(np.array([g[0] for g in got]), np.array([g[1] for g in got])) @ m["weights"]
            values = 1 / (1 + np.exp(-np.clip(linear, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name).cast(target.field(f.name).type) for f in own] +
                [pa.array(values, pa.float64()), pa.array((values >= threshold).astype(np.int32))], schema=target)

    return source.mapInArrow(run, schema)


def keep_clean(docs: DataFrame, model: dict, *, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` without those the model rejects; the columns stay as they are."""
    marked = docs.withColumn("row__in", F.struct(*[F.col(f"`{c}`") for c in docs.columns])) \
        .select("row__in", F.col(f"`{text_col}`").alias("text__of"))
    kept = score(marked, model, text_col="text__of", threshold=threshold).where("predicted = 0")
    return kept.select(*[F.col(f"row__in.`{c}`").alias(c) for c in docs.columns])
