"""The registered queries of the text operators, with production parameters, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridepulse.llm import (
    decontaminate, fingerprints, langid, licenses, negatives, packing, pages, quality, runs, simhash, substrings, toxicity, warc)
from ridepulse.llm.common import remainder, table
from ridepulse.llm.labelled import labelled_sample
from ridepulse.session import scratch_path


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from the labelled documents that are not held out."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    train = docs.where((remainder(F.col("doc_id"), 3) != 1) & F.col("lang").isNotNull())
    found = langid.predict(docs.select("doc_id", "text"), langid.fit(train))
    return found.select("doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score", "rejected")


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document (3-word shingles, 2 bits)."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"), shingle=3, radius=2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    return packing.pack(table(spark, sf_dir, "documents", "doc_id", "text"),
                        tokenizer_path("byte_bpe_50k.json"), with_ids=False).drop("ids")


def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and of its edit by the next one, with their likeness."""
    return fingerprints.with_next_edit(table(spark, sf_dir, "documents", "doc_id", "text"))


#: Labelled documents that the classifiers learn from, at most (a bounded sample; see ``labelled_sample``).
QUALITY_SAMPLE, TOXICITY_SAMPLE = 5_000, 12_000


def _held_out():
    return remainder(F.col("doc_id"), 5) == 0


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learnt from labelled documents that are not held out."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    sample = labelled_sample(docs, table(spark, sf_dir, "labels", "doc_id", "quality"), "quality", ~_held_out(),
                             QUALITY_SAMPLE)
    model = quality.fit(sample, quality.document_frequencies(docs))
    return quality.score(docs, model, threshold=0.3).select("doc_id", _held_out().alias("held_out"), "score", "predicted")


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> dict:
    """The toxicity model learnt from the labelled documents among ``docs`` that are not held out."""
    return toxicity.fit(labelled_sample(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"), "toxic", ~_held_out(),
                                        TOXICITY_SAMPLE))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from labelled documents that are not held out."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return toxicity.score(docs, toxicity_model(spark, docs, sf_dir)).select(
        "doc_id", _held_out().alias("held_out"), "score", "predicted")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return pages.extract(table(spark, sf_dir, "pages", "page_id", "url", "html")).withColumn(
        "n_chars", F.char_length("text").cast("long"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that a repeated 20-word window covers, and what is kept."""
    found = substrings.remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"), width=20)
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of every document occurs in the benchmark, and whether the document is contaminated."""
    found = decontaminate.matches(table(spark, sf_dir, "documents", "doc_id", "text"),
                                  table(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "hit_items"), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives, and what reading the archives gives back."""
    folder = scratch_path(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages", "page_id", "url", "html"), folder)
    return warc.read_archive(spark, folder, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


#: Phrases of the base labels, and notices of the method's own; fixed values.
LICENSES = [
    licenses.phrase("cc-by", "cc by"),
    licenses.phrase("gpl", "general public license"),
    licenses.phrase("reserved", "all rights reserved"),
    licenses.notice("agpl", "GNU Affero General Public License", "affero general public license"),
    licenses.notice("apache-2.0", "Licensed under the Apache License, Version 2.0", "apache license", "2 0"),
    licenses.notice("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                           "provided that the following conditions are met", "source and binary forms", "conditions are met"),
    licenses.notice("cc-by-nc", "Licensed under CC BY-NC 4.0", "cc by nc"),
    licenses.notice("cc-by-nd", "Licensed under CC BY-ND 4.0", "cc by nd"),
    licenses.notice("cc-by-sa", "Licensed under CC BY-SA 4.0", "cc by sa"),
    licenses.notice("cc-by", "Creative Commons Attribution 4.0 International License", "creative commons attribution"),
    licenses.notice("cc0", "CC0 1.0 Universal Public Domain Dedication", "cc0"),
    licenses.notice("gpl-2.0", "GNU General Public License, version 2", "general public license", "version 2"),
    licenses.notice("gpl-3.0", "GNU General Public License, version 3", "general public license", "version 3"),
    licenses.notice("lgpl", "GNU Lesser General Public License", "lesser general public license"),
    licenses.notice("mit", "Released under the MIT License", "mit license"),
    licenses.notice("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
                           "and associated documentation files", "hereby granted", "free of charge"),
    licenses.notice("mpl-2.0", "subject to the terms of the Mozilla Public License, v. 2.0", "mozilla public license"),
    licenses.notice("unlicense", "This is free and unencumbered software released into the public domain",
                    "unencumbered software", "public domain"),
]
#: Rare words kept of a notice, and how many of them must stand in place.
LICENSE_ANCHORS, LICENSE_AGREE, LICENSE_SLACK = 4, 3, 2


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and notices in every document."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    entries = licenses.index(LICENSES, licenses.frequencies(docs, LICENSES), anchors=LICENSE_ANCHORS, agree=LICENSE_AGREE)
    found = licenses.scan(docs, entries, slack=LICENSE_SLACK)

    def labels(matches):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["label"]))), ",")

    base = F.filter("matches", lambda m: m["exact"])
    share = F.transform("matches", lambda m: m["in_place"] / m["anchors"])
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda m: m["start"])).cast("long").alias("first_word"),
        F.array_max(F.transform(base, lambda m: m["start"])).cast("long").alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(share), F.lit(0.0)).alias("score"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``docs`` with the texts of every tenth document (by its id's hash) made periodic from some word on.

    With h the crc32 of the id and g = h div 10, the n words of a text with h mod 10 = 0 repeat with period
    p = 1 + floor((n - a) / (3 + g mod 8)) from word a = g mod n on. A document with a null id stays as it is.
    """
    h, n = F.crc32(F.col("doc_id").cast("string").cast("binary")), F.size("w").cast("long")
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    docs = docs.select("doc_id", "text", F.when((h % 10 == 0) & F.col("text").isNotNull(), words).alias("w"),
                       F.floor(h / 10).alias("g"))
    docs = docs.withColumn("a", F.when(n > 0, F.col("g") % n))
    docs = docs.withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)))
    a, p = F.col("a"), F.col("p")
    looped = F.transform("w", lambda w, i: F.when(i < a, w).otherwise(F.get("w", (a + (i - a) % p).cast("int"))))
    return docs.select("doc_id", F.when(a.isNotNull(), F.array_join(looped, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words in every document (four periods and six words at least), and its text without them."""
    docs = with_planted_runs(table(spark, sf_dir, "documents", "doc_id", "text"))
    found = runs.collapse(docs, least=4, shortest=6)
    lines = F.transform("runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "").cast("binary"), 256)
        .alias("runs_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("collapsed_sha256"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth embedding, against all of them."""
    rows = table(spark, sf_dir, "embeddings", "vec_id", "label", "embedding")
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = negatives.whole_vectors(rows.withColumn("label", noisy), id_col="vec_id", label_col="label",
                                   vector_col="embedding", scale=256.0)
    return negatives.mine(rows, F.col("vec_id") % 100 == 0, positives=5, negatives=5, low=80, high=100)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_language_id, op2_simhash_near_dedup, op3_packing, op4_document_fingerprints,
                                op5_quality, op6_html_extraction, op7_substring_dedup, op8_toxicity,
                                op9_benchmark_decontamination, op10_warc, op11_license_scan, op12_periodic_runs,
                                op13_hard_negatives)
}

def _licenses_sql() -> str:
    """The licence scan over the same templates: rare words by document frequency, then places that agree on a start."""
    def text(x: str) -> str:
        return "'" + x + "'"

    rows = ", ".join(f"({t}, {text(x.label)}, {str(x.exact).lower()}, [{', '.join(map(text, x.words))}], "
                     f"[{', '.join(text(' '.join(k)) for k in x.keys)}]::VARCHAR[])" for t, x in enumerate(LICENSES))
    return f"""
WITH t(t, label, exact, words, keys) AS (VALUES {rows}),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
dw AS (SELECT doc_id, i - 1 AS i, w[i] AS word FROM d, unnest(generate_series(1, len(w))) AS s(i)),
tw AS (SELECT t, label, exact, len(words) AS size, i - 1 AS rel, words[i] AS word
       FROM t, unnest(generate_series(1, len(words))) AS s(i)),
df AS (SELECT word, count(DISTINCT doc_id) AS n FROM dw WHERE word IN (SELECT word FROM tw) GROUP BY 1),
a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY t ORDER BY n, word, rel) AS k FROM tw JOIN df USING (word))
      WHERE exact OR k <= {LICENSE_ANCHORS}),
need AS (SELECT t, CASE WHEN exact THEN size ELSE least({LICENSE_AGREE}, size) END AS need, count(*) AS anchors
         FROM a GROUP BY t, exact, size),
c AS (SELECT doc_id, t, i - rel AS start, count(*) AS hits, any_value(need) AS need, any_value(anchors) AS anchors
      FROM dw JOIN a USING (word) JOIN need USING (t) GROUP BY 1, 2, 3 HAVING count(*) >= any_value(need)),
m AS (SELECT c.*, label, exact FROM c JOIN t USING (t) JOIN d USING (doc_id)
      WHERE exact OR len(list_filter(keys, lambda k: len(list_filter(
          generate_series(start - {LICENSE_SLACK}, start + len(words) - 1 + {LICENSE_SLACK}),
          lambda s: s >= 0 AND array_to_string(w[s + 1:s + len(string_split(k, ' '))], ' ') = k)) > 0)) = len(keys)),
g AS (SELECT doc_id, count(*) FILTER (WHERE exact) AS n_base, min(start) FILTER (WHERE exact) AS first_word,
             max(start) FILTER (WHERE exact) AS last_word,
             string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE exact) AS base_labels,
             string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(hits / anchors) AS score FROM m GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0::DOUBLE) AS score
FROM d LEFT JOIN g USING (doc_id)"""


#: Words of a text as the benchmark check takes them, and 13-word windows of a (key, text) relation.
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', " \
         r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE_SQL: dict[str, str] = {
    "op7_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS win
        FROM d, unnest(generate_series(1, len(w) - 19)) AS t(i)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS k FROM win)
          WHERE k > 1),
gone AS (SELECT doc_id, list(DISTINCT i + k) AS cut FROM later, unnest(generate_series(0, 19)) AS t(k) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(cut), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(list_filter(w, lambda x, i: NOT coalesce(list_contains(cut, i), false)), ' ')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id)""",
    "op9_benchmark_decontamination": f"""
WITH b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 12], ' ') AS win, least(len(w), 13) AS n
       FROM b, unnest(generate_series(1, greatest(1, len(w) - 12))) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM bw),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
       FROM d, sizes, unnest(generate_series(1, len(w) - n + 1)) AS t(i)),
hits AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (win, n)),
words_hit AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit
              FROM (SELECT DISTINCT doc_id, i, n FROM hits), unnest(generate_series(0, n - 1)) AS t(k) GROUP BY 1),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                 sha256(string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR))) AS sha
          FROM hits GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(sha, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words_hit USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op10_warc": """
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS hex
           FROM pages),
b AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS keep,
             list_transform(range(40), lambda i: position(hex[i + 1] IN '0123456789abcdef') - 1) AS nib FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
           (((nib[5 * i // 4 + 1] * 16 + coalesce(nib[5 * i // 4 + 2], 0)) >> (3 - (5 * i) % 4)) & 31) + 1]), '')
           AS payload_digest,
       CASE WHEN page_id = keep THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keep THEN keep END AS refers_to, true AS intact
FROM b""",
    "op11_license_scan": _licenses_sql(),
    "op13_hard_negatives": """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
           FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
             CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
      FROM e a, e b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5""",
}
