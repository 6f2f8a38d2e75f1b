"""Small document tables with the awkward cases: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import random

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType()),
                     T.StructField("start", T.IntegerType()), T.StructField("id", T.StringType())])


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def awkward(seed=0, n=30):
    """Rows of (doc_id, text, lang, score, start, id); the last three are columns whose names operators use inside."""
    rng = random.Random(seed)
    texts = [prose(rng, rng.choice([3, 25, 60, 120])) for _ in range(n)]
    shared = prose(rng, 40)
    texts += [f"{prose(rng, 10)} {shared} {prose(rng, 5)}", f"{shared} tail", texts[0], texts[0]]
    texts += [None, "", "   ", "one", "Éa  b\tc\nd ", "same " * 50, "<|endoftext|> x", prose(rng, 20_000)]
    rows = [(i, t, "en", None, i, None) for i, t in enumerate(texts)]
    rows.append((None, texts[1], None, 1.0, None, "x"))  # a null id
    rows.append(rows[2])  # a repeated row
    rng.shuffle(rows)
    return rows


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)
