"""Small helpers shared by the text operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridepulse.session import scratch_path

#: Rows and bytes of one Arrow batch handed to a Python task; long texts fill a batch by bytes first.
BATCH_ROWS = 1000
BATCH_BYTES = 32 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of the Python stages of this session, whatever the length of the texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A table of ``sf_dir``, narrowed to ``columns`` so that the scan reads only those."""
    bounded_batches(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def remainder(id_col: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % n


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def free_name(taken: list[str], name: str) -> str:
    """``name``, lengthened until no column of ``taken`` has it (names are told apart as Spark does by default)."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name += "_"
    return name


def texts(column: pa.Array) -> list[bytes | None]:
    """Python values of an Arrow column (binary columns give bytes, without decoding)."""
    return column.to_pylist()


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of ``arange(start, start + length)`` for each pair."""
    lengths = np.asarray(lengths, np.int64)
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    return np.arange(total, dtype=np.int64) - np.repeat(first - np.asarray(starts, np.int64), lengths)


def split_points(df: DataFrame, key: str, n: int, sample: int = 20_000) -> np.ndarray:
    """At most ``n - 1`` sorted cut points of an integer key, equal on every run over the same rows.

    The points are quantiles of the rows whose key hash falls under a threshold that leaves about ``sample`` of
    them, or 20 for each range if that is more; only those keys come to the driver. They steer how rows are dealt out
    and never decide a result.
    """
    sample = max(sample, 20 * n)
    keys = df.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("k"))
    total = keys.count()
    rate = min(1.0, sample / max(1, total))
    picked = keys.where(F.pmod(F.xxhash64("k"), F.lit(1 << 20)) < int(rate * (1 << 20)) + 1).distinct()
    got = np.sort(np.array([r.k for r in picked.limit(4 * sample).collect()], np.int64))
    if len(got) < 2 or n < 2:
        return np.zeros(0, np.int64)
    return np.unique(got[(np.arange(1, n) * len(got)) // n])
