"""Tables bucketed by a key: parquet folders whose files each hold rows of one hash bucket, so that groupings and joins
on the key need no exchange.

Spark's own bucketing does the work; a table lives in a plain folder, so every other reader sees ordinary parquet. A
marker file in the folder names the key, the number of buckets and the version, and moves into place together with the
data. A read registers that version as an external table and scans it by bucket.

A scan by bucket reads each bucket in one task. The folder listing tells the size of every bucket, so a read whose
largest bucket is over a stated size (one trip with most of the rows), or whose folder holds files of no bucket, takes
the ordinary scan instead: files are split, and the grouping shuffles after combining map-side. The rows are the same.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ridepulse.sources import tables

MAX_BUCKET_BYTES = 1 << 30

_MARKER = re.compile(r"_bucketed\.(?P<key>.+)\.(?P<buckets>\d+)\.(?P<version>[0-9a-f]+)$")
_BUCKET_FILE = re.compile(r"_(\d+)(?:\..*)?$")


class Layout(NamedTuple):
    """What the listing of a bucketed folder tells: bytes by bucket, and whether every data file belongs to one."""

    key: str
    buckets: int
    version: str
    bytes: dict[int, int]
    pure: bool


def _listing(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    p, fs = tables._fs_path(spark, path)
    return [(st.getPath().getName(), st.getLen()) for st in fs.listStatus(p)] if fs.exists(p) else []


def _table(version: str) -> str:
    return f"spark_catalog.default.ridepulse_bucketed_{version}"


def _qualified(spark: SparkSession, path: str) -> str:
    p, fs = tables._fs_path(spark, path.rstrip("/"))
    return fs.makeQualified(p).toString()


def layout(spark: SparkSession, path: str) -> Layout | None:
    """Layout of the bucketed table at ``path`` from one folder listing (None: not a bucketed table)."""
    files = _listing(spark, path)
    marker = next((m for m in (_MARKER.match(name) for name, _ in files) if m), None)
    if marker is None:
        return None
    size, pure = defaultdict(int), True
    for name, length in files:
        if name.startswith(("_", ".")):
            continue
        found = _BUCKET_FILE.search(name)
        if found:
            size[int(found[1])] += length
        else:
            pure = False
    return Layout(marker["key"], int(marker["buckets"]), marker["version"], dict(size), pure)


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """Replace the table at ``path`` by ``df`` in ``buckets`` buckets of ``key``.

    Rows are dealt by the key first, so a task writes few buckets; adaptive execution splits the share of a hot key over
    several tasks, which then write several files of its bucket. The new table is written beside the old one and swapped
    in, as by ``tables.overwrite``. Rows with a null key share a bucket.
    """
    spark, version, path = df.sparkSession, uuid.uuid4().hex[:12], _qualified(df.sparkSession, path)
    old = layout(spark, path) if tables.table_exists(spark, path) else None
    new = f"{path}__new-{version}"
    (df.hint("rebalance", buckets, F.col(key)).write.mode("errorifexists").format("parquet").option("path", new)
     .bucketBy(buckets, key).saveAsTable(_table(version)))
    spark.sql(f"DROP TABLE {_table(version)}")  # an external table: its files stay
    marker, fs = tables._fs_path(spark, f"{new}/_bucketed.{key}.{buckets}.{version}")
    fs.mkdirs(marker.getParent())               # no rows, no folder
    fs.create(marker, False).close()
    tables.swap_in(spark, new, path)
    if old is not None:
        spark.sql(f"DROP TABLE IF EXISTS {_table(old.version)}")


def read_bucketed(spark: SparkSession, path: str, schema: StructType,
                  max_bucket_bytes: int = MAX_BUCKET_BYTES) -> DataFrame:
    """The table at ``path``, scanned by bucket if no bucket is over ``max_bucket_bytes``; otherwise, and where the folder
    holds files of no bucket, by ordinary splits. A table without rows, or none at all, is an empty frame of ``schema``."""
    if not tables.table_exists(spark, path):
        return spark.createDataFrame([], schema)
    path = _qualified(spark, path)
    found = layout(spark, path)
    if found is None or not found.pure or max(found.bytes.values(), default=0) > max_bucket_bytes:
        return spark.read.schema(schema).parquet(path)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_table(found.version)} ({columns}) USING parquet "
              f"CLUSTERED BY (`{found.key}`) INTO {found.buckets} BUCKETS LOCATION '{location}'")
    return spark.table(_table(found.version))
