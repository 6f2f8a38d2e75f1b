"""Hot keys: one vehicle / trip / route holding a third of all rows still gives the oracle's answers.

The skewed table is derived from the driver's sf0.001 events (every third event is reassigned to user 0),
written to a scratch folder, and both engines run the registered query on it.
"""

import tempfile

import pytest

import __spark_entry__ as entry_mod
from ridepulse.plans.catalog import QUERIES as CORE
from compare import compare
from compare import SF_SMALL

HOT_QUERIES = sorted(n for n in CORE
                     if not n.startswith(("stream", "refresh", "warehouse")))


@pytest.fixture(scope="module")
def skewed_dir(spark):
    from pyspark.sql import functions as F
    out = tempfile.mkdtemp(prefix="rp-skew-")
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    hot = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    hot.coalesce(1).write.parquet(f"{out}/events.parquet")
    return out


@pytest.mark.parametrize("name", HOT_QUERIES)
def test_hot_key_matches_oracle(spark, duck, skewed_dir, name):
    duck.execute(f"CREATE OR REPLACE VIEW events AS SELECT * FROM read_parquet('{skewed_dir}/events.parquet/*.parquet')")
    try:
        problems = compare(entry_mod.queries()[name](spark, skewed_dir), duck, entry_mod.oracle_sql()[name])
    finally:
        duck.execute(f"CREATE OR REPLACE VIEW events AS SELECT * FROM read_parquet('{SF_SMALL}/events.parquet')")
    assert not problems, problems
