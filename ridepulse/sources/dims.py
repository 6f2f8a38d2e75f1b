"""Small dimension tables (bounded size by construction, safe to broadcast)."""

from __future__ import annotations

import csv
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridepulse.functions.columns import BAND_EDGES, CATEGORIES, TREND_LABELS


def delay_bands(spark: SparkSession) -> DataFrame:
    """The six delay bands: category, display order (early first), severity rank (critical first) and the
    inclusive upper bound in seconds (null for early = below zero and for critical = unbounded)."""
    uppers = {"early": -1, **dict(BAND_EDGES), "critical": None}
    rows = [(c, i + 1, len(CATEGORIES) - 1 - i, uppers[c]) for i, c in enumerate(CATEGORIES)]
    return spark.createDataFrame(rows, "category string, display_order int, severity_rank int, upper_seconds int")


def trend_labels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(t,) for t in TREND_LABELS], "trend string")


def fixture_route_descriptions(spark: SparkSession, n_codes: int = 40, skip_mod: int = 7) -> DataFrame:
    """Rule-built description table for the test routes ``R0`` .. ``R{n-1}``; codes with
    ``k % skip_mod == 3`` are left out so that lookups also miss."""
    k = F.col("id")
    return (spark.range(n_codes).where(k % skip_mod != 3)
            .select(F.concat(F.lit("R"), k.cast("string")).alias("route_code"),
                    F.concat(F.lit("Stop "), k.cast("string"), F.lit(" - Stop "),
                             (k + n_codes).cast("string")).alias("description")))


# The published route descriptions (route code -> "origin - destination", 119 rows), kept
# verbatim and in their published order in route_descriptions.csv next to this module.
PUBLISHED_ROUTE_DESCRIPTIONS = os.path.join(os.path.dirname(os.path.abspath(__file__)), "route_descriptions.csv")


def _published_rows() -> list[tuple[str, str]]:
    with open(PUBLISHED_ROUTE_DESCRIPTIONS, encoding="utf-8", newline="") as fh:
        return [(r["route_code"], r["description"]) for r in csv.DictReader(fh)]


def published_route_descriptions(spark: SparkSession) -> DataFrame:
    """The published 119-row route description table (a fixed dimension read on the driver: it is bundled
    with the package, not stored on the cluster's file system)."""
    return spark.createDataFrame(_published_rows(), "route_code string, description string")


def published_route_codes() -> list[str]:
    """The codes of the published table in their published order."""
    return [code for code, _ in _published_rows()]


def route_descriptions(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Route descriptions (``route_code``, ``description``) from a CSV/parquet table on the cluster's file
    system; without a path, the published table."""
    if path is None:
        return published_route_descriptions(spark)
    if path.endswith(".csv"):
        return spark.read.csv(path, header=True, schema="route_code string, description string")
    return spark.read.parquet(path).select("route_code", "description")
