"""Sources and sinks (A2-A5): table scan by suffix, Parquet / CSV sinks, the training
profile (JSON with a default record) and model / encoding persistence."""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Profile returned when none has been written yet.
DEFAULT_PROFILE = {
    "total_shipments": 0, "carriers": "", "service_levels": "", "zones_covered": "",
    "min_date": None, "max_date": None, "features_count": 0, "version": "unknown",
}
PROFILE_SCHEMA = ("total_shipments long, carriers string, service_levels string, zones_covered string, "
                  "min_date date, max_date date, features_count long, version string")


def read_table(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A2: ``.csv`` (header row; explicit schema recommended) or ``.parquet``; anything else
    is rejected."""
    low = path.lower().rstrip("/")
    if low.endswith(".csv"):
        r = spark.read.option("header", True)
        r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
        return r.csv(path)
    if low.endswith(".parquet"):
        r = spark.read
        if schema is not None:
            r = r.schema(schema)
        return r.parquet(path)
    raise ValueError(f"unsupported table format: {path!r} (expected .csv or .parquet)")


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """A3: write the same table as Parquet (``path``.parquet) and CSV (``path``.csv)."""
    for fmt in ("parquet", "csv"):
        w = df.write.mode(mode)
        if partition_by:
            w = w.partitionBy(*partition_by)
        if fmt == "csv":
            w = w.option("header", True)
        w.format(fmt).save(f"{path}.{fmt}")


def write_profile(profile: DataFrame, path: str, version: str = "1.0") -> None:
    """A4 sink: the one-row training profile as JSON."""
    p = profile.withColumn("version", F.lit(version))
    p.select(*[F.col(c) for c in [f.split()[0] for f in PROFILE_SCHEMA.split(", ")]]) \
        .coalesce(1).write.mode("overwrite").json(path)


def read_profile(spark: SparkSession, path: str) -> DataFrame:
    """A4 source: the stored profile, or the default record when none exists."""
    try:
        return spark.read.schema(PROFILE_SCHEMA).json(path)
    except AnalysisException:
        return spark.createDataFrame([tuple(DEFAULT_PROFILE.values())], PROFILE_SCHEMA)


def save_models(models: dict, path: str) -> None:
    """A5 sink: everything as Parquet, one row per tree of an ensemble (``qmodel_*`` hold three each) and
    the encoding tables as they are."""
    for k, v in models.items():
        target = os.path.join(path, k)
        if isinstance(v, DataFrame):
            v.write.mode("overwrite").parquet(target)
            continue
        spark = SparkSession.getActiveSession()
        for i, m in enumerate(v if isinstance(v, list) else [v]):
            m.to_frame(spark).coalesce(1).write.mode("overwrite").parquet(os.path.join(target, str(i)))


def load_models(spark: SparkSession, path: str, keys=("encodings", "serving", "model_time", "model_cost", "qmodel_time",
                                                      "qmodel_cost")) -> dict:
    """A5 source: the artefacts written by :func:`save_models`."""
    from shiplens.operators.boosting import BoostedTrees
    out = {}
    for k in keys:
        target = os.path.join(path, k)
        one = lambda i: BoostedTrees.from_frame(spark.read.parquet(os.path.join(target, str(i))))
        out[k] = [one(i) for i in range(3)] if k.startswith("qmodel_") else one(0) if k.startswith("model_") else spark.read.parquet(target)
    return out
