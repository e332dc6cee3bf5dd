"""Versioned model tables, their metadata and the retraining log, all as files of Spark's writers.

A version is published by one small file that is written last. Every run
writes its tables into a folder of its own below the version; the record then
names that folder, the tables, the metadata and the log row, and appears whole
or not at all. Readers go by the records only, so what a run that died has
left is never read, and a version that is written again is the old one until
its new record is there.
"""

from __future__ import annotations

import dataclasses
import json
import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.operators.model import Model

LOG_SCHEMA = (
    "version string, cutoff_ym string, n_users_train bigint, n_users_eval bigint, n_cats bigint, "
    "precision double, recall double, f1 double, hit_rate double, coverage double, artefact string"
)
TABLES = ("popular", "similarity", "factors", "products")
_RECORD = f"version string, attempt string, published_at string, log struct<{LOG_SCHEMA.replace(' ', ': ').replace(',: ', ', ')}>"


def publish_model(
    model: Model,
    metrics: DataFrame,
    model_dir: str,
    version: str,
    cutoff_ym: str | None = None,
    measures: dict | None = None,
) -> str:
    """Write the model's tables and publish them as ``version`` with metadata and log row; returns their folder.

    ``metrics`` is the row of leave-one-out measures; ``measures`` are further
    ones (backtest, cross-validation, the winner of the search) by name.
    """
    spark, attempt = model.popular.sparkSession, uuid.uuid4().hex
    path = _folder(model_dir, version, attempt)
    tables = [n for n in TABLES if getattr(model, n) is not None]
    for name in tables:
        getattr(model, name).write.parquet(f"{path}/{name}")
    metrics.write.parquet(f"{path}/metrics")
    row = metrics.first().asDict()
    measured = {c: row[c] for c in ("precision", "recall", "f1", "hit_rate", "coverage")}
    log = {
        "version": version, "cutoff_ym": cutoff_ym or "full", "n_users_train": model.n_users,
        "n_users_eval": row["n_users"], "n_cats": model.n_cats, **measured, "artefact": f"version={version}",
    }
    published_at = datetime.now(timezone.utc).isoformat(timespec="microseconds")
    metadata = {
        "model_version": version,
        "target": "category_en",
        "algorithm": model.params["method"],
        "parameters": model.params,
        "measures": {"leave_one_out": {**measured, "n_users": row["n_users"]}, **(measures or {})},
        "n_categories": model.n_cats,
        "n_users_train": model.n_users,
        "exported_at": published_at,
        "artefact": f"version={version}",
        "tables": tables,
    }
    record = {"version": version, "attempt": attempt, "published_at": published_at, "log": log, "metadata": metadata}
    one = spark.createDataFrame([(json.dumps(record, ensure_ascii=False),)], "value string").coalesce(1)
    one.write.mode("append").text(f"{model_dir.rstrip('/')}/published")
    return path


def _folder(model_dir: str, version: str, attempt: str) -> str:
    return f"{model_dir.rstrip('/')}/version={version}/attempt={attempt}"


def published(spark: SparkSession, model_dir: str) -> DataFrame:
    """The newest record of every version: version, log (struct) and the record's text."""
    try:
        texts = spark.read.text(f"{model_dir.rstrip('/')}/published")
    except AnalysisException:
        texts = spark.createDataFrame([], "value string")  # nothing has been published
    parsed = texts.select("value", F.from_json("value", _RECORD).alias("r"))
    return (
        parsed.groupBy("r.version")
        .agg(F.max_by(F.struct("value", "r.log"), F.struct("r.published_at", "r.attempt")).alias("newest"))
        .select("version", "newest.log", "newest.value")
    )


def record_of(spark: SparkSession, model_dir: str, version: str | None = None) -> dict:
    """The record of a version (of the newest without one)."""
    records = published(spark, model_dir)
    chosen = records.where(F.col("version") == version) if version else records.orderBy(F.desc("version")).limit(1)
    row = chosen.first()
    if row is None:
        raise ValueError(f"no published version{f' {version}' if version else ''} in {model_dir}")
    return json.loads(row["value"])


def load_model(spark: SparkSession, model_dir: str, version: str | None = None) -> Model:
    """Read a published version back; without one, the newest."""
    record = record_of(spark, model_dir, version)
    path, metadata = _folder(model_dir, record["version"], record["attempt"]), record["metadata"]
    tables = {n: spark.read.parquet(f"{path}/{n}") for n in metadata["tables"]}
    known = {f.name for f in dataclasses.fields(Model)}
    return Model(
        metadata["parameters"],
        n_users=metadata["n_users_train"],
        n_cats=metadata["n_categories"],
        **{n: t for n, t in tables.items() if n in known},
    )


def load_metrics(spark: SparkSession, model_dir: str, version: str) -> DataFrame:
    record = record_of(spark, model_dir, version)
    return spark.read.parquet(f"{_folder(model_dir, version, record['attempt'])}/metrics")


def load_metadata(spark: SparkSession, model_dir: str, version: str | None = None) -> dict:
    """Parameters, measures and sizes of a version."""
    return record_of(spark, model_dir, version)["metadata"]


def read_log(spark: SparkSession, model_dir: str) -> DataFrame:
    """One row per published version."""
    return published(spark, model_dir).select("log.*").orderBy("version")


def latest_version(spark: SparkSession, model_dir: str) -> str:
    return record_of(spark, model_dir)["version"]
