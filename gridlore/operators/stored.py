"""Trained models in a folder, for use in another session.

A model is one row of facts and some tables. The facts are written last, so a
model that was not written to its end is not loaded. A folder that holds a
model already is refused.
"""
from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession

VERSION = 1


def save_model(
    spark: SparkSession, path: str, kind: str, facts: Mapping[str, Any], tables: Mapping[str, DataFrame]
) -> None:
    """Write a model of some ``kind``; ``facts`` are values or lists of them, none NULL."""
    for name, table in tables.items():
        table.write.parquet(f"{path}/{name}")
    columns = {"kind": kind, "version": VERSION, **facts}
    row = spark.createDataFrame([tuple(columns.values())], list(columns))
    row.coalesce(1).write.parquet(f"{path}/model")


def load_facts(spark: SparkSession, path: str) -> Row:
    """The facts of the model at ``path``, its ``kind`` among them."""
    try:
        facts = spark.read.parquet(f"{path}/model").first()
    except AnalysisException as missing:
        raise ValueError(f"no model at {path}") from missing
    if facts is None or facts["version"] != VERSION:
        raise ValueError(f"the model at {path} is of another version")
    return facts


def load_tables(spark: SparkSession, path: str, *names: str) -> list[DataFrame]:
    return [spark.read.parquet(f"{path}/{name}") for name in names]


def facts_of(spark: SparkSession, path: str, kind: str) -> Row:
    facts = load_facts(spark, path)
    if facts["kind"] != kind:
        raise ValueError(f"the model at {path} is of the kind {facts['kind']}, not {kind}")
    return facts
