"""Reading and writing tables, the keyed upsert, counts and probes."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import KEEP_FIRST, NODES, TABLES

_own: list[str] = []


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the folder that driver and executors share (spark.checkpoint.dir; a local one where unset)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not _own:
            _own.append("file://" + tempfile.mkdtemp(prefix="spark-"))
        base = _own[0]
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str, **options: str) -> DataFrame:
    path, schema = scratch(df.sparkSession, label), df.schema
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def read_raw_nodes(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Nested JSON nodes, one a line, of all pages below path; a line that doesn't parse has its text in _corrupt."""
    return spark.read.schema(NODES[kind] + ", _corrupt string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)


def load_tables(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return {name: spark.read.schema(s).parquet(f"{path}/{name}") for name, s in TABLES.items()}


def decided(sets: DataFrame) -> DataFrame:
    return sets.filter(F.col("winner_player_id").isNotNull())


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    """A small report as one JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def append_run(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def upsert(target: DataFrame | None, batch: DataFrame, keys: list[str], version: list[Column | str], keep_first: list[str] = ()) -> DataFrame:
    """Target and batch merged: of each key, the row of largest version wins, a batch row over any of the target;
    keep_first columns take the value of the smallest version instead. Sums before the shuffle: a key of very many
    rows is one row per task."""
    order = F.struct(*(F.col(c) if isinstance(c, str) else c for c in version))
    rows = batch.withColumns({"_v": F.struct(F.lit(1).alias("late"), order.alias("v"))})
    if target is not None:
        old = target.withColumns({"_v": F.struct(F.lit(0).alias("late"), order.alias("v"))})
        rows = old.unionByName(rows)
    last = [c for c in batch.columns if c not in keys and c not in keep_first]
    picks = [F.max(F.struct("_v", *last)).alias("_l"), *([F.min(F.struct("_v", *keep_first)).alias("_f")] if keep_first else [])]
    merged = rows.groupBy(*keys).agg(*picks)
    return merged.select(*(F.col(c) if c in keys else F.col(f"_f.{c}" if c in keep_first else f"_l.{c}") for c in batch.columns))


def upsert_table(name: str, target: DataFrame | None, batch: DataFrame, version: list[str]) -> DataFrame:
    return upsert(target, batch, ["id"], version, KEEP_FIRST[name])


def table_stats(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        row = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = row if out is None else out.unionByName(row)
    return out


def exists_keys(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """The keys that have a row in df."""
    return keys.join(df.select(on), on, "left_semi")
