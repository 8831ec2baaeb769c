"""Stored tables with versions: a folder of hash buckets by key, and a manifest that names the files of a version.

A write puts new files beside the old ones and the manifest last, as a file of its own number; the largest number is the
table. A write that fails in between leaves files that no manifest names, and the former version stays as it was. An
upsert rewrites only the buckets that the batch's keys fall into; the manifest takes over the other buckets' files.

One writer at a time: a manifest's folder is made only if it is not there yet, so the second of two writers of the same
number fails. Files of versions that are no longer wanted are left to the storage's own retention.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from .tables import upsert

BUCKET = "_bucket"


def _manifest(spark: SparkSession, path: str) -> dict | None:
    """The manifest of the largest number; a row a version."""
    try:
        rows = spark.read.schema("version long, about string").json(f"{path}/versions")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    r = rows.orderBy(F.desc("version")).first()
    return json.loads(r["about"]) | {"version": r["version"]} if r else None


def _publish(spark: SparkSession, path: str, version: int, about: dict) -> None:
    row = spark.createDataFrame([(version, json.dumps(about))], "version long, about string")
    row.coalesce(1).write.mode("error").json(f"{path}/versions/v={version:012d}")


def write_versioned(tables: dict[str, DataFrame], path: str) -> int:
    """The next version of a set of tables that belong together: all of them are written before their manifest. Returns
    the version. Tables may be derived from the former version, whose files stay."""
    spark = next(iter(tables.values())).sparkSession
    old = _manifest(spark, path)
    version, at = (old["version"] + 1 if old else 1), uuid.uuid4().hex
    for name, df in tables.items():
        df.write.mode("error").parquet(f"{path}/data/{at}/{name}")
    _publish(spark, path, version, {"at": at, "schemas": {name: df.schema.json() for name, df in tables.items()}})
    return version


def read_versioned(spark: SparkSession, path: str, names: list[str]) -> dict[str, DataFrame] | None:
    """The tables of the last version; None where there is none yet."""
    found = _manifest(spark, path)
    if found is None:
        return None
    return {n: spark.read.schema(StructType.fromJson(json.loads(found["schemas"][n]))).parquet(f"{path}/data/{found['at']}/{n}") for n in names}


def bucket_of(keys: list[str], buckets: int):
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def write_table(df: DataFrame, path: str, keys: list[str], buckets: int = 64) -> int:
    """A first version: every bucket's rows in a folder of its own."""
    spark = df.sparkSession
    old = _manifest(spark, path)
    version, at = (old["version"] + 1 if old else 1), uuid.uuid4().hex
    _write_buckets(df.withColumn(BUCKET, bucket_of(keys, buckets)), path, at)
    written = [r[0] for r in spark.read.schema(StructType([*df.schema.fields, StructField(BUCKET, IntegerType())])).parquet(f"{path}/data/{at}").select(BUCKET).distinct().collect()]  # at most `buckets` rows
    _publish(spark, path, version, {"keys": keys, "buckets": buckets, "schema": df.schema.json(), "files": {str(b): at for b in written}})
    return version


def _write_buckets(df: DataFrame, path: str, at: str) -> None:
    df.repartition(F.col(BUCKET)).write.mode("error").partitionBy(BUCKET).parquet(f"{path}/data/{at}")


def read_table(spark: SparkSession, path: str, version: int | None = None, only: list[int] | None = None) -> DataFrame:
    """The rows of the last version, or of a given one; only: of these buckets."""
    about = _manifest(spark, path) if version is None else next(json.loads(r["about"]) for r in spark.read.schema("version long, about string").json(f"{path}/versions").filter(F.col("version") == version).collect())
    schema = StructType.fromJson(json.loads(about["schema"]))
    files = {b: at for b, at in about["files"].items() if only is None or int(b) in only}
    paths = [f"{path}/data/{at}/{BUCKET}={b}" for b, at in sorted(files.items(), key=lambda x: int(x[0]))]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def upsert_stored(path: str, batch: DataFrame, version: list[str], keep_first: list[str] = ()) -> int:
    """The next version: target and batch merged as by `upsert`, in the buckets of the batch's keys alone."""
    spark = batch.sparkSession
    old = _manifest(spark, path)
    keys, buckets, files = old["keys"], old["buckets"], old["files"]
    placed = batch.withColumn(BUCKET, bucket_of(keys, buckets))
    touched = [r[0] for r in placed.select(BUCKET).distinct().collect()]  # at most `buckets` rows
    if not touched:
        return old["version"]
    merged = upsert(read_table(spark, path, only=touched), batch, keys, version, keep_first)
    at = uuid.uuid4().hex
    _write_buckets(merged.withColumn(BUCKET, bucket_of(keys, buckets)), path, at)
    _publish(spark, path, old["version"] + 1, {k: old[k] for k in ("keys", "buckets", "schema")} | {"files": files | {str(b): at for b in touched}})
    return old["version"] + 1
