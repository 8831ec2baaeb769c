"""A training-data pipeline of five stages over `documents`, each made of one corpus operator.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and reread as the next one's
docs. All but the last return the columns of documents. Nulls, empty texts, repeated rows and empty tables give what
the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlab.llm import decontaminate, jaccard, packing, pii, quality
from matchlab.llm.common import scratch
from matchlab.llm.queries import TOKENIZER


def _wrapped(docs: DataFrame) -> DataFrame:
    """Every row whole as `r`, so that no column of the table can clash with those beside it: key, th, and `rest`, a hash of
    the other columns that orders rows alike in id and text."""
    rest = F.to_json(F.struct(F.lit(0), *(F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text"))))
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("r"), F.col("doc_id").cast("long").alias("key"), F.xxhash64("text").alias("th"), F.xxhash64(rest).alias("rest"))


def _same(a: DataFrame, b: DataFrame):
    return a["key"].eqNullSafe(b["key"]) & (a["th"] == b["th"])


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the rated documents, selects."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.select(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents one row: that of smallest doc_id, then of smallest text hash, then of smallest
    hash of the other columns; a null doc_id only where the group has no other. Documents without a word link with none: one row of
    each doc_id and text stays, and every row of a null doc_id."""
    alone = F.col("n_shingles") == 0
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th", alone.alias("alone"))).alias("k")
    groups = jaccard.grouped(docs).groupBy("group", F.when(alone, F.col("doc_id")).alias("a"), F.when(alone, F.col("th")).alias("b")).agg(first)
    groups = groups.select(F.col("k.doc_id").alias("key"), "k.th", (F.col("k.none") & F.col("k.alone")).alias("each"))
    rows = _wrapped(docs)
    plain = {"id": F.coalesce("key", F.lit(0)), "none": F.col("key").isNull()}  # columns without nulls: the sum needs no other split of the rows than the join
    met = rows.withColumns(plain).join(groups.withColumns(plain).drop("key"), ["id", "none", "th"])
    met = met.withColumn("each", F.when(F.col("each"), F.monotonically_increasing_id()))
    return met.groupBy("id", "none", "th", "each").agg(F.min_by("r", "rest").alias("r")).select("r.*")


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    hits = decontaminate.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(F.col("doc_id").alias("key"), "th").distinct()
    rows = _wrapped(docs)
    return rows.join(hits, _same(rows, hits), "left_anti").select("r.*")


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redact(docs, pii.train(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences of 2048 tokens."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark),
    ("pii", redact_personal_data),
    ("packing", pack_sequences),
]

#: The classifier, the personal-data model, the tokenizer and the linear program have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
