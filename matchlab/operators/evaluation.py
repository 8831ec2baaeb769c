"""Metrics and model analytics over predictions: columns prob (P(player 1 wins)), p1_won and what the caller keeps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.columns import bucket, label
from .reports import histogram

EPS = 1e-15
# Edges and names of the confidence report.
CONFIDENCE_EDGES = [0, 0.05, 0.10, 0.15, 0.20, 0.30, 0.50]
CONFIDENCE_LABELS = ["50-55%", "55-60%", "60-65%", "65-70%", "70-80%", "80-100%"]


def active_rows(df: DataFrame, min_sets: int = 5) -> DataFrame:
    return df.filter((F.col("p1_sets_played") >= min_sets) & (F.col("p2_sets_played") >= min_sets))


def temporal_split(df: DataFrame, ts: int = 1_751_328_000) -> tuple[DataFrame, DataFrame]:
    return df.filter(F.col("completed_at") < ts), df.filter(F.col("completed_at") >= ts)


def correct() -> Column:
    return ((F.col("prob") >= 0.5).cast("int") == F.col("p1_won")).cast("int")


def _borders(per: DataFrame, column: str, parts: int) -> DataFrame:
    """One row, array borders: a column of distinct values cut into parts of about equal number, whatever the values."""
    return per.agg(F.array_distinct(F.coalesce(F.percentile_approx(column, [i / parts for i in range(1, parts)], 1000), F.array().cast("array<double>"))).alias("borders"))


def _range(column: str) -> Column:
    return F.size(F.filter("borders", lambda b: b <= F.col(column)))


def percentiles(df: DataFrame, column: str, shares: list[float], parts: int = 64, weight: str | None = None) -> DataFrame:
    """One row, array q: exact percentiles, between two values on the line that joins them. Rows are counted per value and
    counts summed over ranges, then within them, so no task holds all values; ranges hold like numbers of distinct values,
    so neither far values nor frequent ones fill a range. No rows give a null. weight: rows that each row stands for."""
    x = df.select(F.col(column).cast("double").alias("x"), (F.col(weight) if weight else F.lit(1)).cast("long").alias("n")).filter("x is not null")
    per = x.groupBy("x").agg(F.sum("n").alias("n"))
    ends = per.agg(F.sum("n").alias("total")).crossJoin(F.broadcast(_borders(per, "x", parts)))  # two single rows
    per = per.crossJoin(F.broadcast(ends)).withColumn("range", _range("x"))
    tops = per.groupBy("range").agg(F.sum("n").alias("n")).select("range", F.coalesce(F.sum("n").over(W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("base"))  # at most `parts` rows
    inner = F.coalesce(F.sum("n").over(W.partitionBy("range").orderBy("x").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rows = per.withColumn("inner", inner).join(F.broadcast(tops), "range").withColumn("before", F.col("base") + F.col("inner"))
    place = lambda s: F.lit(float(s)) * (F.col("total") - 1)
    at = lambda k: F.max(F.when((F.col("before") <= k) & (k < F.col("before") + F.col("n")), F.col("x")))
    picks = [at(end(place(s))).alias(f"{c}{i}") for i, s in enumerate(shares) for c, end in (("a", F.floor), ("b", F.ceil))]
    one = rows.agg(F.max("total").alias("total"), *picks)
    value = lambda i, s: F.col(f"a{i}") + (F.col(f"b{i}") - F.col(f"a{i}")) * (place(s) - F.floor(place(s)))
    return one.select(F.when(F.col("total").isNotNull(), F.array(*(value(i, s) for i, s in enumerate(shares)))).alias("q"))


def auc(pred: DataFrame, by: list[str] = (), parts: int = 64) -> DataFrame:
    """Exact area under the ROC curve (of each group of `by`), ties half: one row per probability, negatives counted below
    it. The running sum goes over ranges of probabilities, then within them, so no task holds all of them."""
    per = pred.groupBy(*by, "prob").agg(F.sum("p1_won").alias("pos"), F.sum(1 - F.col("p1_won")).alias("neg"))
    per = per.crossJoin(F.broadcast(_borders(per, "prob", parts))).withColumn("range", _range("prob"))  # one row
    tops = per.groupBy(*by, "range").agg(F.sum("neg").alias("n")).select(*by, "range", F.coalesce(F.sum("n").over(W.partitionBy(*by).orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("base"))  # at most `parts` rows a group
    inner = F.coalesce(F.sum("neg").over(W.partitionBy(*by, "range").orderBy("prob").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    below = per.withColumn("inner", inner).join(tops if by else F.broadcast(tops), [*by, "range"]).withColumn("below", F.col("base") + F.col("inner"))
    area = F.try_divide(F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2)).cast("double"), (F.sum("pos") * F.sum("neg")).cast("double")).alias("auc")
    return below.groupBy(*by).agg(area) if by else below.agg(area)


def metrics(pred: DataFrame) -> DataFrame:
    p = F.least(F.greatest(F.col("prob"), F.lit(EPS)), F.lit(1 - EPS))
    y = F.col("p1_won")
    one = pred.agg(F.count(F.lit(1)).alias("n"), F.avg(correct()).alias("accuracy"), (-F.avg(y * F.ln(p) + (1 - y) * F.ln(1 - p))).alias("log_loss"), F.avg(F.pow(F.col("prob") - y, 2)).alias("brier"))
    return one.crossJoin(F.broadcast(auc(pred)))  # two single rows


def calibration(pred: DataFrame, n_bins: int = 15) -> DataFrame:
    """Quantile bins: a row lies in the bin of as many inner edges as are below its probability."""
    edges = percentiles(pred, "prob", [i / n_bins for i in range(1, n_bins)])
    rows = pred.crossJoin(F.broadcast(edges))  # one row
    rows = rows.withColumn("bin", F.size(F.filter("q", lambda x: x < F.col("prob"))))
    return rows.groupBy("bin").agg(F.avg("prob").alias("predicted"), F.avg("p1_won").alias("observed"), F.count(F.lit(1)).alias("n"))


def confidence_buckets(pred: DataFrame) -> DataFrame:
    b = bucket(F.abs(F.col("prob") - 0.5), CONFIDENCE_EDGES, CONFIDENCE_LABELS)
    return pred.groupBy(b.alias("confidence")).agg(F.avg(correct()).alias("accuracy"), F.count(F.lit(1)).alias("n")).filter("confidence is not null")


def probability_histogram(pred: DataFrame) -> DataFrame:
    return histogram(pred, F.col("prob"), 50)


def top_upsets(pred: DataFrame, players: DataFrame, n: int = 15) -> DataFrame:
    """The most confident wrong predictions with names. pred also has set_id, player1_id, player2_id, tournament_name."""
    first = F.col("prob") >= 0.5
    worst = pred.filter(correct() == 0).withColumn("confidence", F.abs(F.col("prob") - 0.5)).orderBy(F.desc("confidence"), "set_id").limit(n)
    rows = worst.select("set_id", "tournament_name", F.when(first, F.col("player1_id")).otherwise(F.col("player2_id")).alias("fav"), F.when(first, F.col("player2_id")).otherwise(F.col("player1_id")).alias("win"), F.greatest(F.col("prob"), 1 - F.col("prob")).alias("favourite_prob"))
    for c, name in (("fav", "favourite"), ("win", "winner")):
        rows = rows.join(players.select(F.col("id").alias(c), F.col("gamer_tag").alias(name)), c, "left").withColumn(name, F.coalesce(name, F.col(c).cast("string")))
    return rows.select("set_id", "tournament_name", "favourite", "winner", "favourite_prob")


def importance_report(importances: DataFrame) -> DataFrame:
    return importances.select(label(F.col("feature")).alias("feature"), "importance").orderBy(F.desc("importance"), "feature")


def results_table(results: DataFrame) -> DataFrame:
    """Metrics of several models (column model) as text with four decimals."""
    return results.select("model", *(F.format_string("%.4f", c).alias(c) for c in ("accuracy", "log_loss", "brier", "auc")))


def metric_comparison(results: DataFrame) -> DataFrame:
    return results.select("model", "accuracy", "log_loss", "brier", "auc").unpivot("model", ["accuracy", "log_loss", "brier", "auc"], "metric", "value")


def walk_forward_cuts(df: DataFrame, n: int = 4, weight: str | None = None) -> DataFrame:
    """fold, train_before, test_until: cuts at the quantiles i/(n+1) of completed_at; the last test ends with the data."""
    end = df.agg((F.max("completed_at") + 1).cast("double").alias("end"))
    q = percentiles(df, "completed_at", [(i + 1) / (n + 1) for i in range(n)], weight=weight).crossJoin(F.broadcast(end))  # two single rows
    rows = F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.struct(i.alias("fold"), F.get("q", i - 1).alias("train_before"), F.coalesce(F.get("q", i), F.col("end")).alias("test_until")))
    return q.filter("q is not null").select(F.inline(rows))


def fold_sizes(df: DataFrame, n: int = 4) -> DataFrame:
    """Rows to train on and to test on in each fold; empty folds drop out."""
    rows = df.select(F.col("completed_at").cast("double").alias("t")).crossJoin(F.broadcast(walk_forward_cuts(df, n)))  # n rows
    out = rows.groupBy("fold", "train_before", "test_until").agg(F.count_if(F.col("t") < F.col("train_before")).alias("train"), F.count_if((F.col("t") >= F.col("train_before")) & (F.col("t") < F.col("test_until"))).alias("test"))
    return out.filter("train > 0 and test > 0")
