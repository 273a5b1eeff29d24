"""Reports on an audit: shares, threshold grids, score buckets and precision of labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = (("[0.55,0.60)", 0.55, 0.60), ("[0.60,0.65)", 0.60, 0.65), ("[0.65,0.70)", 0.65, 0.70), ("[0.70,0.75)", 0.70, 0.75), ("[0.75,0.80)", 0.75, 0.80), ("[0.80,1.00]", 0.80, 1.01))
LABELS = ("correct", "wrong", "partial", "unsure")


def shares(df: DataFrame, column: str) -> DataFrame:
    """(value, n, share_pct) with the grand total from a window over the few groups."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share_pct", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0))), 2))


def bucket(score: Column, buckets: tuple = BUCKETS) -> Column:
    out = F.when(F.lit(False), F.lit(""))
    for name, lo, hi in buckets:
        out = out.when((score >= lo) & (score < hi), F.lit(name))
    return out


def threshold_grid(audit: DataFrame, scores: list[float], margins: list[float], pairs: dict[str, tuple[str, str]] | None = None, floor: int = 0) -> DataFrame:
    """(min_score, min_margin, accepted_count, a flag per named pair, clears_floor) from the partner already chosen.

    The grid is the small side of the cross join; an empty margin passes every margin.
    """
    spark = audit.sparkSession
    grid = spark.createDataFrame([(float(s), float(m)) for s in scores for m in margins], "min_score double, min_margin double")
    rows = audit.where(F.col("decision").isin("accepted", "below_threshold") & F.col("score").isNotNull()).select("item_id_a", "item_id_b", "score", "top1_top2_margin")
    margin = F.col("top1_top2_margin")
    passes = (F.col("score") >= F.col("min_score")) & (margin.isNull() | (margin >= F.col("min_margin")))
    flags = [F.coalesce(F.bool_or(passes & (F.col("item_id_a") == a) & (F.col("item_id_b") == b)), F.lit(False)).alias(n) for n, (a, b) in (pairs or {}).items()]
    counted = rows.crossJoin(F.broadcast(grid)).groupBy("min_score", "min_margin").agg(F.count_if(passes).alias("accepted_count"), *flags)
    return counted.withColumn("clears_floor", F.col("accepted_count") >= floor)


def bucket_histogram(audit: DataFrame, buckets: tuple = BUCKETS) -> DataFrame:
    return audit.where("decision = 'accepted'").groupBy(bucket(F.col("score"), buckets).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def label_counts(df: DataFrame, by: list[str], total: bool = False) -> DataFrame:
    """(by..., n, one column per label, precision): ``total`` adds the row over all, whose keys are null, by ROLLUP."""
    judged = [F.count_if(F.col("label") == x).alias(x) for x in LABELS]
    groups = df.rollup(*by) if total else df.groupBy(*by)
    out = groups.agg(F.count(F.lit(1)).alias("n"), *judged)
    c, w, p = (F.col(x) for x in LABELS[:3])
    return out.withColumn("precision", F.round(c / F.nullif(c + w + p, F.lit(0)), 6))


def cumulative_precision(df: DataFrame, floors: list[float]) -> DataFrame:
    """(floor, n, correct, precision) of labelled rows that score at least each floor."""
    grid = df.sparkSession.createDataFrame([(float(f),) for f in floors], "floor double")
    over = F.col("score") >= F.col("floor")
    judged = F.col("label").isin(*LABELS[:3])
    out = df.crossJoin(F.broadcast(grid)).groupBy("floor").agg(F.count_if(over & judged).alias("n"), F.count_if(over & (F.col("label") == "correct")).alias("correct"))
    return out.withColumn("precision", F.round(F.col("correct") / F.nullif(F.col("n"), F.lit(0)), 6))


def top_groups(df: DataFrame, columns: list[str], n: int = 30) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), *(F.col(c).asc_nulls_last() for c in columns)).limit(n)
