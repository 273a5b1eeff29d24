"""Samples for labelling: deterministic by a seeded hash instead of a shuffled list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.session import cut_lineage, width

PAIR = ["item_id_a", "item_id_b"]


def seeded(key: list[str], seed: int) -> Column:
    """A number that depends on the keys and the seed alone."""
    return F.xxhash64(*(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key), F.lit(seed))


def round_robin(df: DataFrame, stratum: Column, quota: int, key: list[str], seed: int = 0, shuffle_strata: bool = False, order: Column | None = None) -> DataFrame:
    """``quota`` rows, one of every stratum per turn, strata in order (null last) or, if shuffled, by a seeded hash."""
    if quota <= 0:
        return df.where("false")
    inner = order if order is not None else seeded(key, seed)
    nth = F.row_number().over(Window.partitionBy("__s").orderBy(inner, *key))
    turn = [F.xxhash64("__s", F.lit(seed)), F.col("__s").asc_nulls_last()] if shuffle_strata else [F.col("__s").asc_nulls_last()]
    return df.withColumn("__s", stratum).withColumn("__n", nth).where(F.col("__n") <= quota).orderBy("__n", *turn, *key).limit(quota).drop("__s", "__n")


def random_rows(df: DataFrame, n: int, key: list[str], seed: int = 0) -> DataFrame:
    return df.orderBy(seeded(key, seed), *key).limit(n)


def first_quartile(df: DataFrame, value: str) -> DataFrame:
    """(q1) by the exclusive method: the value at place (n + 1) / 4, interpolated; null for fewer than four values.

    Equal values are counted first; the distinct ones are ranked within range partitions, to which the counts of the
    partitions before are added, so no task sees all values.
    """
    v = df.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v"))
    counts = v.groupBy("v").agg(F.count(F.lit(1)).alias("c"))
    ranged = cut_lineage(counts.repartitionByRange(width(df.sparkSession), "v").withColumn("pid", F.spark_partition_id()))
    parts = ranged.groupBy("pid").agg(F.sum("c").alias("own"), F.min("v").alias("least"))  # one row per partition
    before = F.sum("own").over(Window.partitionBy(F.lit(0)).orderBy("least").rowsBetween(Window.unboundedPreceding, -1))
    offsets = parts.select("pid", F.coalesce(before, F.lit(0)).alias("offset"), F.sum("own").over(Window.partitionBy(F.lit(0))).alias("n"))
    within = F.sum("c").over(Window.partitionBy("pid").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    ranked = ranged.withColumn("within", within).join(F.broadcast(offsets), "pid").withColumn("hi", F.col("within") + F.col("offset"))
    place = (F.col("n") + 1) / 4.0
    both = ranked.withColumns({"j": F.floor(place), "g": place - F.floor(place)}).where("n >= 4")
    at = lambda k: F.min(F.when(F.col("hi") >= k, F.col("v")))
    out = both.agg(at(F.col("j")).alias("lo"), at(F.col("j") + 1).alias("up"), F.max("g").alias("g"))
    return out.select((F.col("lo") + (F.col("up") - F.col("lo")) * F.col("g")).alias("q1"))


def bottom_quarter(df: DataFrame, value: str) -> DataFrame:
    return df.crossJoin(F.broadcast(first_quartile(df, value))).where(F.col(value) <= F.col("q1")).drop("q1")


def near_miss(audit: DataFrame, floor: float = 0.75, with_margin: int = 20, without: int = 10) -> DataFrame:
    """Below-threshold rows of a high score: the smallest margins, then the highest scores among those without one."""
    near = audit.where((F.col("decision") == "below_threshold") & (F.coalesce("score", F.lit(0.0)) >= floor))
    small = near.where("top1_top2_margin is not null").orderBy("top1_top2_margin", *PAIR).limit(with_margin)
    high = near.where("top1_top2_margin is null").orderBy(F.col("score").desc(), *PAIR).limit(without)
    return small.unionByName(high)


def pinned_last(samples: DataFrame, pinned: DataFrame, order: Column) -> DataFrame:
    """Samples de-duplicated by pair, the first kept, without the pinned pairs; then all pinned rows."""
    keys = pinned.select(*PAIR).distinct()
    same = [samples[k].eqNullSafe(keys[k]) for k in PAIR]
    rest = samples.join(F.broadcast(keys), same, "left_anti")
    nth = F.row_number().over(Window.partitionBy(*PAIR).orderBy(order))
    return rest.withColumn("__n", nth).where("__n = 1").drop("__n").unionByName(pinned, allowMissingColumns=True)


def with_absent(audit: DataFrame, required: DataFrame) -> DataFrame:
    """One row for every required id: its audit row, or one that says it is absent."""
    j = required.select("item_id_a").distinct().join(audit, "item_id_a", "left")
    missing = F.col("decision").isNull()
    return j.withColumns({
        "source": F.when(missing, F.lit("deterministic")).otherwise(F.col("source")),
        "reason": F.when(missing, F.lit("absent_from_audit")).otherwise(F.col("reason")), "decision": F.coalesce("decision", F.lit("absent_from_audit")),
    })


def merge_annotations(template: DataFrame, prior: DataFrame) -> DataFrame:
    """The template with prior labels and notes where they are not empty; ``merged`` tells which rows got any."""
    p = prior.select(*PAIR, F.nullif(F.lower(F.trim("label")), F.lit("")).alias("new_label"), F.nullif(F.rtrim("notes"), F.lit("")).alias("new_notes")).dropDuplicates(PAIR)
    j = template.join(p, PAIR, "left")
    return j.withColumns({
        "label": F.coalesce("new_label", "label"), "notes": F.coalesce("new_notes", "notes"),
        "merged": F.col("new_label").isNotNull() | F.col("new_notes").isNotNull(),
    }).drop("new_label", "new_notes")


def template_rows(samples: DataFrame, names_a: DataFrame, names_b: DataFrame) -> DataFrame:
    """The columns a labeller sees: names of both sides joined on, label and notes empty."""
    j = samples.join(names_a.select(F.col("item_id").alias("item_id_a"), F.col("name").alias("a_name"), "matchable_group"), "item_id_a", "left")
    j = j.join(names_b.select(F.col("item_id").alias("item_id_b"), F.col("name").alias("b_name")), "item_id_b", "left")
    return j.select(
        "sample_type", "matchable_group", "item_id_a", "item_id_b", "a_name", "b_name", "score", F.col("top1_top2_margin").alias("margin"),
        "source", "reason", "decision", F.lit("").alias("label"), F.lit("").alias("notes"),
    )


def strata_counts(df: DataFrame, column: str = "sample_type") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
