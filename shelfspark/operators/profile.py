"""Profiles of a catalogue: one wide aggregate for the counters, one grouped count per histogram."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.functions import semi, sizes
from shelfspark.functions.text import is_blank, is_missing, is_numeric_id, percent

# How keys and values of article numbers look, and what packs, dimensions and markup look like.
CODE_KEY = r"(?i)upc|gtin|ean|barcode"
CODE_VALUE = r"\A[0-9]{8,14}\z"
PACK_HEAD = r"(?i)\A\s*\([0-9]+[\s-]*pack\)"
MULTIPACK = r"(?i)[0-9]+\s*[x×]\s*[0-9.]+\s*[a-z]"
DIMENSION = r"(?i)[0-9.]+\s*[\"']?\s*x\s*[0-9.]+\s*(?:inch|in\b|\"|'|ft\b|cm\b)"
MARKUP = r"<[A-Za-z/][^>]*>"


def count_if(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def blank_profile(df: DataFrame, columns: list[str], missing: bool = True) -> DataFrame:
    """(column_name, n_rows, blank_count, blank_rate): one pass for all columns, turned into rows."""
    test = is_missing if missing else is_blank
    counts = df.agg(F.count(F.lit(1)).alias("n"), *(count_if(test(F.col(c))).alias(c) for c in columns))
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("blank_count")) for c in columns)))
    return counts.select("n", each.alias("e")).select(
        "e.column_name", F.col("n").alias("n_rows"), "e.blank_count", percent(F.col("e.blank_count"), F.col("n")).alias("blank_rate")
    )


def bad_ids(df: DataFrame, id_col: str = "item_id", order: str = "row_ord", examples: int = 8) -> tuple[DataFrame, DataFrame]:
    """Count of ids that are no numbers; the first of them in arrival order."""
    bad = df.where(~is_numeric_id(F.col(id_col)))
    return bad.agg(F.count(F.lit(1)).alias("n")), bad.orderBy(order).limit(examples).select(order, id_col)


def duplicate_ids(df: DataFrame, id_col: str = "item_id") -> DataFrame:
    """(id, repeats) of ids delivered more than once, the extra deliveries counted."""
    return df.groupBy(id_col).agg((F.count(F.lit(1)) - 1).alias("repeats")).where("repeats > 0")


def json_health(df: DataFrame, columns: list[str]) -> DataFrame:
    """(field, status, n) with status blank, invalid, valid_dict or valid_other."""
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("field"), semi.json_status(F.col(c)).alias("status")) for c in columns)))
    return df.select(each.alias("e")).groupBy("e.field", "e.status").agg(F.count(F.lit(1)).alias("n"))


def json_keys(df: DataFrame, column: str) -> DataFrame:
    """(key, n) of the dotted key paths of a JSON column."""
    return df.select(F.explode(semi.key_paths(F.col(column))).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))


def code_stats(df: DataFrame, column: str) -> DataFrame:
    """(key, n_values, n_plausible) of members whose key looks like an article number's."""
    v = F.from_json(F.col(column), "map<string,string>")
    members = df.where(semi.json_object(F.col(column)).isNotNull()).select(F.explode(v).alias("key", "value")).where(F.col("key").rlike(CODE_KEY))
    filled = members.where(~is_missing(F.col("value")))
    return filled.groupBy("key").agg(F.count(F.lit(1)).alias("n_values"), count_if(F.trim("value").rlike(CODE_VALUE)).alias("n_plausible"))


def top_values(df: DataFrame, value: Column, n: int, name: str = "value") -> DataFrame:
    """The n most frequent values, ties by value; null and empty left out."""
    counts = df.select(value.alias(name)).where(F.coalesce(F.col(name), F.lit("")) != "").groupBy(name).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.col("n").desc(), name).limit(n)


def size_stats(df: DataFrame) -> DataFrame:
    """Counters of sizes in names and size cells, their agreement and conflicts, packs, dimensions, markup and descriptions."""
    text = semi.text_field(semi.json_object(F.col("sizing_comp")), "size_user_friendly")
    d = df.select(
        F.coalesce("name", F.lit("")).alias("name"), F.coalesce(text, F.lit("")).alias("cell"), F.coalesce("description", F.lit("")).alias("description")
    ).withColumns({"ns": sizes.best_size(sizes.all_sizes(F.col("name"))), "cs": sizes.best_size(sizes.all_sizes(F.col("cell")))})
    both = F.col("ns").isNotNull() & F.col("cs").isNotNull()
    clash = both & sizes.sizes_conflict(F.col("ns"), F.col("cs"))
    joined = F.concat("name", F.lit(" "), "cell")
    return d.agg(
        F.count(F.lit(1)).alias("n_rows"), count_if(F.col("ns").isNotNull()).alias("name_parsed"), count_if(~is_missing(F.col("cell"))).alias("cell_filled"),
        count_if(F.col("cs").isNotNull()).alias("cell_parsed"), count_if(both).alias("both_parsed"), count_if(clash).alias("conflicts"),
        count_if(both & ~clash).alias("agreements"), count_if(F.col("name").rlike(PACK_HEAD)).alias("pack_heads"), count_if(joined.rlike(MULTIPACK)).alias("multipacks"),
        count_if(joined.rlike(DIMENSION)).alias("dimensions"), count_if(F.col("description").rlike(MARKUP)).alias("markup"),
        count_if(~is_missing(F.col("description"))).alias("descriptions"),
    )


def duplicate_groups(df: DataFrame, key: list[Column], item: Column, order: str = "row_ord", most_items: int = 20) -> DataFrame:
    """(keys, n_rows, items) of groups of more than one row; ``items`` holds the first ``most_items`` by arrival.

    Only rows that may be shown are gathered: a row number by group cuts them before any list is built.
    """
    names = [f"k{i}" for i in range(len(key))]
    rows = df.select(*(k.alias(n) for k, n in zip(key, names, strict=True)), item.alias("item"), F.col(order).alias("ord"))
    counts = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")
    first = rows.withColumn("nth", F.row_number().over(Window.partitionBy(*names).orderBy("ord"))).where(F.col("nth") <= most_items)
    lists = first.groupBy(*names).agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "item"))), lambda x: x["item"]).alias("items"))
    return counts.join(lists, names)


def shared_values(a: DataFrame, b: DataFrame, value_a: Column, value_b: Column) -> DataFrame:
    """(value, n_a, n_b) of values both sides hold, with their rows on either side."""
    count = lambda d, v, n: d.select(v.alias("value")).where(F.coalesce(F.col("value"), F.lit("")) != "").groupBy("value").agg(F.count(F.lit(1)).alias(n))
    return count(a, value_a, "n_a").join(count(b, value_b, "n_b"), "value")
