"""Queries of the general problems 1, 3 and 5."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.operators.packed import split_packed
from shelfspark.operators.quantities import size_text, with_quantity
from shelfspark.session import spread, table
from shelfspark.sources.rejects import invalid_reason, parse_records, typed

A_COLUMNS = (
    "item_id name brand_raw name_clean description category department url item_type item_info tags subcategory "
    "is_private_label sizing_comp size_raw datapoint_id raw_data_id created_at_utc updated_at_utc"
).split()


def listing_quantities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The content of every listing of both catalogues, solved against the other statement of its record; densities by category."""
    category = F.regexp_extract("item_info", r"""["']category_2["']\s*:\s*["']([^"']+)""", 1).alias("category")
    a = table(spark, sf_dir, "mini_a").select("row_ord", F.col("name").alias("own"), size_text("sizing_comp").alias("other"), category)
    b = table(spark, sf_dir, "mini_b").select("row_ord", size_text("sizing_comp").alias("own"), F.col("name").alias("other"), category)
    return with_quantity(spread(a.unionByName(b)), "own", "other", "q", "category").select("row_ord", "q")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing_quantities(spark, sf_dir).where("q.base_amount is not null").select("row_ord", "q.base_unit", "q.base_amount")


def p1_solutions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the solutions spread: by unit and by whether they are the only one."""
    q = listing_quantities(spark, sf_dir).where("q.base_amount is not null").select("q.*")
    return q.groupBy("base_unit", "is_unique").agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.avg("residual"), 6).alias("mean_residual"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = split_packed(table(spark, sf_dir, "mini_b"), "row_ord", "tags")
    return got.select(F.col("key").alias("row_ord"), "pos", F.col("value").alias("tag"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "mini_a").select(
        F.lit("mini_a").alias("source_table"), F.col("row_ord").alias("row_key"), invalid_reason().alias("reason")
    )
    f = parse_records(table(spark, sf_dir, "feed_lines"), "line_no", "line", A_COLUMNS)
    f = f.select(F.lit("feed_lines").alias("source_table"), F.col("key").alias("row_key"), F.coalesce("reason", invalid_reason()).alias("reason"))
    return a.unionByName(f).where("reason is not null")


def p5_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of feed_lines that load, typed."""
    f = parse_records(table(spark, sf_dir, "feed_lines"), "line_no", "line", A_COLUMNS)
    return typed(f.where(F.coalesce("reason", invalid_reason()).isNull())).drop("reason").withColumnRenamed("key", "line_no")


QUERIES = {"p1_found": p1_found, "p1_solutions": p1_solutions, "p3_found": p3_found, "p5_found": p5_found, "p5_loaded": p5_loaded}

_REASON = """case when not regexp_full_match(coalesce({id}, ''), '[0-9]+') then 'non_numeric_item_id'
  when regexp_full_match(coalesce({name}, ''), '(?s)[\\s\\x{{000B}}\\x{{0085}}\\p{{Z}}]*') then 'blank_name'
  when coalesce({c}, '') <> '' and (not regexp_full_match({c}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}T([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]Z') or try_cast(left({c}, 10) as date) is null)
    or coalesce({u}, '') <> '' and (not regexp_full_match({u}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}T([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]Z') or try_cast(left({u}, 10) as date) is null)
    then 'bad_timestamp' end"""
_CELL = '"(?:[^"]|"")*"|[^",]*'
_GRAMMAR = f"(?s)(?:{_CELL})(?:,(?:{_CELL}))*"


def _sql_cell(i: int) -> str:
    """Cell i of a well-quoted record: every cell is taken with the comma before it."""
    raw = f"substr(cells[{i}], 2)"
    return f"case when {raw} like '\"%' then replace(substr({raw}, 2, length({raw}) - 2), '\"\"', '\"') else {raw} end"


SQL = {
    "p5_found": f"""
with a as (select 'mini_a' as source_table, row_ord as row_key, {_REASON.format(id="item_id", name="name", c="created_at_utc", u="updated_at_utc")} as reason from mini_a),
f as (select line_no, line, regexp_extract_all(',' || line, '(?s),(?:{_CELL})') as cells from feed_lines),
g as (select line_no, case when line is null then 'wrong_column_count' when not regexp_full_match(line, '{_GRAMMAR}') then 'broken_quoting' when len(cells) <> 19 then 'wrong_column_count' end as r,
  {_sql_cell(1)} as id, {_sql_cell(2)} as nm, {_sql_cell(18)} as c, {_sql_cell(19)} as u from f),
h as (select 'feed_lines' as source_table, line_no as row_key, coalesce(r, {_REASON.format(id="id", name="nm", c="c", u="u")}) as reason from g)
select * from a where reason is not null union all select * from h where reason is not null""",
    "p5_loaded": None,
}
SQL = {k: v for k, v in SQL.items() if v}
