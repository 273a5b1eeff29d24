"""Queries of this subpackage, collected from its modules, with their SQL twins."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.llm import canonical, distinctive, languages, leaks, matching, packing, products
from shelfspark.session import cut_lineage, table

#: The public tokenizer by whose tokens documents are measured.
TOKENIZER = os.environ.get("SHELFSPARK_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.json")


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "mini_a").select("row_ord", "name").unionByName(table(spark, sf_dir, "mini_b").select("row_ord", "name"))


def _brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = (table(spark, sf_dir, t).select("row_ord", "brand_raw") for t in ("mini_a", "mini_b"))
    return a.unionByName(b).where(F.col("brand_raw").rlike(r"(?U)\S"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinctive.rare_terms(_names(spark, sf_dir), "row_ord", "name").select(F.col("key").alias("row_ord"), "term")


def p6_residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every term of every name with its residual."""
    return distinctive.residuals(_names(spark, sf_dir), "row_ord", "name").select(
        F.col("key").alias("row_ord"), "term", F.col("n_records").cast("bigint").alias("n_records"), F.round("residual", 6).alias("residual")
    )


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, listed = _brands(spark, sf_dir), table(spark, sf_dir, "brand_list")
    names = listed.select(F.col("brand_name").alias("brand_raw")).distinct()
    free = rows.join(F.broadcast(names), "brand_raw", "left_anti")
    mapped = canonical.map_to_list(free, "brand_raw", listed, "brand_id", "brand_name")
    got = free.join(mapped, free["brand_raw"] == mapped["value"], "left")
    return got.select("row_ord", F.coalesce("entry_id", F.lit(-1)).cast("bigint").alias("brand_id"))


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = products.catalogue(table(spark, sf_dir, "mini_a"), table(spark, sf_dir, "mini_b"))
    return products.readings(products.forms(both, table(spark, sf_dir, "brand_list")))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products.pairs_within(products.product_ids(_readings(spark, sf_dir)))


def p4_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches with their marginal probability."""
    return matching.match(_readings(spark, sf_dir))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p4_confidence(spark, sf_dir).select("row_lo", "row_hi")


def _budgets(spark: SparkSession, sf_dir: str) -> list[tuple[int, int]]:
    """The container capacities, a fixed table of a few rows."""
    rows = table(spark, sf_dir, "token_budgets").orderBy("budget_id").limit(1001).collect()
    if len(rows) > 1000:
        raise ValueError("more than 1,000 budgets")
    return [(r["budget_id"], r["capacity_tokens"]) for r in rows]


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The container of every document (or piece of one) in every budget."""
    lengths = cut_lineage(packing.token_counts(table(spark, sf_dir, "documents"), "doc_id", "text", TOKENIZER))
    return packing.pack(lengths, _budgets(spark, sf_dir)).withColumnRenamed("key", "doc_id")


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.fill_report(p8_containers(spark, sf_dir), table(spark, sf_dir, "token_budgets"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items")).select("doc_id", "item_id")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = languages.relabelled(languages.identify(table(spark, sf_dir, "documents")))
    return got.where(F.col("lang") != languages.UNKNOWN).select(F.col("key").alias("doc_id"), "seg_no", "lang")


QUERIES = {"p2_found": p2_found, "p4_found": p4_found, "p4_confidence": p4_confidence, "p8_containers": p8_containers, "p8_fill": p8_fill, "p9_found": p9_found, "p10_found": p10_found, "p6_found": p6_found, "p6_residuals": p6_residuals, "p7_found": p7_found}

_TERMS = """names as (select row_ord, name from mini_a union all select row_ord, name from mini_b),
t as (select row_ord, unnest(list_filter(regexp_extract_all(lower(name), '\\p{L}+'), lambda x: length(x) >= 4)) as term from names)"""
SQL = {
    "p6_found": f"""with {_TERMS},
df as (select term, count(distinct row_ord) as n from t group by term)
select distinct row_ord, term from t join df using (term) where n <= 3""",
    "p6_residuals": f"""with {_TERMS},
x as (select row_ord, term, count(*)::double as x from t group by all),
r as (select row_ord, sum(x) as r from x group by 1), c as (select term, sum(x) as c, count(*) as n_records from x group by 1),
n as (select sum(x) as n from x)
select row_ord, term, n_records, round((x - r*c/n) / sqrt(r*c/n * (1 - r/n) * (1 - c/n)), 6) as residual
from x join r using (row_ord) join c using (term), n""",
}
