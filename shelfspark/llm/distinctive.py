r"""How distinctive a term is per record: correspondence-analysis residuals.

With ``x`` the count of a term in a record, ``r`` the record's tokens, ``c`` the term's tokens and ``n`` all
tokens, the expected count is ``e = r*c/n`` and the adjusted residual

    (x - e) / sqrt(e * (1 - r/n) * (1 - c/n))

is large where a record uses a term more than the margins explain. Plain DataFrame arithmetic: terms are counted
with map-side partial sums. Terms frequent enough to skew the join back number at most ``1/hot_share`` times the
mean tokens of a record; they are joined by broadcast and the rest by shuffle, so no hot key is shuffled.

Null and empty texts have no terms. A record in which one term is the whole collection (margin 1) gets null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def letter_runs(text: Column, least: int = 4) -> Column:
    """Maximal runs of Unicode letters of the lower-cased text, ``least`` letters or longer."""
    return F.filter(F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+)"), 1), lambda t: F.char_length(t) >= least)


def term_counts(df: DataFrame, key: str, text: str, least: int = 4, once: bool = False, long: int = 64) -> DataFrame:
    """(key, r, term, x): how often each term stands in each record, and the record's total; ``key`` must be unique.

    ``once``: a record counts a term once. Records are counted where they are; those of more than ``long`` terms, whose
    terms would be compared with each other, by a grouped sum.
    """
    runs = letter_runs(F.col(text), least)
    terms = df.select(F.col(key).alias("key"), (F.array_distinct(runs) if once else runs).alias("terms")).where("size(terms) > 0").withColumn("r", F.size("terms"))
    if once:
        return terms.select("key", "r", F.explode("terms").alias("term"), F.lit(1).alias("x"))
    short = terms.where(F.col("r") <= long).select("key", "r", "terms", F.explode(F.array_distinct("terms")).alias("term")).select(
        "key", "r", "term", F.size(F.filter("terms", lambda t: t == F.col("term"))).alias("x")
    )
    many = terms.where(F.col("r") > long).select("key", "r", F.explode("terms").alias("term")).groupBy("key", "r", "term").agg(F.count(F.lit(1)).cast("int").alias("x"))
    return short.unionByName(many)


def _residual(x: Column, r: Column, c: Column, n: Column) -> Column:
    """Adjusted residual of a count; null where a margin is the whole collection."""
    e = r * c / n
    var = e * (1 - r / n) * (1 - c / n)
    return F.when(var > 1e-12, (x - e) / F.sqrt(F.when(var > 1e-12, var)))


def residuals(df: DataFrame, key: str, text: str, least: int = 4, hot_share: float = 1e-4, once: bool = False, floor: int | None = None) -> DataFrame:
    """(key, term, x, n_records, expected, residual) for every term of every record.

    ``floor``: only terms whose residual is no lower than that of a term which stands in ``floor`` places altogether.
    """
    x = term_counts(df, key, text, least, once)
    margins = x.groupBy("term").agg(F.sum("x").alias("c"), F.count(F.lit(1)).alias("n_records"))
    total = margins.agg(F.sum("c").alias("n"))
    margins = margins.crossJoin(F.broadcast(total))  # one row
    is_hot = F.col("c") > F.col("n") * F.lit(hot_share)
    hot = margins.where(is_hot)  # at most 1/hot_share terms, whatever the input
    rest = margins.where(~is_hot)
    marked = x.join(F.broadcast(hot), "term", "left")
    cold = marked.where("c is null").select("key", "r", "term", "x").join(rest, "term")
    both = marked.where("c is not null").select(*cold.columns).unionByName(cold)
    r, c, n = F.col("r"), F.col("c"), F.col("n")
    residual = _residual(F.col("x"), r, c, n)
    if floor is not None:
        both = both.where(F.coalesce(residual >= _residual(F.lit(1), r, F.lit(floor).cast("bigint"), n), c <= floor))
    return both.select("key", "term", "x", "n_records", (r * c / n).alias("expected"), residual.alias("residual"))


def rare_terms(df: DataFrame, key: str, text: str, least: int = 4, most_records: int = 3) -> DataFrame:
    """(key, term, residual): the terms most characteristic of each record.

    Records count a term once. The residual of a term falls as its margin grows, so those not below the residual that
    the record's term would have in ``most_records`` records are the terms which no more records hold. In a collection
    so small that this residual does not exist the margin itself is compared.
    """
    return residuals(df, key, text, least, once=True, floor=most_records).select("key", "term", "residual")
