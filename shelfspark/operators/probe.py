r"""Retrieval probes: fixed text queries against a catalogue by a TF-IDF variant and BM25, and the trace of one record.

The variant differs from the matcher's index: frequent words are left out, letter grams need two documents and are
capped by corpus count (ties by term), and both spaces share one norm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.functions import attrs, semi, sizes
from shelfspark.functions.text import brand_text, nullify, squeeze
from shelfspark.operators import retrieval
from shelfspark.plans import match
from shelfspark.session import cut_lineage, stored

#: Phrases without meaning for a product that a name group leaves out (fixed values).
FILLERS = ("value size", "family size", "party size", "club pack", "pack of", "size may vary")


def without_labels(text: Column, labels: tuple[str, ...] = attrs.OWN_LABELS) -> Column:
    """The text less the stores' own labels, the longest first."""
    alternatives = "|".join(sorted(labels, key=len, reverse=True))
    return squeeze(F.regexp_replace(text, rf"\b(?:{alternatives})\b", " "))


def size_token(size: Column) -> Column:
    """Comparable value (four places, no trailing zeros) and unit of a profile size as one token."""
    number = F.regexp_replace(F.regexp_replace(F.format_string("%.4f", size["comparable_value"]), r"0+\z", ""), r"\.\z", "")
    return F.when(size.isNotNull(), F.concat(number, size["comparable_unit"]))


def preferred_size(name: Column, cell: Column, source: str) -> Column:
    """B prefers the size cell, A the name."""
    own, other = (sizes.best_size(sizes.all_sizes(c)) for c in ((cell, name) if source == "B" else (name, cell)))
    return F.coalesce(own, other)


def probe_text(df: DataFrame, source: str, mode: str = "brand_included", out: str = "text") -> DataFrame:
    """Brand, name, name without sizes, categories and size token; ``suppress_private_label`` leaves own labels out."""
    if mode not in ("brand_included", "suppress_private_label"):
        raise ValueError("mode is 'brand_included' or 'suppress_private_label'")
    info = semi.json_object(F.col("item_info"))
    df = df.withColumns({
        "__brand": F.coalesce(brand_text(F.col("brand_raw")), F.lit("")), "__name": squeeze(F.lower(F.coalesce("name", F.lit("")))),
        "__cell": semi.text_field(semi.json_object(F.col("sizing_comp")), "size_user_friendly"), "__info": info,
    })
    df = df.withColumn("__size", preferred_size(F.col("__name"), F.col("__cell"), source))
    parts = F.concat_ws(" ", nullify(F.col("__brand")), nullify(F.col("__name")), nullify(sizes.without_sizes(F.col("__name"))), *attrs.categories(F.col("__info")), size_token(F.col("__size")))
    text = without_labels(parts) if mode == "suppress_private_label" else parts
    return df.withColumn(out, text).drop("__brand", "__name", "__cell", "__info", "__size")


def name_group(name: Column, brand: Column) -> Column:
    """The key of duplicate-like names: brand at the start, sizes and fillers left out."""
    s = squeeze(F.lower(F.coalesce(name, F.lit(""))))
    known = F.coalesce((brand != "") & F.startswith(s, F.concat(brand, F.lit(" "))), F.lit(False))
    s = F.when(known, F.substr(s, F.char_length(brand) + 2)).otherwise(s)
    return squeeze(F.regexp_replace(sizes.without_sizes(s), r"\b(?:" + "|".join(FILLERS) + r")\b|[,;]", " "))


SPACES = ("word", "letter")


def probe_index(docs: DataFrame, text: str, max_share: float = 0.95, min_df: int = 2, most_letters: int = 250_000) -> DataFrame:
    """(term, idf): words that at most ``max_share`` of the documents hold; the most frequent letter grams of at least ``min_df``."""
    counts = cut_lineage(retrieval.term_counts(docs, text, SPACES, named=("letter",)))
    n = docs.where(F.col(text).isNotNull()).count()
    words = counts.where((F.col("space") == 0) & (F.col("df") <= max_share * n))
    letters = counts.where((F.col("space") == 1) & (F.col("df") >= min_df))
    if letters.count() > most_letters:
        letters = letters.orderBy(F.col("total").desc(), "name").limit(most_letters)
    return words.unionByName(letters).select("term", (F.log(F.lit(1.0 + n) / (1 + F.col("df"))) + 1).alias("idf"))


def probe_top_k(queries: DataFrame, docs: DataFrame, q_key: str, d_key: str, text: str, k: int, **index) -> DataFrame:
    """(a, b, score, rank) of the k best documents of each query; documents that share nothing fill up with score 0, by id.

    Up to ``retrieval.FEW_QUERIES`` queries go to the documents; more of them are joined by term.
    """
    idf = cut_lineage(probe_index(docs, text, **index))
    sent = retrieval.sent_terms(idf)
    wd, wq = (retrieval.weighted(retrieval.term_vectors(x, key, text, SPACES), idf, sent, len(SPACES), joint=True) for x, key in ((docs, d_key), (queries, q_key)))
    few = retrieval.FEW_QUERIES
    if queries.limit(few + 1).count() <= few:
        asked = wq.withColumn("block", F.lit("")).collect()
        scored = retrieval.few_top_k(asked, wd.withColumn("blocks", F.array(F.lit(""))), k, wq.schema["doc"].dataType.simpleString())
    else:
        each = [v.select("doc", F.lit("").alias("space"), F.explode(F.arrays_zip("terms", "ws")).alias("e")).select("doc", "space", F.col("e.terms").alias("term"), F.col("e.ws").alias("w")) for v in (wq, wd)]
        scored = retrieval._sql_scores(*each, [])
    scored = cut_lineage(retrieval.top_k(scored, k))
    first = docs.select(F.col(d_key).alias("b")).orderBy(F.col("b").cast("string")).limit(2 * k)  # no query lacks more than k
    unrelated = queries.select(F.col(q_key).alias("a")).crossJoin(F.broadcast(first)).join(scored.select("a", "b"), ["a", "b"], "left_anti").withColumn("score", F.lit(0.0))
    return retrieval.top_k(scored.drop("rank").unionByName(unrelated), k)


def rank_of(candidates: DataFrame, expected: DataFrame) -> DataFrame:
    """(a, b, rank or null) of the expected pairs (a, b)."""
    return expected.join(candidates.select("a", "b", "rank"), ["a", "b"], "left")


def trace(raw_a: DataFrame, raw_b: DataFrame, item_id: str, config: match.MatchConfig = match.MatchConfig()) -> DataFrame:
    """Every candidate of one A record with its rule, components and total, rejected ones too.

    The filter on the record stands before the search; the index is still fitted on all of B.
    """
    a, b = cut_lineage(match.products(raw_a.where(F.col("item_id") == item_id), "A")), stored(match.products(raw_b, "B"))
    found = cut_lineage(match.candidates(a, b, config.top_k, config.strategy))
    return match.scored_pairs(found, a, b.join(F.broadcast(found.select(F.col("b").alias("item_id")).distinct()), "item_id", "left_semi"))


def label_signals(df: DataFrame, source: str) -> DataFrame:
    """(signal, n) of rows of an own label: the brand, or the first two words of the name where there is none."""
    brand = F.coalesce(brand_text(F.col("brand_raw")), F.lit(""))
    name = squeeze(F.lower(F.coalesce("name", F.lit(""))))
    text = F.when(brand != "", brand).otherwise(name)
    own = attrs.is_own_label(text) if source == "A" else attrs.own_label_b(brand, semi.tags(F.col("tags")))
    signal = F.when(brand != "", brand).otherwise(F.substring_index(name, " ", 2))
    return df.where(own).groupBy(signal.alias("signal")).agg(F.count(F.lit(1)).alias("n"))


def first_of_each(df: DataFrame, by: Column, order: str, n: int) -> DataFrame:
    """The first n rows of each value in arrival order: examples for a report."""
    nth = F.row_number().over(Window.partitionBy("__by").orderBy(order))
    return df.withColumn("__by", by).withColumn("__n", nth).where(F.col("__n") <= n).drop("__by", "__n")
