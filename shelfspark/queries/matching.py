"""Queries of retrieval, the match run and the reports on an audit, with SQL twins where SQL can say them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfspark.operators import arbiter, calibrate, probe, retrieval, sampling, scoring, validate
from shelfspark.plans import match
from shelfspark.queries.catalogue import _json
from shelfspark.session import table

GRID_SCORES, GRID_MARGINS, FLOORS = [0.55, 0.65, 0.75, 0.8], [0.0, 0.05, 0.1], [0.55, 0.6, 0.65, 0.7, 0.75]


def _low(df: DataFrame, key: str) -> DataFrame:
    return df.select(F.col(key).alias("k"), F.lower("text").alias("text"))


def _topk(spark: SparkSession, sf_dir: str, most: int, spaces: tuple[str, ...] = ("word",)) -> DataFrame:
    items, docs = _low(table(spark, sf_dir, "eval_items"), "item_id"), _low(table(spark, sf_dir, "documents"), "doc_id")
    got = retrieval.tfidf_top_k(items, docs, "k", "k", "text", 5, spaces=spaces, word_most=most)
    return got.select(F.col("a").alias("item_id"), F.col("b").alias("doc_id"), F.round("score", 6).alias("score"), F.col("rank").cast("bigint").alias("rank"))


def tfidf_topk(spark, sf_dir):
    return _topk(spark, sf_dir, 1)


def tfidf_bigram_topk(spark, sf_dir):
    return _topk(spark, sf_dir, 2)


def letter_gram_topk(spark, sf_dir):
    b = table(spark, sf_dir, "brand_list").select(F.col("brand_id").alias("k"), F.lower("brand_name").alias("text"))
    n = table(spark, sf_dir, "mini_b").select(F.col("row_ord").alias("k"), F.lower("name").alias("text"))
    got = retrieval.tfidf_top_k(b, n, "k", "k", "text", 3, spaces=("letter",))
    return got.select(F.col("a").alias("brand_id"), F.col("b").alias("row_ord"), F.round("score", 6).alias("score"), F.col("rank").cast("bigint").alias("rank"))


def blocked_topk(spark, sf_dir):
    """Names of A against names of B within the second-level category."""
    _json(spark)
    block = F.lower(F.get_json_object("item_info", "$.category_1"))
    a = table(spark, sf_dir, "mini_a").select(F.col("row_ord").alias("k"), F.lower("name").alias("text"), block.alias("block"))
    b = table(spark, sf_dir, "mini_b").select(F.col("row_ord").alias("k"), F.lower("name").alias("text"), F.when(block.isNotNull(), F.array(block)).alias("blocks"))
    got = retrieval.tfidf_top_k(a, b, "k", "k", "text", 3, "block", "blocks", spaces=("word",), word_most=1)
    return got.select("a", "b", F.round("score", 6).alias("score"), F.col("rank").cast("bigint").alias("rank"))


def bm25_topk(spark, sf_dir):
    items, docs = table(spark, sf_dir, "eval_items").select("item_id", "text"), table(spark, sf_dir, "documents").select("doc_id", "text")
    got = retrieval.bm25_top_k(items, docs, "item_id", "doc_id", "text", 5)
    return got.select(F.col("a").alias("item_id"), F.col("b").alias("doc_id"), F.round("score", 6).alias("score"), F.col("rank").cast("bigint").alias("rank"))


PROBES = ["mint cola", "organic greek yogurt", "ocean mist hand soap", "zzz"]


def _probes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(enumerate(PROBES)), "k bigint, text string")


def probe_topk(spark, sf_dir):
    """Fixed probes against the names of B by the probe's TF-IDF."""
    docs = table(spark, sf_dir, "mini_b").where("name is not null").select(F.col("row_ord").alias("k"), F.lower("name").alias("text"))
    got = probe.probe_top_k(_probes(spark), docs, "k", "k", "text", 5)
    return got.select(F.col("a").alias("probe_id"), F.col("b").alias("row_ord"), F.round("score", 6).alias("score"), F.col("rank").cast("bigint").alias("rank"))


def probe_texts(spark, sf_dir):
    _json(spark)
    rows = table(spark, sf_dir, "mini_b")
    both = probe.probe_text(probe.probe_text(rows, "B", out="with_brand"), "B", "suppress_private_label", "without_labels")
    return both.select("row_ord", "with_brand", "without_labels")


def name_groups(spark, sf_dir):
    """Duplicate-like names of B once sizes and brands are off."""
    rows = table(spark, sf_dir, "mini_b").where("name is not null")
    brand = F.coalesce(F.lower(F.trim("brand_raw")), F.lit(""))
    return rows.select(probe.name_group(F.col("name"), brand).alias("title")).groupBy("title").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def match_trace(spark, sf_dir):
    """All candidates of the A record with the least id, rejected ones too."""
    _json(spark)
    a, b = table(spark, sf_dir, "mini_a"), table(spark, sf_dir, "mini_b")
    first = match.quarantine(a).where("quarantine_reason is null").agg(F.min("item_id").alias("i")).first()["i"]
    got = probe.trace(a, b, first or "")
    return got.select(F.col("a_id").alias("item_id_a"), F.col("b_id").alias("item_id_b"), "rank", "rejection", F.round("total", 6).alias("total"))


def idf_terms(spark, sf_dir):
    docs = _low(table(spark, sf_dir, "documents"), "doc_id")
    t = retrieval.term_table(docs, "k", "text", {"word": retrieval.words(F.col("text"))})
    idf = retrieval.idf_table(t, docs.where("text is not null").agg(F.count(F.lit(1)).alias("n")), min_df=2, max_share=0.95)
    return idf.select("term", "df", F.round("idf", 6).alias("idf"))


def token_overlap(spark, sf_dir):
    """Overlap of both names of every pair in the earlier audit."""
    m = table(spark, sf_dir, "matches_audit").where("item_id_b is not null").select("item_id_a", "item_id_b").distinct()
    names = [match.last_delivered(table(spark, sf_dir, t).select("item_id", "row_ord", "name")).select(F.col("item_id").alias(f"item_id_{s}"), F.col("name").alias(f"n{s}")) for t, s in (("mini_a", "a"), ("mini_b", "b"))]
    j = m.join(names[0], "item_id_a").join(names[1], "item_id_b")
    return j.select("item_id_a", "item_id_b", F.round(scoring.jaccard(scoring.overlap_tokens(F.col("na")), scoring.overlap_tokens(F.col("nb"))), 6).alias("overlap"))


def _audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "matches_audit").distinct()


def select_best(spark, sf_dir):
    """One partner per product of B among the A rows that the earlier audit paired with it: best score, runner-up, margin."""
    p = _audit(spark, sf_dir).where("item_id_b is not null and retrieval_score is not null")
    p = p.groupBy("item_id_b", "item_id_a").agg(F.max("score").alias("total"), F.max("retrieval_score").alias("retrieval_score"), F.max(F.when(F.col("decision") == "rejected_by_rule", F.col("reason"))).alias("rejection"))
    p = p.withColumn("rejection", F.when(F.col("total").isNull(), F.coalesce("rejection", F.lit("no_score"))))
    p = p.withColumn("rank", F.row_number().over(Window.partitionBy("item_id_b").orderBy(F.col("retrieval_score").desc(), "item_id_a")))
    best = scoring.select_best(p, "item_id_b", [F.col("item_id_a").asc()], 0.55, 0.05)
    return best.select("item_id_b", "item_id_a", F.round("total", 6).alias("score"), F.round("top1_top2_margin", 6).alias("margin"), "decision", "reason")


def match_run(spark, sf_dir):
    """The whole run over both catalogues: one decision per valid A product."""
    _json(spark)
    audit = match.run(table(spark, sf_dir, "mini_a"), table(spark, sf_dir, "mini_b"))
    return audit.withColumns({c: F.round(c, 6) for c in ("score", "retrieval_score", "top1_top2_margin")})


def match_counters(spark, sf_dir):
    return match.counters(match_run(spark, sf_dir))


def decision_shares(spark, sf_dir):
    return calibrate.shares(table(spark, sf_dir, "matches_audit"), "decision")


def reason_counts(spark, sf_dir):
    return calibrate.top_groups(table(spark, sf_dir, "matches_audit"), ["decision", "reason"])


def threshold_grid(spark, sf_dir):
    got = calibrate.threshold_grid(table(spark, sf_dir, "matches_audit"), GRID_SCORES, GRID_MARGINS, floor=50)
    return got.select("min_score", "min_margin", F.col("accepted_count").cast("bigint").alias("accepted_count"), "clears_floor")


def score_buckets(spark, sf_dir):
    return calibrate.bucket_histogram(table(spark, sf_dir, "matches_audit"))


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A label from the letters of the reason, so that every label and score occurs."""
    pick = F.element_at(F.array(*map(F.lit, calibrate.LABELS)), (F.pmod(F.char_length("reason") + F.char_length("item_id_a") + F.substring("item_id_a", -1, 1).try_cast("int"), F.lit(4)) + 1).cast("int"))
    return table(spark, sf_dir, "matches_audit").where("score is not null and item_id_a rlike '^[0-9]+$'").withColumn("label", pick)


def group_precision(spark, sf_dir):
    return calibrate.label_counts(_labelled(spark, sf_dir), ["decision"], total=True)


def cumulative_precision(spark, sf_dir):
    return calibrate.cumulative_precision(_labelled(spark, sf_dir), FLOORS)


def first_quartile(spark, sf_dir):
    return sampling.first_quartile(table(spark, sf_dir, "orders"), "o_totalprice").select(F.round("q1", 6).alias("q1"))


def bottom_quarter(spark, sf_dir):
    return sampling.bottom_quarter(table(spark, sf_dir, "matches_audit").where("decision = 'accepted'"), "score").select("item_id_a", "item_id_b", F.round("score", 6).alias("score"))


def near_miss(spark, sf_dir):
    return sampling.near_miss(_audit(spark, sf_dir), floor=0.5).select("item_id_a", "item_id_b", F.round("score", 6).alias("score"))


def round_robin(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return sampling.round_robin(d, F.col("source"), 40, ["doc_id"], order=F.col("doc_id")).select("doc_id", "source")


def round_robin_shuffled(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return sampling.round_robin(d, F.col("source"), 40, ["doc_id"], seed=7, shuffle_strata=True).select("doc_id", "source")


def random_rows(spark, sf_dir):
    return sampling.random_rows(table(spark, sf_dir, "documents"), 25, ["doc_id"], seed=3).select("doc_id")


def pinned_last(spark, sf_dir):
    m = table(spark, sf_dir, "matches_audit").where("item_id_b is not null").select("item_id_a", "item_id_b", "decision", "retrieval_score")
    pinned = m.where("decision = 'accepted'").select("item_id_a", "item_id_b", "decision", "retrieval_score")
    got = sampling.pinned_last(m, pinned, F.struct("retrieval_score", "decision"))
    return got.select("item_id_a", "item_id_b", "decision")


def required_rows(spark, sf_dir):
    wanted = table(spark, sf_dir, "mini_a").select(F.col("item_id").alias("item_id_a")).where("item_id_a is not null")
    return sampling.with_absent(_audit(spark, sf_dir), wanted).select("item_id_a", "item_id_b", "decision", "reason")


def annotation_merge(spark, sf_dir):
    m = _audit(spark, sf_dir).where("item_id_b is not null").select("item_id_a", "item_id_b", F.lit("").alias("label"), F.lit("old").alias("notes")).distinct()
    prior = m.select("item_id_a", "item_id_b", F.when(F.col("item_id_a") < "22", " Correct ").otherwise("").alias("label"), F.when(F.col("item_id_b") > "7005", "seen  ").otherwise("").alias("notes"))
    return sampling.merge_annotations(m, prior)


def cache_latest(spark, sf_dir):
    c = table(spark, sf_dir, "arbiter_cache")
    order = F.struct(F.col("meta")["ts"].alias("ts"), F.col("opinion.confidence").alias("c"), F.col("opinion.reason").alias("r"))
    got = arbiter.latest_opinions(c, order)
    return got.select("cache_key", F.col("opinion.same_product_for_customer").alias("same"), F.round("opinion.confidence", 6).alias("confidence"))


def _borderline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Below-threshold rows as candidates, keyed into the cache by order."""
    m = table(spark, sf_dir, "matches_audit").where("decision = 'below_threshold' and score is not null").groupBy("item_id_a").agg(F.max("score").alias("score"), F.min("reason").alias("grp"))
    return m.withColumn("cache_key", F.sha2(F.concat_ws("|", "item_id_a", "grp"), 256))


def arbitration_plan(spark, sf_dir):
    config = arbiter.ArbiterConfig(max_calls=40, least_per_group=30)
    c = _borderline(spark, sf_dir)
    hits = c.where(F.col("item_id_a").endswith("7")).select("cache_key", F.lit("hit").alias("opinion"))
    return arbiter.arbitration_plan(c, hits, config).where("ask or opinion is not null").select("item_id_a", "grp", "ask")


def rescue(spark, sf_dir):
    audit = _audit(spark, sf_dir)
    opinions = _borderline(spark, sf_dir).select("item_id_a", (F.col("score") > 0.5).alias("same"), F.round(F.col("score") + 0.4, 6).alias("confidence"))
    return arbiter.rescue(audit, opinions).groupBy("source", "decision", "reason").agg(F.count(F.lit(1)).alias("n"))


def pair_keys(spark, sf_dir):
    m = _audit(spark, sf_dir).where("score is not null")
    key = arbiter.cache_key(arbiter.ArbiterConfig(), [F.col("item_id_a"), F.col("item_id_b"), F.col("reason")], F.col("score"))
    return m.select("item_id_a", "item_id_b", key.alias("cache_key")).distinct()


def parsed_responses(spark, sf_dir):
    """Opinions of the cache written as responses and parsed again."""
    _json(spark)
    c = table(spark, sf_dir, "arbiter_cache").where("opinion is not null").select(F.col("opinion").alias("o"))
    fields = F.struct(F.col("o.same_product_for_customer"), F.col("o.confidence"), F.col("o.reason"), F.col("o.blocking_issue"))
    got = c.select(arbiter.parse_response(F.concat(F.lit("```json\n"), F.to_json(fields, {"ignoreNullFields": "false"}), F.lit("\n```"))).alias("p"))
    return got.groupBy((F.col("p").isNotNull()).alias("parsed"), F.col("p.same_product_for_customer").alias("same")).agg(F.count(F.lit(1)).alias("n"))


def contract_violations(spark, sf_dir):
    m = table(spark, sf_dir, "matches_audit").where("item_id_b is not null").groupBy("item_id_a", "item_id_b", "decision", "reason").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("item_id_a").orderBy("item_id_b", "decision", "reason")  # lines of an id, counted from 2
    pairs = m.withColumn("line_no", (F.row_number().over(order) + 1).cast("bigint"))
    ids = [match.quarantine(table(spark, sf_dir, t)).where("quarantine_reason is null").select("item_id") for t in ("mini_a", "mini_b")]
    return validate.violations(pairs, *ids).select("line_no", "kind", "item_id_a", "item_id_b", "expected")


QUERIES = {f.__name__: f for f in (
    tfidf_topk, tfidf_bigram_topk, letter_gram_topk, blocked_topk, bm25_topk, probe_topk, probe_texts, name_groups, match_trace, idf_terms, token_overlap, select_best, match_run, match_counters, decision_shares,
    reason_counts, threshold_grid, score_buckets, group_precision, cumulative_precision, first_quartile, bottom_quarter, near_miss, round_robin,
    round_robin_shuffled, random_rows, pinned_last, required_rows, annotation_merge, cache_latest, arbitration_plan, rescue, pair_keys, parsed_responses,
    contract_violations,
)}

# --- SQL twins ------------------------------------------------------------------------------------------------
_WORD = r"[\p{L}\p{N}_]{2,}"


def _tfidf(a: str, b: str, grams: str, k: int, ra: str, rb: str, block: bool = False) -> str:
    on = "using (term, block)" if block else "using (term)"
    bl = ", block" if block else ""
    return f"""with a0 as ({a}), b0 as ({b}), n as (select count(*) as n from b0 where regexp_matches(text, '\\S')),
    ag as (select k{bl}, unnest({grams}) as term from a0), bg as (select k{bl}, unnest({grams}) as term from b0),
    ac as (select k{bl}, term, count(*) as tf from ag group by all), bt as (select k{bl}, term, count(*) as tf from bg group by all),
    idf as (select term, ln((1 + n) / (1 + count(*)))+1 as idf from bt, n group by term, n),
    aw as (select k{bl}, term, (1 + ln(tf)) * idf as v from ac join idf using (term)), bw as (select k{bl}, term, (1 + ln(tf)) * idf as v from bt join idf using (term)),
    an as (select k, sqrt(sum(v * v)) as s from aw group by k), bn as (select k, sqrt(sum(v * v)) as s from bw group by k),
    p as (select aw.k as a, bw.k as b, sum(aw.v * bw.v) as dot from aw join bw {on} group by 1, 2),
    s as (select a, b, dot / an.s / bn.s as score from p join an on an.k = a join bn on bn.k = b),
    r as (select *, row_number() over (partition by a order by round(score, 12) desc, b::varchar) as rank from s)
    select a as {ra}, b as {rb}, round(score, 6) as score, rank from r where rank <= {k}"""


_WORDS = f"regexp_extract_all(text, '{_WORD}')"
_BIGRAMS = "list_concat(w, list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1]))"
_PADS = "list_transform(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> ''), lambda w: ' ' || w || ' ')"
_LETTERS = (
    f"flatten(list_transform({_PADS}, lambda p: flatten(list_transform(list_filter([3, 4, 5], lambda n: n = 3 or length(p) > n - 1), "
    "lambda n: list_transform(range(1, greatest(length(p) - n + 1, 1) + 1), lambda i: substr(p, i, n))))))"
)
_EVAL, _DOCS = "select item_id as k, lower(text) as text from eval_items", "select doc_id as k, lower(text) as text from documents"
_LABEL = "list_extract(['correct', 'wrong', 'partial', 'unsure'], (length(reason) + length(item_id_a) + right(item_id_a, 1)::int) % 4 + 1)"
_LABELLED = f"(select *, {_LABEL} as label from matches_audit where score is not null and regexp_full_match(item_id_a, '[0-9]+'))"
_LAST = "select item_id, arg_max(name, row_ord) as name from {t} group by item_id"
_COUNTS = "count(*) as n, count(*) filter (label = 'correct') as correct, count(*) filter (label = 'wrong') as wrong, count(*) filter (label = 'partial') as partial, count(*) filter (label = 'unsure') as unsure"
_TOKENS = "list_filter(list_distinct(regexp_split_to_array(lower({c}), '\\s+')), lambda t: t <> '' and not regexp_full_match(t, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)(e[+-]?[0-9]+)?|nan|inf|infinity') and t not in ({u}))"
_UNITS = ", ".join(f"'{u}'" for u in scoring.UNIT_WORDS)
_TA, _TB = (_TOKENS.format(c=c, u=_UNITS) for c in ("na", "nb"))
_BUCKET = "case " + " ".join(f"when score >= {lo} and score < {hi} then '{n}'" for n, lo, hi in calibrate.BUCKETS) + " end"
_BORDER = "(select item_id_a, max(score) as score, min(reason) as grp from matches_audit where decision = 'below_threshold' and score is not null group by item_id_a)"
_AUDIT = "(select distinct * from matches_audit)"
_VALID = "(select item_id from {t} where regexp_full_match(coalesce(item_id, ''), '[0-9]+') and not regexp_full_match(coalesce(name, ''), '[\\s\\x{{000B}}\\x{{0085}}\\p{{Z}}]*') group by item_id)"

_PROBES = " union all ".join(f"select {i} as k, '{t}' as text" for i, t in enumerate(PROBES))
SQL = {
    "probe_topk": f"""with a0 as ({_PROBES}), b0 as (select row_ord as k, lower(name) as text from mini_b where name is not null), n as (select count(*) as n from b0),
    a1 as (select k, text, {_WORDS} as w from a0), b1 as (select k, text, {_WORDS} as w from b0),
    ag as (select k, 'w' as sp, unnest({_BIGRAMS}) as term from a1 union all select k, 'l', unnest({_LETTERS}) from a1), bg as (select k, 'w' as sp, unnest({_BIGRAMS}) as term from b1 union all select k, 'l', unnest({_LETTERS}) from b1),
    ac as (select k, sp, term, count(*) as tf from ag group by all), bc as (select k, sp, term, count(*) as tf from bg group by all),
    d as (select sp, term, count(*) as df, sum(tf) as total from bc group by all), r as (select *, row_number() over (partition by sp order by total desc, term) as nth from d where sp = 'w' or df >= 2),
    idf as (select sp, term, ln((1 + n) / (1 + df)) + 1 as idf from r, n where (sp = 'w' and df <= 0.95 * n) or (sp = 'l' and nth <= 250000)),
    aw as (select k, sp, term, (1 + ln(tf)) * idf as v from ac join idf using (sp, term)), bw as (select k, sp, term, (1 + ln(tf)) * idf as v from bc join idf using (sp, term)),
    an as (select k, sqrt(sum(v * v)) as s from aw group by k), bn as (select k, sqrt(sum(v * v)) as s from bw group by k),
    p as (select aw.k as a, bw.k as b, sum(aw.v * bw.v) as dot from aw join bw using (sp, term) group by 1, 2),
    s as (select a, b, dot / an.s / bn.s as score from p join an on an.k = a join bn on bn.k = b),
    f as (select a, b, score from s union all select a0.k, b0.k, 0 from a0, b0 where not exists (select 1 from s where s.a = a0.k and s.b = b0.k)),
    q as (select *, row_number() over (partition by a order by round(score, 12) desc, b::varchar) as rank from f)
    select a as probe_id, b as row_ord, round(score, 6) as score, rank from q where rank <= 5""",
    "tfidf_topk": _tfidf(_EVAL, _DOCS, _WORDS, 5, "item_id", "doc_id"),
    "tfidf_bigram_topk": _tfidf(f"select *, {_WORDS} as w from ({_EVAL})", f"select *, {_WORDS} as w from ({_DOCS})", _BIGRAMS, 5, "item_id", "doc_id"),
    "letter_gram_topk": _tfidf("select brand_id as k, lower(brand_name) as text from brand_list", "select row_ord as k, lower(name) as text from mini_b where name is not null", _LETTERS, 3, "brand_id", "row_ord"),
    "blocked_topk": _tfidf(
        "select row_ord as k, lower(name) as text, lower(case when json_valid(item_info) then item_info->>'$.category_1' end) as block from mini_a where name is not null",
        "select row_ord as k, lower(name) as text, lower(case when json_valid(item_info) then item_info->>'$.category_1' end) as block from mini_b where name is not null", _WORDS, 3, "a", "b", True,
    ),
    "bm25_topk": f"""with q as (select item_id as a, unnest(regexp_extract_all(lower(text), '{_WORD}')) as term from eval_items), qt as (select a, term, count(*) as qtf from q group by all),
    d as (select doc_id as b, unnest(regexp_extract_all(lower(text), '{_WORD}')) as term from documents), t as (select b, term, count(*) as tf from d group by all),
    len as (select b, sum(tf) as len from t group by b), n as (select count(*) as n, (select sum(len) from len) as total from documents where text is not null),
    raw as (select term, ln((n - count(*) + 0.5) / (count(*) + 0.5)) as raw from t, n group by term, n), f as (select avg(raw) * 0.25 as floor from raw),
    idf as (select term, case when raw < 0 then floor else raw end as idf from raw, f),
    s as (select a, b, sum(qtf * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len / (total / n)))) as score from qt join idf using (term) join t using (term) join len using (b), n group by a, b),
    r as (select *, row_number() over (partition by a order by round(score, 12) desc, b::varchar) as rank from s)
    select a as item_id, b as doc_id, round(score, 6) as score, rank from r where rank <= 5""",
    "idf_terms": f"""with d as (select doc_id, unnest(list_distinct(regexp_extract_all(lower(text), '{_WORD}'))) as term from documents), n as (select count(*) as n from documents where text is not null)
    select term, count(*) as df, round(ln((1 + n) / (1 + count(*))) + 1, 6) as idf from d, n group by term, n having count(*) >= 2 and count(*) <= 0.95 * n""",
    "token_overlap": f"""with m as (select distinct item_id_a, item_id_b from matches_audit where item_id_b is not null),
    j as (select item_id_a, item_id_b, a.name as na, b.name as nb from m join ({_LAST.format(t='mini_a')}) a on a.item_id = item_id_a join ({_LAST.format(t='mini_b')}) b on b.item_id = item_id_b),
    t as (select item_id_a, item_id_b, coalesce({_TA}, []) as ta, coalesce({_TB}, []) as tb from j)
    select item_id_a, item_id_b, round(case when len(ta) = 0 or len(tb) = 0 then 0 else len(list_intersect(ta, tb))::double / len(list_distinct(list_concat(ta, tb))) end, 6) as overlap from t""",
    "select_best": f"""with p as (select item_id_b, item_id_a, max(score) as total, max(retrieval_score) as rs, max(case when decision = 'rejected_by_rule' then reason end) as rej from {_AUDIT}
        where item_id_b is not null and retrieval_score is not null group by 1, 2),
    q as (select *, case when total is null then coalesce(rej, 'no_score') end as rejection, row_number() over (partition by item_id_b order by rs desc, item_id_a) as rank from p),
    o as (select *, row_number() over w as pick, lead(total) over w as second from q window w as (partition by item_id_b order by (rejection is null)::int desc, case when rejection is not null then rank end nulls last, -round(total, 12), item_id_a))
    select item_id_b, item_id_a, round(total, 6) as score, round(total - second, 6) as margin,
    case when rejection is not null then 'rejected_by_rule' when total < 0.55 then 'below_threshold' when total - second < 0.05 then 'below_threshold' else 'accepted' end as decision,
    case when rejection is not null then rejection when total < 0.55 then 'below_min_score' when total - second < 0.05 then 'below_min_margin' else 'ok' end as reason from o where pick = 1""",
    "decision_shares": "select decision, count(*) as n, round(100.0 * count(*) / sum(count(*)) over (), 2)::double as share_pct from matches_audit group by decision",
    "reason_counts": "select decision, reason, count(*) as n from matches_audit group by all order by n desc, decision nulls last, reason nulls last limit 30",
    "threshold_grid": f"""with g as (select s::double as min_score, m::double as min_margin from unnest({GRID_SCORES}) x(s), unnest({GRID_MARGINS}) y(m)),
    r as (select * from matches_audit where decision in ('accepted', 'below_threshold') and score is not null)
    select min_score, min_margin, count(*) filter (score >= min_score and (top1_top2_margin is null or top1_top2_margin >= min_margin)) as accepted_count,
    count(*) filter (score >= min_score and (top1_top2_margin is null or top1_top2_margin >= min_margin)) >= 50 as clears_floor from r, g group by 1, 2""",
    "score_buckets": f"select {_BUCKET} as bucket, count(*) as n from matches_audit where decision = 'accepted' group by 1",
    "group_precision": f"select decision, {_COUNTS}, round(correct / nullif(correct + wrong + partial, 0), 6) as precision from {_LABELLED} group by rollup (decision)",
    "cumulative_precision": f"""select floor, count(*) filter (score >= floor and label <> 'unsure') as n, count(*) filter (score >= floor and label = 'correct') as correct,
    round(count(*) filter (score >= floor and label = 'correct') / nullif(count(*) filter (score >= floor and label <> 'unsure'), 0), 6) as precision from {_LABELLED}, (select f::double as floor from unnest({FLOORS}) x(f)) group by floor""",
    "first_quartile": """with v as (select o_totalprice as v, row_number() over (order by o_totalprice) as i, count(*) over () as n from orders where o_totalprice is not null),
    p as (select floor((n + 1) / 4.0) as j, (n + 1) / 4.0 - floor((n + 1) / 4.0) as g from v limit 1)
    select round(max(case when i = j then v end) + (max(case when i = j + 1 then v end) - max(case when i = j then v end)) * max(g), 6) as q1 from v, p""",
    "bottom_quarter": """with v as (select *, row_number() over (order by score) as i, count(*) over () as n from matches_audit where decision = 'accepted' and score is not null),
    p as (select floor((n + 1) / 4.0) as j, (n + 1) / 4.0 - floor((n + 1) / 4.0) as g from v limit 1),
    q as (select max(case when i = j then score end) + (max(case when i = j + 1 then score end) - max(case when i = j then score end)) * max(g) as q1 from v, p)
    select item_id_a, item_id_b, round(score, 6) as score from v, q where score <= q1""",
    "near_miss": f"""with near as (select * from {_AUDIT} where decision = 'below_threshold' and coalesce(score, 0) >= 0.5)
    (select item_id_a, item_id_b, round(score, 6) as score from near where top1_top2_margin is not null order by top1_top2_margin, item_id_a, item_id_b limit 20)
    union all (select item_id_a, item_id_b, round(score, 6) as score from near where top1_top2_margin is null order by near.score desc, item_id_a, item_id_b limit 10)""",
    "round_robin": """select doc_id, source from (select doc_id, source, row_number() over (partition by source order by doc_id) as n from documents) order by n, source nulls last, doc_id limit 40""",
    "pinned_last": """with m as (select item_id_a, item_id_b, decision, retrieval_score from matches_audit where item_id_b is not null), pin as (select * from m where decision = 'accepted'),
    r as (select m.*, row_number() over (partition by item_id_a, item_id_b order by retrieval_score nulls first, decision nulls first) as n from m where not exists (select 1 from pin where pin.item_id_a = m.item_id_a and pin.item_id_b = m.item_id_b))
    select item_id_a, item_id_b, decision from r where n = 1 union all select item_id_a, item_id_b, decision from pin""",
    "required_rows": f"""select w.item_id_a, item_id_b, coalesce(decision, 'absent_from_audit') as decision, case when decision is null then 'absent_from_audit' else reason end as reason
    from (select distinct item_id as item_id_a from mini_a where item_id is not null) w left join {_AUDIT} a on a.item_id_a = w.item_id_a""",
    "annotation_merge": """with m as (select distinct item_id_a, item_id_b from matches_audit where item_id_b is not null)
    select item_id_a, item_id_b, case when item_id_a < '22' then 'correct' else '' end as label, case when item_id_b > '7005' then 'seen' else 'old' end as notes, item_id_a < '22' or item_id_b > '7005' as merged from m""",
    "cache_latest": """select cache_key, o.same_product_for_customer as same, round(o.confidence, 6) as confidence from (select cache_key, arg_max(opinion, row(meta['ts'], opinion.confidence, opinion.reason)) as o from arbiter_cache
    where cache_key is not null and opinion is not null and not coalesce(opinion.parse_error, false) and opinion.same_product_for_customer is not null and opinion.confidence is not null group by cache_key)""",
    "arbitration_plan": f"""with c as (select item_id_a, score, coalesce(grp, 'unknown') as grp from {_BORDER}), n as (select greatest(30, floor(40 / count(distinct grp))) as cap from c),
    k as (select *, row_number() over (partition by grp order by score desc, item_id_a) as nth from c), kept as (select k.*, item_id_a like '%7' as hit from k, n where nth <= cap),
    miss as (select item_id_a from kept where not hit order by score desc, item_id_a limit 40)
    select item_id_a, grp, item_id_a in (select item_id_a from miss) as ask from kept where hit or item_id_a in (select item_id_a from miss)""",
    "rescue": f"""with o as (select item_id_a, score > 0.5 as same, round(score + 0.4, 6) as c from {_BORDER}),
    j as (select a.*, coalesce(same and c >= 0.85 and decision = 'below_threshold' and coalesce(item_id_b, '') <> '', false) as saved from {_AUDIT} a left join o using (item_id_a))
    select case when saved then 'llm_rescued' else source end as source, case when saved then 'accepted' else decision end as decision, case when saved then 'llm_rescue_' || reason else reason end as reason, count(*) as n from j group by all""",
    "pair_keys": f"""select distinct item_id_a, item_id_b, sha256(concat_ws('|', 'v1', 'none', coalesce(item_id_a, ''), coalesce(item_id_b, ''), coalesce(reason, ''), printf('%.4f', round(score::decimal(20, 10), 4)))) as cache_key from {_AUDIT} where score is not null""",
    "contract_violations": f"""with m as (select *, row_number() over (partition by item_id_a order by item_id_b nulls first, decision nulls first, reason nulls first) + 1 as line_no from (select item_id_a, item_id_b, decision, reason from matches_audit where item_id_b is not null group by all)),
    r as (select m.*, row_number() over w as nth, first_value(item_id_b) over w as first_b, a.item_id is not null as in_a, b.item_id is not null as in_b from m left join {_VALID.format(t='mini_a')} a on a.item_id = item_id_a left join {_VALID.format(t='mini_b')} b on b.item_id = item_id_b window w as (partition by item_id_a order by line_no))
    select line_no, 'non_numeric_a' as kind, item_id_a, item_id_b, null::varchar as expected from r where not regexp_full_match(coalesce(item_id_a, ''), '[0-9]+')
    union all select line_no, 'unknown_a', item_id_a, item_id_b, null from r where regexp_full_match(coalesce(item_id_a, ''), '[0-9]+') and not in_a
    union all select line_no, 'non_numeric_b', item_id_a, item_id_b, null from r where not regexp_full_match(coalesce(item_id_b, ''), '[0-9]+')
    union all select line_no, 'unknown_b', item_id_a, item_id_b, null from r where regexp_full_match(coalesce(item_id_b, ''), '[0-9]+') and not in_b
    union all select line_no, 'duplicate_a', item_id_a, item_id_b, first_b from r where nth > 1""",
}
