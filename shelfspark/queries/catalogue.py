"""Queries of the catalogue operators: reading, cleaning, sizes, groups, profiles. Each has a SQL twin where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.functions import attrs, semi, sizes, taxonomy
from shelfspark.functions import text as tx
from shelfspark.operators import profile
from shelfspark.operators.normalize import normalize
from shelfspark.plans import match
from shelfspark.session import table

JSON_COLUMNS = ["item_info", "sizing_comp"]


def _both(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    a, b = (table(spark, sf_dir, t).select("row_ord", *columns) for t in ("mini_a", "mini_b"))
    return a.unionByName(b)


def _json(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")  # as in most parsers, the last one stands


def quarantine_split(spark, sf_dir):
    rows = match.quarantine(_both(spark, sf_dir, "item_id", "name"))
    return rows.where("quarantine_reason is not null").select("row_ord", "quarantine_reason")


def last_delivery(spark, sf_dir):
    rows = match.quarantine(table(spark, sf_dir, "mini_b").select("row_ord", "item_id", "name")).where("quarantine_reason is null")
    return match.last_delivered(rows).select("item_id", "row_ord", "name")


def blank_profile(spark, sf_dir):
    a = table(spark, sf_dir, "mini_a")
    return profile.blank_profile(a, [c for c in a.columns if c != "row_ord"])


def json_health(spark, sf_dir):
    _json(spark)
    return profile.json_health(_both(spark, sf_dir, *JSON_COLUMNS), JSON_COLUMNS)


def json_key_counts(spark, sf_dir):
    _json(spark)
    return profile.json_keys(_both(spark, sf_dir, "item_info"), "item_info")


def article_numbers(spark, sf_dir):
    _json(spark)
    rows = _both(spark, sf_dir, "item_info").select(F.regexp_replace("item_info", '"ic_item_id"', '"upc"').alias("item_info"))
    return profile.code_stats(rows, "item_info")


def tag_lists(spark, sf_dir):
    tags = table(spark, sf_dir, "mini_b").select("row_ord", F.posexplode(semi.tags(F.col("tags"))).alias("pos", "tag"))
    return tags.select("row_ord", (F.col("pos") + 1).cast("bigint").alias("pos"), "tag")


def tag_stats(spark, sf_dir):
    t = table(spark, sf_dir, "mini_b").select("tags", F.size(semi.tags(F.col("tags"))).alias("n"))
    s = F.trim("tags")
    return t.agg(
        F.count_if(F.col("n") > 0).alias("non_empty"), profile.count_if((F.col("n") > 0) & s.startswith("{")).alias("brace_style"),
        profile.count_if((F.col("n") > 0) & s.startswith("[")).alias("bracket_style"),
    )


def text_normalize(spark, sf_dir):
    r = _both(spark, sf_dir, "name", "brand_raw")
    return r.select("row_ord", tx.brand_text(F.col("brand_raw")).alias("brand_norm"), tx.prefix_text(F.col("name")).alias("prefix_form"), tx.category_text(F.col("name")).alias("category_form"))


def folded_names(spark, sf_dir):
    return _both(spark, sf_dir, "name").select("row_ord", tx.fold_ascii(F.col("name")).alias("folded"))


def category_groups(spark, sf_dir):
    _json(spark)
    out = []
    for t, rules in (("mini_a", taxonomy.RULES_A), ("mini_b", taxonomy.RULES_B)):
        c = attrs.categories(semi.json_object(F.col("item_info")))
        rows = table(spark, sf_dir, t).select(F.lit(t).alias("source"), *(x.alias(f"c{i}") for i, x in enumerate(c)))
        out.append(taxonomy.with_group(rows, rules, "grp", ("c0", "c1", "c2")).select("source", "grp"))
    return out[0].unionByName(out[1]).groupBy("source", "grp").agg(F.count(F.lit(1)).alias("n"))


def category_triples(spark, sf_dir):
    _json(spark)
    c = attrs.categories(semi.json_object(F.col("item_info")))
    return table(spark, sf_dir, "mini_a").select(*(x.alias(f"c{i}") for i, x in enumerate(c))).groupBy("c0", "c1", "c2").agg(F.count(F.lit(1)).alias("n"))


def sizes_of_names(spark, sf_dir):
    s = sizes.size_in_text(F.col("name"))
    return _both(spark, sf_dir, "name").select("row_ord", s.alias("s")).where("s is not null").select("row_ord", "s.unit", "s.unit_size", "s.pack_count", F.round("s.total_size", 6).alias("total_size"))


def sizes_of_rows(spark, sf_dir):
    _json(spark)
    a, b = (sizes.with_size(table(spark, sf_dir, t).select("row_ord", "name", "sizing_comp"), x, out="s") for t, x in (("mini_a", "A"), ("mini_b", "B")))
    base = sizes.base_size(F.col("s"))
    return a.unionByName(b).select("row_ord", "s.unit", "s.unit_size", "s.pack_count", base["family"].alias("family"), F.round(base["value"], 6).alias("base_value"))


def size_stats(spark, sf_dir):
    _json(spark)
    return profile.size_stats(_both(spark, sf_dir, "name", "sizing_comp", "description"))


def pattern_counters(spark, sf_dir):
    d = _both(spark, sf_dir, "name", "description")
    return d.agg(
        F.count(F.lit(1)).alias("n_rows"), profile.count_if(F.col("name").rlike(profile.PACK_HEAD)).alias("pack_heads"),
        profile.count_if(F.col("name").rlike(profile.MULTIPACK)).alias("multipacks"), profile.count_if(F.col("name").rlike(profile.DIMENSION)).alias("dimensions"),
        profile.count_if(F.col("description").rlike(profile.MARKUP)).alias("markup"), profile.count_if(~tx.is_missing(F.col("description"))).alias("descriptions"),
    )


def core_names(spark, sf_dir):
    b = table(spark, sf_dir, "mini_b").select("row_ord", F.coalesce("name", F.lit("")).alias("name"), F.coalesce(tx.brand_text(F.col("brand_raw")), F.lit("")).alias("brand"))
    return b.select("row_ord", attrs.core_name(F.col("name"), F.col("brand")).alias("core_name"))


def attributes_of_names(spark, sf_dir):
    n = F.col("name")
    r = _both(spark, sf_dir, "name").where("name is not null")
    return r.select("row_ord", attrs.first_word(n, attrs.STORAGE_WORDS).alias("storage"), attrs.first_word(n, attrs.FORM_WORDS).alias("form"), attrs.first_word(n, attrs.FLAVOR_WORDS).alias("flavor"), F.lower(n).contains("organic").alias("organic"))


def normalized_rows(spark, sf_dir):
    _json(spark)
    a, b = (normalize(table(spark, sf_dir, t), s) for t, s in (("mini_a", "A"), ("mini_b", "B")))
    flat = a.unionByName(b)
    return flat.select("row_ord", "source", "brand_norm", "is_private_label", "brand_inferred", "is_organic", "storage_type", "form", "flavor", "category_0", "core_name", "retrieval_text", "matchable_group")


def known_brands(spark, sf_dir):
    """The listed brand that a name begins with, the longest of these; beginnings of names are joined to the whole list."""
    listed = table(spark, sf_dir, "brand_list").select(F.lower(F.trim("brand_name")).alias("brand")).where("brand <> ''").distinct()
    most = listed.agg(F.max(F.size(F.split("brand", " ")))).first()[0] or 1
    words = F.split(tx.prefix_text(F.col("name")), " ")
    starts = F.transform(F.sequence(F.lit(1), F.least(F.size(words), F.lit(most))), lambda n: F.array_join(F.slice(words, 1, n), " "))
    r = _both(spark, sf_dir, "name").where("name is not null")
    own = r.select("row_ord", attrs.brand_of_name(F.col("name"), labels=("great value",)).alias("brand")).where("brand is not null")
    found = r.select("row_ord", F.explode(starts).alias("brand")).join(listed, "brand").groupBy("row_ord").agg(F.max_by("brand", F.char_length("brand")).alias("brand"))
    return own.unionByName(found.join(own, "row_ord", "left_anti"))


def duplicate_ids(spark, sf_dir):
    return profile.duplicate_ids(_both(spark, sf_dir, "item_id")).select("item_id", F.col("repeats").cast("bigint").alias("repeats"))


def duplicate_groups(spark, sf_dir):
    key = [tx.brand_text(F.col("brand_raw")), tx.squeeze(F.lower(F.col("name")))]
    r = _both(spark, sf_dir, "name", "brand_raw", "item_id").where("name is not null and brand_raw is not null")
    return profile.duplicate_groups(r, key, F.col("item_id")).select(F.col("k0").alias("brand"), F.col("k1").alias("title"), "n_rows", F.array_join("items", ",").alias("items"))


def top_brands(spark, sf_dir):
    return profile.top_values(_both(spark, sf_dir, "brand_raw"), tx.brand_text(F.col("brand_raw")), 25, "brand")


def shared_brands(spark, sf_dir):
    a, b = table(spark, sf_dir, "mini_a"), table(spark, sf_dir, "mini_b")
    v = tx.brand_text(F.col("brand_raw"))
    return profile.shared_values(a, b, v, v).withColumnRenamed("value", "brand")


def bad_id_examples(spark, sf_dir):
    return profile.bad_ids(table(spark, sf_dir, "mini_a"))[1]


def keyword_hits(spark, sf_dir):
    low = F.lower("name")
    hit = F.when(low.contains("yogurt") & low.contains("honey"), F.lit("honey yogurt")).when(low.contains("organic") & low.contains("tomato sauce"), F.lit("organic tomato sauce"))
    return _both(spark, sf_dir, "name").select(hit.alias("probe")).where("probe is not null").groupBy("probe").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {f.__name__: f for f in (
    quarantine_split, last_delivery, blank_profile, json_health, json_key_counts, article_numbers, tag_lists, tag_stats, text_normalize, folded_names,
    category_groups, category_triples, sizes_of_names, sizes_of_rows, size_stats, pattern_counters, core_names, attributes_of_names, normalized_rows,
    known_brands, duplicate_ids, duplicate_groups, top_brands, shared_brands, bad_id_examples, keyword_hits,
)}

# --- SQL twins ------------------------------------------------------------------------------------------------
_W = r"[\s\x{000B}\x{0085}\p{Z}]"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^{_W}+|{_W}+$', '', 'g')"


def _squeeze(c: str) -> str:
    return f"regexp_replace({_strip(c)}, '{_W}+', ' ', 'g')"


def _cat(c: str) -> str:
    return _squeeze(f"regexp_replace(replace(lower({c}), '&', ' and '), '[,;./]', ' ', 'g')")


def _missing(c: str) -> str:
    return f"coalesce(lower({_strip(c)}), '') in ('', 'null', 'none', 'nan', '[]', '{{}}')"


def _obj(c: str) -> str:
    return f"case when json_valid({c}) and json_type({c}) = 'OBJECT' then {c} end"


def _attr(c: str, key: str) -> str:
    return f"nullif(lower({_strip(f'''case when json_type({_obj(c)}, '$.{key}') = 'VARCHAR' then json_extract_string({_obj(c)}, '$.{key}') end''')}), '')"


def group_sql(rules: tuple[taxonomy.Rule, ...], c0: str, c1: str, c2: str) -> str:
    out = []
    for r in rules:
        cond = f"{c0} = {_q(r.first)}"
        if r.second is not None:
            cond += f" and {c1} in ({', '.join(map(_q, r.second))})"
        if r.words:
            cond += " and (" + " or ".join(f"contains({c2}, {_q(w)})" for w in r.words) + ")"
        if r.thirds:
            cond += f" and {c2} in ({', '.join(map(_q, r.thirds))})"
        out.append(f"when {cond} then {_q(r.group)}")
    return "case " + " ".join(out) + " end"


def _unit_sql(raw: str) -> str:
    key = f"regexp_replace(lower(regexp_replace({_strip(raw)}, '\\.+$', '')), '\\s+', ' ', 'g')"
    return "case " + key + " " + " ".join(f"when {_q(k)} then {_q(v)}" for k, v in sizes.UNITS.items()) + " end"


def _part(c: str, pattern: str, g: int) -> str:
    return f"nullif(regexp_extract({c}, {_q(pattern)}, {g}), '')"


_BOTH = "(select row_ord, item_id, name, brand_raw, item_info, sizing_comp, tags, description from mini_a union all select row_ord, item_id, name, brand_raw, item_info, sizing_comp, tags, description from mini_b)"
_FIRST = lambda c, t: "case " + " ".join(f"when regexp_matches({c}, {_q(f'(?i)\\b(?:{p})\\b')}) then {_q(x)}" for x, p in t) + " end"
_AC = [f"coalesce({_cat(_attr('item_info', f'category_{i}'))}, '')" for i in range(3)]
_A_NAMES = [c for c in (
    "item_id name brand_raw name_clean description category department url item_type item_info tags subcategory is_private_label sizing_comp size_raw "
    "datapoint_id raw_data_id created_at_utc updated_at_utc"
).split()]

SQL = {
    "quarantine_split": f"""select row_ord, r as quarantine_reason from (select row_ord, case when not regexp_full_match(coalesce(item_id, ''), '[0-9]+') then 'non_numeric_item_id'
        when regexp_full_match(coalesce(name, ''), '{_W}*') then 'blank_name' end as r from {_BOTH}) where r is not null""",
    "last_delivery": f"""select item_id, row_ord, name from (select *, row_number() over (partition by item_id order by row_ord desc) as n from mini_b
        where regexp_full_match(coalesce(item_id, ''), '[0-9]+') and not regexp_full_match(coalesce(name, ''), '{_W}*')) where n = 1""",
    "blank_profile": " union all ".join(
        f"select {_q(c)} as column_name, count(*) as n_rows, count(*) filter ({_missing(c)}) as blank_count, round(100.0 * count(*) filter ({_missing(c)}) / count(*), 2)::double as blank_rate from mini_a" for c in _A_NAMES
    ),
    "json_health": " union all ".join(
        f"""select {_q(c)} as field, s as status, count(*) as n from (select case when regexp_full_match(coalesce({c}, ''), '{_W}*') then 'blank' when not json_valid({c}) then 'invalid'
        when json_type({c}) = 'OBJECT' then 'valid_dict' else 'valid_other' end as s from {_BOTH}) group by s""" for c in JSON_COLUMNS
    ),
    "json_key_counts": f"select key, count(*) as n from (select unnest(json_keys({_obj('item_info')})) as key from {_BOTH}) group by key",
    "text_normalize": f"""select row_ord, lower({_squeeze('brand_raw')}) as brand_norm, {_squeeze("translate(lower(name), '-''', '  ')")} as prefix_form, {_cat('name')} as category_form from {_BOTH}""",
    "category_groups": " union all ".join(
        f"select {_q(t)} as source, grp, count(*) as n from (select {group_sql(rules, *_AC)} as grp from {t}) group by grp" for t, rules in (("mini_a", taxonomy.RULES_A), ("mini_b", taxonomy.RULES_B))
    ),
    "category_triples": f"select {_attr('item_info', 'category_0')} as c0, {_attr('item_info', 'category_1')} as c1, {_attr('item_info', 'category_2')} as c2, count(*) as n from mini_a group by all",
    "sizes_of_names": f"""with p as (select row_ord, {_unit_sql(_part('name', sizes.PACK_OF, 3))} as pu, {_part('name', sizes.PACK_OF, 2)} as ps, {_part('name', sizes.PACK_OF, 1)} as pn,
        {_unit_sql(_part('name', sizes.PLAIN, 2))} as u, {_part('name', sizes.PLAIN, 1)} as s from {_BOTH})
        select row_ord, coalesce(pu, u) as unit, case when pu is not null then ps else s end::double as unit_size, case when pu is not null then pn::int else 1 end as pack_count,
        round(case when pu is not null then pn::int * ps::double else s::double end, 6) as total_size from p where coalesce(pu, u) is not null""",
    "sizes_of_rows": f"""with r as (select 'A' as src, row_ord, {_strip("coalesce(name, '')")} as s, sizing_comp from mini_a union all select 'B', row_ord, '', sizing_comp from mini_b),
        t as (select src, row_ord, coalesce({_part('s', sizes.PACK_HEAD, 1)}::int, 1) as packs, {_strip(f"regexp_replace(s, {_q(sizes.PACK_HEAD)}, '')")} as rest,
          case when json_type({_obj('sizing_comp')}, '$.size_user_friendly') = 'VARCHAR' then json_extract_string({_obj('sizing_comp')}, '$.size_user_friendly') end as c from r),
        u as (select *, {_unit_sql(_part('rest', sizes.PLAIN, 2))} as nu, {_part('rest', sizes.PLAIN, 1)}::double as nn, {_unit_sql(_part('c', sizes.PACK_OF, 3))} as pu, {_part('c', sizes.PACK_OF, 2)}::double as pn,
          {_part('c', sizes.PACK_OF, 1)}::int as pp, {_unit_sql(_part('c', sizes.PLAIN, 2))} as cu, {_part('c', sizes.PLAIN, 1)}::double as cn from t),
        v as (select row_ord, case when nu is not null then nu else coalesce(pu, cu) end as unit, case when nu is not null then nn when pu is not null then pn when cu is not null then cn end as unit_size,
          case when nu is not null then packs when pu is not null and pp <> 1 then pp else packs end as pack_count from u),
        f as (select *, {"case unit " + " ".join(f"when '{k}' then '{x}'" for k, (x, _) in sizes.FAMILIES.items()) + " end"} as family, {"case unit " + " ".join(f"when '{k}' then {x}" for k, (_, x) in sizes.FAMILIES.items()) + " end"} as factor from v)
        select row_ord, unit, unit_size, pack_count, case when unit_size is not null then family end as family, round(pack_count * unit_size * factor::double, 6) as base_value from f""",
    "tag_stats": """with t as (select trim(tags) as s, len(list_filter(string_split(case when left(trim(tags), 1) in ('{', '[') then regexp_replace(regexp_replace(trim(tags), '^[\\[{]', ''), '[\\]}]$', '') else coalesce(tags, '') end, ','),
          lambda x: trim(x, ' "''') <> '')) as n from mini_b)
        select count(*) filter (n > 0) as non_empty, count(*) filter (n > 0 and s like '{%') as brace_style, count(*) filter (n > 0 and s like '[%') as bracket_style from t""",
    "article_numbers": f"""with v as (select json_extract_string({_obj('item_info')}, '$.ic_item_id') as v from {_BOTH})
        select 'upc' as key, count(*) as n_values, count(*) filter (regexp_full_match(trim(v), '[0-9]{{8,14}}')) as n_plausible from v where not {_missing('v')} having count(*) > 0""",
    "pattern_counters": f"""select count(*) as n_rows, count(*) filter (regexp_matches(name, {_q(profile.PACK_HEAD)})) as pack_heads, count(*) filter (regexp_matches(name, {_q(profile.MULTIPACK)})) as multipacks,
        count(*) filter (regexp_matches(name, {_q(profile.DIMENSION)})) as dimensions, count(*) filter (regexp_matches(description, {_q(profile.MARKUP)})) as markup,
        count(*) filter (not {_missing('description')}) as descriptions from {_BOTH}""",
    "core_names": f"""with s as (select row_ord, regexp_replace(lower({_strip("coalesce(name, '')")}), {_q(sizes.PACK_HEAD + r'\s*')}, '') as t, lower({_squeeze("coalesce(brand_raw, '')")}) as b from mini_b),
        u as (select row_ord, case when b <> '' and starts_with(t, b) then {_strip("substr(t, length(b) + 1)")} else t end as t from s)
        select row_ord, {_squeeze(f"regexp_replace(regexp_replace(regexp_replace(t, {_q(sizes.PLAIN)}, '', 'g'), {_q(rf'\b(?:{attrs.CONTAINER_WORDS})\b')}, '', 'g'), '[,;.]+', ' ', 'g')")} as core_name from u""",
    "attributes_of_names": f"""select row_ord, {_FIRST('name', attrs.STORAGE_WORDS)} as storage, {_FIRST('name', attrs.FORM_WORDS)} as form, {_FIRST('name', attrs.FLAVOR_WORDS)} as flavor,
        contains(lower(name), 'organic') as organic from {_BOTH} where name is not null""",
    "known_brands": f"""with l as (select lower(brand_name) as b from brand_list), p as (select row_ord, {_squeeze("translate(lower(name), '-''', '  ')")} as t from {_BOTH} where name is not null)
        select row_ord, arg_max(b, length(b)) as brand from p join l on t = b or starts_with(t, b || ' ') group by row_ord""",
    "duplicate_ids": f"select item_id, count(*) - 1 as repeats from {_BOTH} group by item_id having count(*) > 1",
    "duplicate_groups": f"""with r as (select lower({_squeeze('brand_raw')}) as brand, {_squeeze('lower(name)')} as title, item_id, row_ord from {_BOTH} where name is not null and brand_raw is not null)
        select brand, title, count(*) as n_rows, array_to_string(list_slice(list(item_id order by row_ord), 1, 20), ',') as items from r group by brand, title having count(*) > 1""",
    "top_brands": f"select lower({_squeeze('brand_raw')}) as brand, count(*) as n from {_BOTH} where lower({_squeeze('brand_raw')}) <> '' group by 1 order by n desc, brand limit 25",
    "shared_brands": f"""with a as (select lower({_squeeze('brand_raw')}) as brand, count(*) as n_a from mini_a group by 1), b as (select lower({_squeeze('brand_raw')}) as brand, count(*) as n_b from mini_b group by 1)
        select brand, n_a, n_b from a join b using (brand) where brand <> ''""",
    "bad_id_examples": "select row_ord, item_id from mini_a where not regexp_full_match(coalesce(item_id, ''), '[0-9]+') order by row_ord limit 8",
    "keyword_hits": f"""select probe, count(*) as n from (select case when contains(lower(name), 'yogurt') and contains(lower(name), 'honey') then 'honey yogurt'
        when contains(lower(name), 'organic') and contains(lower(name), 'tomato sauce') then 'organic tomato sauce' end as probe from {_BOTH}) where probe is not null group by probe""",
}
