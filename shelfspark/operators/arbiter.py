r"""Second opinions on borderline pairs: the plan is DataFrames, only the few calls within the budget reach Python.

A client is any object with ``ask(prompt) -> str``; without one no call is made and none is counted. Opinions that
do not parse are remembered as such and asked again on the next run.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from dataclasses import dataclass
from datetime import UTC, datetime
from typing import Protocol

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.functions import semi
from shelfspark.functions.text import strip_fences

OPINION = "struct<same_product_for_customer:boolean,confidence:double,reason:string,blocking_issue:string,raw_response_id:string,parse_error:boolean>"
SECRETS = ("api_key", "authorization", "bearer")
KEY_PARTS = (
    "item_id_a", "item_id_b", "name_a", "name_b", "brand_a", "brand_b", "size_a", "size_b", "group_a", "group_b", "failure_reason",
)


class Client(Protocol):
    def ask(self, prompt: str) -> str: ...


@dataclass(frozen=True)
class ArbiterConfig:
    prompt_version: str = "v1"
    deployment: str = "none"
    max_calls: int = 200
    least_per_group: int = 50
    min_confidence: float = 0.85
    window: tuple[float, float] = (0.65, 0.75)


def score_text(score: Column) -> Column:
    return F.coalesce(F.format_string("%.4f", F.round(score, 4)), F.lit(""))


def cache_key(config: ArbiterConfig, parts: list[Column], score: Column) -> Column:
    """SHA-256 of version, deployment, the parts of a pair and its score; null parts count as empty."""
    texts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.sha2(F.concat_ws("|", F.lit(config.prompt_version), F.lit(config.deployment), *texts, score_text(score)), 256)


def parse_response(text: Column) -> Column:
    """The opinion of a response: an object with the four fields in their types and a confidence in [0, 1]; null otherwise."""
    v = semi.json_object(strip_fences(text))
    field = lambda k: F.try_variant_get(v, f"$.{k}", "variant")
    kind = lambda k: F.regexp_extract(F.schema_of_variant(field(k)), r"\A[A-Z]+", 0)
    confidence = F.try_variant_get(v, "$.confidence", "double")
    present = field("blocking_issue").isNotNull()  # a JSON null is a value
    ok = (
        (kind("same_product_for_customer") == "BOOLEAN") & kind("confidence").isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT", "INT", "SMALLINT", "TINYINT")
        & (confidence >= 0) & (confidence <= 1) & (kind("reason") == "STRING") & present & kind("blocking_issue").isin("STRING", "VOID")
    )
    return F.when(ok, F.struct(
        F.try_variant_get(v, "$.same_product_for_customer", "boolean").alias("same_product_for_customer"), confidence.alias("confidence"),
        F.try_variant_get(v, "$.reason", "string").alias("reason"), F.try_variant_get(v, "$.blocking_issue", "string").alias("blocking_issue"),
    ))


def latest_opinions(cache: DataFrame, order: Column) -> DataFrame:
    """(cache_key, opinion): the last usable opinion of every key; entries without key, without opinion or that failed to parse are skipped."""
    o = F.col("opinion")
    usable = cache.where(
        F.col("cache_key").isNotNull() & o.isNotNull() & ~F.coalesce(o["parse_error"], F.lit(False))
        & o["same_product_for_customer"].isNotNull() & o["confidence"].isNotNull()
    )
    return usable.groupBy("cache_key").agg(F.max_by("opinion", order).alias("opinion"))


def arbitration_plan(candidates: DataFrame, cache: DataFrame, config: ArbiterConfig = ArbiterConfig()) -> DataFrame:
    """Candidates within their group's cap, each with ``opinion`` (a hit) or ``ask`` (a miss within the budget).

    ``candidates``: item_id_a, score, grp (null counts as unknown), cache_key; ``cache``: cache_key, opinion. The cap is
    the larger of ``least_per_group`` and the budget over the number of groups; misses take the budget by score, hits
    are free. Candidates without a score take no part.
    """
    c = candidates.where("score is not null").withColumn("grp", F.coalesce("grp", F.lit("unknown")))
    n = c.agg(F.greatest(F.count_distinct("grp"), F.lit(1)).alias("n_groups"))
    order = [F.col("score").desc(), F.col("item_id_a").asc()]
    nth = F.row_number().over(Window.partitionBy("grp").orderBy(*order))
    cap = F.greatest(F.lit(config.least_per_group), F.floor(F.lit(config.max_calls) / F.col("n_groups")))
    kept = c.crossJoin(F.broadcast(n)).withColumn("nth", nth).where(F.col("nth") <= cap).drop("nth", "n_groups")
    seen = kept.join(cache, "cache_key", "left")
    misses = seen.where("opinion is null").orderBy(*order).limit(config.max_calls).select("item_id_a", "cache_key", F.lit(True).alias("ask"))
    return seen.join(F.broadcast(misses), ["item_id_a", "cache_key"], "left").withColumn("ask", F.coalesce("ask", F.lit(False)))


def rescue(audit: DataFrame, opinions: DataFrame, config: ArbiterConfig = ArbiterConfig()) -> DataFrame:
    """The audit after the opinions (item_id_a, same, confidence): the confidence is kept whether or not it rescues.

    Rescued are below-threshold rows with a partner whose opinion is the same product with enough confidence.
    """
    o = opinions.select("item_id_a", "same", F.col("confidence").alias("c"))
    j = audit.join(o, "item_id_a", "left")
    saved = F.coalesce(
        F.col("same") & (F.col("c") >= config.min_confidence) & (F.col("decision") == "below_threshold") & (F.coalesce("item_id_b", F.lit("")) != ""), F.lit(False)
    )
    return j.withColumns({
        "llm_confidence": F.coalesce("c", "llm_confidence"),
        "source": F.when(saved, F.lit("llm_rescued")).otherwise(F.col("source")),
        "reason": F.when(saved, F.concat(F.lit("llm_rescue_"), F.col("reason"))).otherwise(F.col("reason")),
        "decision": F.when(saved, F.lit("accepted")).otherwise(F.col("decision")),
    }).drop("same", "c")


def prompt(row: dict, version: str = "v1") -> str:
    """The question put to a client about one pair."""
    if version != "v1":
        raise ValueError(f"unknown prompt version {version!r}")
    size = lambda s: f"{s['pack_count']} x {s['unit_size']:g} {s['unit']}" if s and s.get("unit") else "unknown"
    lines = [
        "Two shops list the products below. Would a customer who wants the first accept the second as the same product?",
        *(f"{side} - name: {row.get(f'name_{k}') or 'unknown'}; brand: {row.get(f'brand_{k}') or 'unknown'}; size: {size(row.get(f'size_{k}'))}; group: {row.get(f'group_{k}') or 'unknown'}" for side, k in (("First", "a"), ("Second", "b"))),
        f"An automatic comparison was unsure ({row.get('failure_reason') or 'no reason given'}).",
        "Answer with one JSON object: same_product_for_customer (true or false), confidence (0 to 1), reason (text), blocking_issue (text or null).",
    ]
    return "\n".join(lines)


def append_cache(path: str, key: str, opinion: dict, meta: dict | None = None) -> None:
    """One JSON line with its time; secrets are left out of ``meta``."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    clean = {k: v for k, v in (meta or {}).items() if k.lower() not in SECRETS} | {"ts": datetime.now(UTC).isoformat()}
    with open(path, "a", encoding="utf-8") as out:
        out.write(json.dumps({"key": key, "opinion": opinion, "meta": clean}, ensure_ascii=False) + "\n")


def ask_all(plan: DataFrame, client: Client | None, parse: Callable[[str], dict | None], remember: Callable[[str, dict], None], version: str = "v1") -> dict[str, int]:
    """Put the questions within the budget to the client, one after the other; counts of calls, failures and unusable answers."""
    counts = {"calls": 0, "failed": 0, "unparsed": 0}
    if client is None:
        return counts
    for row in plan.where("ask").orderBy(F.col("score").desc(), "item_id_a").toLocalIterator():
        counts["calls"] += 1
        try:
            answer = client.ask(prompt(row.asDict(recursive=True), version))
        except Exception:  # noqa: BLE001 - a client may fail in any way; the pair stays open
            counts["failed"] += 1
            continue
        opinion = parse(answer)
        if opinion is None:
            counts["unparsed"] += 1
            remember(row["cache_key"], {"parse_error": True})
        else:
            remember(row["cache_key"], opinion)
    return counts
