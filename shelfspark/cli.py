"""Command lines over the API: match, profile, probe, sample. Exit code 0 if all is well, 1 if the contract is violated."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.functions.text import brand_text
from shelfspark.operators import calibrate, profile, retrieval, sampling, validate
from shelfspark.plans import match
from shelfspark.session import build_session
from shelfspark.sources import catalog, sinks


def _products(spark, path: str, source: str) -> DataFrame:
    """Valid rows of a CSV file, or of a Parquet table with the same columns."""
    if path.rstrip("/").endswith(".parquet"):
        rows = spark.read.parquet(path)
        rows = rows if "row_ord" in rows.columns else catalog.with_arrival(rows)
        return match.quarantine(rows).where("quarantine_reason is null").drop("quarantine_reason")
    return catalog.read_products(spark, path, source)[0]


def cmd_match(args) -> int:
    spark = build_session("shelfspark match")
    a, b = _products(spark, args.a, "A"), _products(spark, args.b, "B")
    config = match.MatchConfig(args.min_score, args.min_margin, args.top_k, args.limit, args.strategy)
    match.run(a, b, config).write.mode("overwrite").parquet(f"{args.out}/audit")
    audit = spark.read.parquet(f"{args.out}/audit")
    sinks.write_audit(audit, f"{args.out}/matches_audit.csv")
    sinks.write_matches(match.matches(audit), f"{args.out}/matches.csv")
    print(sinks.markdown_table(match.counters(audit).orderBy("decision", "reason")))
    result = validate.validate_file(spark, f"{args.out}/matches.csv", catalog.valid_ids(a), catalog.valid_ids(b), args.min_rows)
    for e in result.errors:
        print(e, file=sys.stderr)
    return 0 if result.ok else 1


def cmd_profile(args) -> int:
    spark = build_session("shelfspark profile")
    sections: dict[str, DataFrame | str] = {}
    sides = {s: _products(spark, p, s) for s, p in (("A", args.a), ("B", args.b)) if p}
    for s, df in sides.items():
        columns = [c for c in df.columns if c != "row_ord"]
        sections |= {
            f"{s}: blank cells": profile.blank_profile(df, columns), f"{s}: JSON": profile.json_health(df, ["item_info", "sizing_comp"]),
            f"{s}: keys": profile.json_keys(df, "item_info").orderBy(F.col("n").desc(), "key").limit(25), f"{s}: sizes": profile.size_stats(df),
            f"{s}: brands": profile.top_values(df, brand_text(F.col("brand_raw")), 25, "brand"), f"{s}: repeated ids": profile.duplicate_ids(df).orderBy(F.col("repeats").desc(), "item_id").limit(10),
        }
    if len(sides) == 2:
        v = brand_text(F.col("brand_raw"))
        sections["Shared brands"] = profile.shared_values(sides["A"], sides["B"], v, v).orderBy("value").limit(100)
    with open(args.out, "w", encoding="utf-8") as out:
        out.write(sinks.markdown_report("Catalogue profile", sections))
    return 0


def cmd_probe(args) -> int:
    spark = build_session("shelfspark probe")
    docs = _products(spark, args.b, "B").select("item_id", F.lower("name").alias("text"))
    asked = catalog.literal_queries(spark, [q.lower() for q in args.query])
    for name, got in (("TF-IDF", retrieval.tfidf_top_k(asked, docs, "query_id", "item_id", "text", args.top_k)), ("BM25", retrieval.bm25_top_k(asked, docs, "query_id", "item_id", "text", args.top_k))):
        print(f"## {name}\n\n{sinks.markdown_table(got.orderBy('a', 'rank'))}\n")
    return 0


def cmd_sample(args) -> int:
    spark = build_session("shelfspark sample")
    audit = spark.read.parquet(args.audit)
    accepted = audit.where("decision = 'accepted'")
    picked = sampling.round_robin(accepted, F.coalesce("matchable_group", F.lit("none")), args.quota, sampling.PAIR, args.seed).withColumn("sample_type", F.lit("random_accepted"))
    near = sampling.near_miss(audit).withColumn("sample_type", F.lit("near_miss"))
    rows = sampling.merge_annotations(picked.unionByName(near).withColumns({"label": F.lit(""), "notes": F.lit("")}), catalog.read_annotations(spark, args.labels or ""))
    sinks.write_one_csv(rows, args.out, tuple(rows.columns), sampling.PAIR)
    grid = calibrate.threshold_grid(audit, [0.65, 0.70, 0.75, 0.80], [0.05]).orderBy("min_score", "min_margin")
    print(sinks.markdown_report("Sample", {"Strata": sampling.strata_counts(rows), "Thresholds": grid, "Scores": calibrate.bucket_histogram(audit)}))
    return 0


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="shelfspark", description=__doc__)
    sub = p.add_subparsers(required=True)
    m = sub.add_parser("match")
    m.set_defaults(run=cmd_match)
    for flag in ("--a", "--b", "--out"):
        m.add_argument(flag, required=True)
    m.add_argument("--min-score", type=float, default=0.55)
    m.add_argument("--min-margin", type=float, default=0.05)
    m.add_argument("--top-k", type=int, default=50)
    m.add_argument("--limit", type=int)
    m.add_argument("--min-rows", type=int, default=0)
    m.add_argument("--strategy", choices=("grid", "sql"), default="grid")
    f = sub.add_parser("profile")
    f.set_defaults(run=cmd_profile)
    f.add_argument("--a")
    f.add_argument("--b")
    f.add_argument("--out", required=True)
    r = sub.add_parser("probe")
    r.set_defaults(run=cmd_probe)
    r.add_argument("--b", required=True)
    r.add_argument("--top-k", type=int, default=5)
    r.add_argument("query", nargs="+")
    s = sub.add_parser("sample")
    s.set_defaults(run=cmd_sample)
    s.add_argument("--audit", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--labels")
    s.add_argument("--quota", type=int, default=50)
    s.add_argument("--seed", type=int, default=0)
    args = p.parse_args(argv)
    return args.run(args)


if __name__ == "__main__":
    sys.exit(main())
