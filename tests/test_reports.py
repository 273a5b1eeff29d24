"""Profiles, samples, calibration, validation, the arbiter, files and the stream."""

import json
import statistics

import pytest
from pyspark.sql import functions as F

from shelfspark.operators import arbiter, calibrate, profile, sampling, validate
from shelfspark.sources import catalog, credentials, sinks
from shelfspark.streaming import quarantine

AUDIT = "item_id_a string, item_id_b string, score double, retrieval_score double, top1_top2_margin double, source string, decision string, reason string, llm_confidence double"


def audit(spark, rows):
    return spark.createDataFrame([(a, b, s, 1.0, m, "deterministic", d, r, None) for a, b, s, m, d, r in rows], AUDIT)


def test_blank_profile_and_histograms(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "None", "x"), (3, "a", " ")], "row_ord bigint, v string, w string")
    got = {r["column_name"]: (r["blank_count"], r["blank_rate"]) for r in profile.blank_profile(df, ["v", "w"]).collect()}
    assert got == {"v": (1, 33.33), "w": (2, 66.67)}
    assert [(r["value"], r["n"]) for r in profile.top_values(df, F.col("v"), 1).collect()] == [("a", 2)]
    assert profile.blank_profile(df.limit(0), ["v"]).first()["blank_rate"] == 0.0


def test_duplicate_groups_keep_arrival_order(spark):
    df = spark.createDataFrame([(3, "a", "z"), (1, "a", "x"), (2, "a", "y"), (4, "b", "w")], "row_ord bigint, k string, item string")
    got = profile.duplicate_groups(df, [F.col("k")], F.col("item"), most_items=2).collect()
    assert [(r["k0"], r["n_rows"], r["items"]) for r in got] == [("a", 3, ["x", "y"])]


@pytest.mark.parametrize("values", [[1, 2, 3, 4, 5, 6], [5, 5, 5, 5], [1.5, 9.0, 2.0, 7.0, 7.0], [1, 2, 3], []])
def test_first_quartile_is_exclusive(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    want = statistics.quantiles(values, n=4)[0] if len(values) >= 4 else None
    assert sampling.first_quartile(df, "v").first()["q1"] == (pytest.approx(want) if want is not None else None)


def test_round_robin_quota_and_null_stratum(spark):
    df = spark.createDataFrame([(i, "abc"[i % 3] if i % 4 else None) for i in range(24)], "k bigint, s string")
    got = sampling.round_robin(df, F.col("s"), 6, ["k"], seed=1).collect()
    assert len(got) == 6 and {r["s"] for r in got} == {"a", "b", "c", None}
    assert sampling.round_robin(df, F.col("s"), 0, ["k"]).count() == 0
    assert sampling.round_robin(df, F.col("s"), 99, ["k"]).count() == 24
    same = [sorted(r["k"] for r in sampling.round_robin(df.repartition(n), F.col("s"), 7, ["k"], seed=2, shuffle_strata=True).collect()) for n in (1, 5)]
    assert same[0] == same[1]


def test_pinned_rows_stay(spark):
    s = spark.createDataFrame([("1", "x", 1), ("1", "x", 2), ("2", "y", 3), ("3", None, 4)], "item_id_a string, item_id_b string, n int")
    p = spark.createDataFrame([("2", "y", 9), ("2", "y", 9)], "item_id_a string, item_id_b string, n int")
    assert sorted(r["n"] for r in sampling.pinned_last(s, p, F.col("n")).collect()) == [1, 4, 9, 9]


def test_annotations_never_blank(spark):
    t = spark.createDataFrame([("1", "x", "wrong", "n"), ("2", "y", "", "")], "item_id_a string, item_id_b string, label string, notes string")
    p = spark.createDataFrame([("1", "x", "", "seen "), ("2", "y", " Correct", "")], "item_id_a string, item_id_b string, label string, notes string")
    got = {r["item_id_a"]: (r["label"], r["notes"], r["merged"]) for r in sampling.merge_annotations(t, p).collect()}
    assert got == {"1": ("wrong", "seen", True), "2": ("correct", "", True)}


def test_grid_and_precision(spark):
    a = audit(spark, [("1", "x", 0.8, 0.2, "accepted", "ok"), ("2", "y", 0.7, None, "below_threshold", "r"), ("3", "z", 0.7, 0.01, "below_threshold", "r"), ("4", None, None, None, "no_candidates", "r")])
    got = {(r["min_score"], r["min_margin"]): (r["accepted_count"], r["pin"]) for r in calibrate.threshold_grid(a, [0.6, 0.75], [0.05], {"pin": ("2", "y")}).collect()}
    assert got == {(0.6, 0.05): (2, True), (0.75, 0.05): (1, False)}
    labelled = spark.createDataFrame([("g", "correct", 0.8), ("g", "wrong", 0.7), ("h", "unsure", 0.6)], "grp string, label string, score double")
    rows = {r["grp"]: r for r in calibrate.label_counts(labelled, ["grp"], total=True).collect()}
    assert rows["g"]["precision"] == 0.5 and rows["h"]["precision"] is None and rows[None]["n"] == 3
    assert [(r["floor"], r["n"], r["precision"]) for r in calibrate.cumulative_precision(labelled, [0.75]).collect()] == [(0.75, 1, 1.0)]


def test_violations(spark):
    pairs = spark.createDataFrame([(2, "1", "9"), (3, "1", "9"), (4, "x", "9"), (5, "2", "8")], "line_no bigint, item_id_a string, item_id_b string")
    ids = lambda *v: spark.createDataFrame([(x,) for x in v], "item_id string")
    got = sorted((r["line_no"] or 0, r["kind"]) for r in validate.violations(pairs, ids("1"), ids("9"), {"1": "9", "2": "7", "5": "9"}, 10).collect())
    assert got == [(0, "required_mismatch"), (0, "required_missing"), (0, "too_few_rows"), (3, "duplicate_a"), (4, "non_numeric_a"), (5, "unknown_a"), (5, "unknown_b")]


def test_match_file_round_trip(spark, tmp_path):
    pairs = spark.createDataFrame([("1", "9"), ("2", "8")], "item_id_a string, item_id_b string")
    path = str(tmp_path / "m.csv")
    assert sinks.write_matches(pairs, path) == 2
    assert (tmp_path / "m.csv").read_bytes() == b"item_id_A,item_id_B\r\n1,9\r\n2,8\r\n"
    ids_a, ids_b = pairs.select(F.col("item_id_a").alias("item_id")), pairs.select(F.col("item_id_b").alias("item_id"))
    assert validate.validate_file(spark, path, ids_a, ids_b, 2).ok
    (tmp_path / "m.csv").write_text("a,b\n1,9,3\n1,9\n")
    bad = validate.validate_file(spark, path, ids_a, ids_b)
    assert not bad.ok and bad.row_count == 1 and len(bad.errors) == 2
    assert validate.validate_file(spark, str(tmp_path / "none.csv"), ids_a, ids_b).errors[0].startswith("file not found")
    (tmp_path / "m.csv").write_text("")
    assert "empty" in validate.validate_file(spark, path, ids_a, ids_b).errors[0]


def test_match_file_in_splits_with_quoted_cells(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "m.csv")
    (tmp_path / "m.csv").write_text('item_id_A,"item_id_B"\n' + "".join(f"{i},{i}\n" for i in range(2000)) + '"x, ""y""",z\n1,2,3\n\n"a"b,c\n')
    monkeypatch.setattr(validate, "MOST_MESSAGES", 2)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000b")
    try:
        pairs, errors = validate.read_match_lines(spark, path)
        got = {r["line_no"]: (r["item_id_a"], r["item_id_b"]) for r in pairs.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {i + 2: (str(i), str(i)) for i in range(2000)} | {2002: ('x, "y"', "z")}
    assert errors == ["line 2003: expected 2 columns, got 3", "line 2004: expected 2 columns, got 1", "and 1 more"]


@pytest.mark.parametrize(("answer", "ok"), [
    ('{"same_product_for_customer":true,"confidence":0.9,"reason":"r","blocking_issue":null}', True),
    ('```json\n{"same_product_for_customer":false,"confidence":1,"reason":"r","blocking_issue":"size"}\n```', True),
    ('{"same_product_for_customer":"true","confidence":0.9,"reason":"r","blocking_issue":null}', False),
    ('{"same_product_for_customer":true,"confidence":1.2,"reason":"r","blocking_issue":null}', False),
    ('{"same_product_for_customer":true,"confidence":true,"reason":"r","blocking_issue":null}', False),
    ('{"same_product_for_customer":true,"confidence":NaN,"reason":"r","blocking_issue":null}', False),
    ('{"same_product_for_customer":true,"confidence":0.9,"reason":"r"}', False),
    ('{"same_product_for_customer":true,"confidence":0.9,"reason":5,"blocking_issue":null}', False), ("no", False), ("", False), (None, False), ("[]", False),
])
def test_parse_response(one, answer, ok):
    assert (one(arbiter.parse_response(F.col("x")), x=answer) is not None) is ok


def test_plan_budget_and_hits(spark):
    rows = [(str(i), 1.0 - i / 100, "g" if i % 2 else None, f"k{i}") for i in range(12)] + [("n", None, "g", "kn")]
    c = spark.createDataFrame(rows, "item_id_a string, score double, grp string, cache_key string")
    hits = spark.createDataFrame([("k0", "o"), ("k11", "o")], "cache_key string, opinion string")
    got = {r["item_id_a"]: (r["ask"], r["opinion"]) for r in arbiter.arbitration_plan(c, hits, arbiter.ArbiterConfig(max_calls=3, least_per_group=50)).collect()}
    assert [k for k in got if got[k][0]] and {k for k in got if got[k][0]} == {"1", "2", "3"}
    assert got["11"] == (False, "o") and "n" not in got
    capped = arbiter.arbitration_plan(c, hits.limit(0), arbiter.ArbiterConfig(max_calls=100, least_per_group=2))
    assert capped.count() == 12  # the cap is the larger: 100 calls over two groups


def test_asking_and_remembering(spark, tmp_path):
    plan = spark.createDataFrame([("1", 0.7, "k1", True), ("2", 0.6, "k2", True), ("3", 0.5, "k3", False)], "item_id_a string, score double, cache_key string, ask boolean")

    class Client:
        def __init__(self):
            self.n = 0

        def ask(self, prompt):
            self.n += 1
            if self.n == 2:
                raise TimeoutError
            return "{}"

    path = str(tmp_path / "d" / "cache.jsonl")
    remember = lambda k, o: arbiter.append_cache(path, k, o, {"api_key": "s", "v": "1"})
    assert arbiter.ask_all(plan, None, json.loads, remember) == {"calls": 0, "failed": 0, "unparsed": 0}
    assert arbiter.ask_all(plan, Client(), lambda t: None, remember) == {"calls": 2, "failed": 1, "unparsed": 1}
    assert "api_key" not in open(path).read()
    arbiter.append_cache(path, "k1", {"same_product_for_customer": True, "confidence": 0.9, "reason": "a"})
    arbiter.append_cache(path, "k1", {"same_product_for_customer": False, "confidence": 0.8, "reason": "b"})
    with open(path, "a") as out:
        out.write('\nbroken{\n{"key":"k9"}\n')
    latest = arbiter.latest_opinions(catalog.read_cache(spark, path), F.col("line_no")).collect()
    assert [(r["cache_key"], r["opinion"]["reason"]) for r in latest] == [("k1", "b")]
    with pytest.raises(ValueError):
        arbiter.prompt({}, "v9")


def test_rescue(spark):
    a = audit(spark, [("1", "x", 0.7, None, "below_threshold", "below_min_score"), ("2", "y", 0.7, None, "below_threshold", "r"), ("3", "z", 0.9, None, "accepted", "ok")])
    o = spark.createDataFrame([("1", True, 0.9), ("2", True, 0.5), ("3", True, 0.9)], "item_id_a string, same boolean, confidence double")
    got = {r["item_id_a"]: (r["decision"], r["source"], r["reason"], r["llm_confidence"]) for r in arbiter.rescue(a, o).collect()}
    assert got["1"] == ("accepted", "llm_rescued", "llm_rescue_below_min_score", 0.9)
    assert got["2"][0] == "below_threshold" and got["2"][3] == 0.5 and got["3"][1] == "deterministic"


def test_catalog_files(spark, tmp_path):
    header = ",".join(catalog.A_COLUMNS)
    rows = ['1,"a ""b"", c' + '"' + "," * 17, "2," + "," * 17, "x,n" + "," * 17, '3,"two\nlines"' + "," * 17, "1,later" + "," * 17]
    (tmp_path / "a.csv").write_text("﻿" + header + "\n" + "\n".join(rows) + "\n", encoding="utf-8")
    valid, bad = catalog.read_products(spark, str(tmp_path / "a.csv"), "A")
    assert sorted(r["name"] for r in valid.collect()) == ['a "b", c', "later", "two\nlines"]
    assert sorted(r["quarantine_reason"] for r in bad.collect()) == ["blank_name", "non_numeric_item_id"]
    assert {r["item_id"]: r["name"] for r in catalog.read_latest(spark, str(tmp_path / "a.csv"), "A").collect()} == {"1": "later", "3": "two\nlines"}
    assert catalog.file_megabytes(spark, str(tmp_path / "a.csv")) == 0.0
    with pytest.raises(ValueError):
        catalog.read_products(spark, "x", "C")


def test_annotation_files(spark, tmp_path):
    assert catalog.read_annotations(spark, str(tmp_path / "none.csv")).count() == 0
    (tmp_path / "n.csv").write_text("item_id_A,item_id_B,label,notes\n1,x, Correct ,\n2,y,,\n,z,wrong,\n3,,,seen\n")
    assert sorted((r["item_id_a"], r["label"], r["notes"]) for r in catalog.read_annotations(spark, str(tmp_path / "n.csv")).collect()) == [("1", "correct", ""), ("3", "", "seen")]
    assert catalog.labels(spark, str(tmp_path / "n.csv")).count() == 1


def test_credentials(tmp_path, monkeypatch):
    p = tmp_path / "c.yaml"
    p.write_text("# x\nendpoint: e\ndeployment: 'd'\napi_key: secret\n")
    assert credentials.load(str(p))["deployment"] == "d"
    p.write_text("endpoint: e\napi_key: secret\n")
    with pytest.raises(ValueError, match="deployment") as e:
        credentials.load(str(p))
    assert "secret" not in str(e.value)
    with pytest.raises(ValueError):
        credentials.load(str(tmp_path / "none"))
    monkeypatch.setenv("SHELFSPARK_CREDENTIALS", "env")
    assert credentials.find_file("given") == "given" and credentials.find_file() == "env"


def test_reports(spark, tmp_path):
    df = spark.createDataFrame([("a|b", 1), (None, 2)], "x string, n int")
    text = sinks.markdown_report("T", {"S": df, "U": "words"})
    assert "| a\\|b | 1 |" in text and "## U" in text
    assert "(first 1 rows)" in sinks.markdown_table(df, 1)
    sinks.write_stats({"b": 1, "a": 2}, str(tmp_path / "s" / "x.json"))
    assert list(json.loads((tmp_path / "s" / "x.json").read_text())) == ["a", "b"]


def test_stream_of_feed_lines(spark, tmp_path):
    good = ",".join(["1", "name"] + [""] * 17)
    spark.createDataFrame([(1, good), (2, "a,b"), (3, '1,"x')], "line_no bigint, line string").write.parquet(str(tmp_path / "in"))
    lines = spark.readStream.schema("line_no bigint, line string").parquet(str(tmp_path / "in"))
    q = quarantine.start(lines, str(tmp_path / "ok"), str(tmp_path / "bad"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    assert [r["line_no"] for r in spark.read.parquet(str(tmp_path / "ok")).collect()] == [1]
    assert sorted((r["line_no"], r["reason"]) for r in spark.read.parquet(str(tmp_path / "bad")).collect()) == [(2, "wrong_column_count"), (3, "broken_quoting")]
