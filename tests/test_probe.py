"""Probes: texts, groups, padding with unrelated documents, traces."""

import pytest
from pyspark.sql import functions as F

from shelfspark.functions import sizes
from shelfspark.operators import probe, retrieval
from tests.test_matching import A, B, RAW, listing


def test_texts(spark, one):
    assert one(probe.without_labels(F.col("x")), x="great value equate tea") == "tea"
    assert one(probe.size_token(sizes.best_size(sizes.all_sizes(F.col("x")))), x="Tea 1.5 kg") == "1500g"
    assert one(probe.size_token(sizes.best_size(sizes.all_sizes(F.col("x")))), x="Tea") is None
    assert one(probe.name_group(F.col("x"), F.lit("acme")), x="Acme Plum Jam, 10 oz Family Size") == "plum jam"
    assert one(probe.name_group(F.col("x"), F.lit("acme")), x=None) == ""
    df = spark.createDataFrame([listing(1, "Great Value Jam, 2 lb", "Great Value", "3 lb", c=B)], RAW)
    assert probe.probe_text(df, "B").first()["text"] == "great value great value jam, 2 lb great value jam, grocery pantry x 1360.7771g"
    assert probe.probe_text(df, "A", "suppress_private_label").first()["text"].startswith("jam, 2 lb jam,")
    with pytest.raises(ValueError):
        probe.probe_text(df, "A", "x")


def test_unrelated_documents_fill_up(spark):
    q = spark.createDataFrame([(1, "plum"), (2, "zzz")], "k bigint, text string")
    d = spark.createDataFrame([(i, t) for i, t in enumerate(["plum jam", "plum tea", "oat bar", "oat tea"])], "k bigint, text string")
    got = probe.probe_top_k(q, d, "k", "k", "text", 3, max_share=1.0)
    rows = {(r["a"], r["rank"]): (r["b"], r["score"]) for r in got.collect()}
    assert len(rows) == 6 and {rows[1, 1][0], rows[1, 2][0]} == {0, 1} and rows[1, 3] == (2, 0.0)
    assert [rows[2, i] for i in (1, 2, 3)] == [(0, 0.0), (1, 0.0), (2, 0.0)]
    want = spark.createDataFrame([(1, 2), (1, 3)], "a bigint, b bigint")
    assert {r["b"]: r["rank"] for r in probe.rank_of(got, want).collect()} == {2: 3, 3: None}


def test_terms_are_counted_and_scored_where_the_rows_are(spark, monkeypatch):
    q = spark.createDataFrame([(1, "plum jam"), (2, "oat tea"), (3, "zzz")], "k bigint, text string")
    d = spark.createDataFrame([(i, f"{x} {y}") for i, (x, y) in enumerate((x, y) for x in ("plum", "oat", "rye", "plums") for y in ("jam", "tea", "bar", "jams"))], "k bigint, text string")
    rows = lambda: sorted((r["a"], r["rank"], r["b"], round(r["score"], 9)) for r in probe.probe_top_k(q, d, "k", "k", "text", 4, most_letters=20).collect())
    few = rows()
    got = probe.probe_top_k(q, d, "k", "k", "text", 4, most_letters=20)
    assert "Generate" not in got._jdf.queryExecution().executedPlan().toString()  # no row for each term of a document
    monkeypatch.setattr(retrieval, "FEW_QUERIES", 0)
    assert len(few) == 12 and rows() == few
    monkeypatch.setattr(retrieval, "MOST_SENT_TERMS", 0)
    monkeypatch.setattr(retrieval, "MOST_HELD_TERMS", 5)
    assert rows() == few


def test_few_queries_move_no_vectors(spark, monkeypatch):
    q = spark.createDataFrame([(1, "plum jam", "p"), (2, "oat tea", "q"), (3, "plum", None)], "k bigint, text string, g string")
    d = spark.createDataFrame([(i, f"{x} {y}", [g]) for i, (x, y, g) in enumerate((x, y, g) for x in ("plum", "oat") for y in ("jam", "tea", "jams") for g in "pq")], "k bigint, text string, gs array<string>")
    find = lambda: retrieval.tfidf_top_k(q, d, "k", "k", "text", 2, "g", "gs")
    rows = lambda df: sorted((r["a"], r["rank"], r["b"], round(r["score"], 9)) for r in df.collect())
    few = find()
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroups" not in plan and "Join" not in plan and len(rows(few)) == 4
    monkeypatch.setattr(retrieval, "FEW_QUERIES", 0)
    assert rows(find()) == rows(few)


def test_trace_and_signals(spark):
    a = spark.createDataFrame([listing(1, "Acme Plum Jam, 10 oz", "Acme", c=A), listing(2, "Great Value Jam", "", c=A)], RAW)
    b = spark.createDataFrame([listing(21, "Acme Plum Jam", "Acme", size="10 oz", c=B), listing(22, "Acme Plum Jam", "Acme", size="20 oz", c=B)], RAW)
    got = {r["b_id"]: r["rejection"] for r in probe.trace(a, b, "1").collect()}
    assert got == {"21": None, "22": "size_mismatch"}
    assert probe.trace(a, b, "none").count() == 0
    assert [(r["signal"], r["n"]) for r in probe.label_signals(a, "A").collect()] == [("great value", 1)]
    assert [r["item_id"] for r in probe.first_of_each(a, F.lit(1), "row_ord", 1).collect()] == ["1"]
