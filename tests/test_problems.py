"""The general problems: quantities, packed fields, rejected records."""

import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfspark.operators import packed, quantities
from shelfspark.sources import rejects


@pytest.mark.parametrize(("text", "want"), [
    ("Cola, 12 x 12 oz", ("g", 4082)), ("Tea 8/1 QT", ("ml", 7571)), ("6/355 mL", ("ml", 2130)), ("Milk 1/2 gal", ("ml", 1893)), ("half-gallon", ("ml", 1893)),
    ("3 ea - 2 lb 8 OZ", ("g", 3402)), ("14.5oz each, 4 total", ("g", 1644)), ("Four 6 Oz Packs", ("g", 680)), ("Zinc 500 mg, 4 x 100 pcs", ("count", 400)),
    ("1 1/2 kgs (Pack of 3)", ("g", 4500)), ("1,420 ml", ("ml", 1420)), ("0,57 kilo", ("g", 570)), ("Box of 100", ("count", 100)), ("4 dozen", ("count", 48)),
    ("6 x Dozen", ("count", 72)), ("6x.5 gal", ("ml", 11356)), ("16 fl. oz.", ("ml", 473)), ("2.5#", ("g", 1134)), ("½ lb", ("g", 227)), ("0.5 g", ("g", 1)),
    ("Throw Pillow 16x24 inch", None), ("Rug 5' x 7'", None), ("Rated 4.5 stars", None), ("2% fat", None), ("SPF 30", None), ("60W", None), ("", None), ("Ships in 2 days", None),
])
def test_quantities(text, want):
    got = quantities.solve(quantities.readings(text), ())
    assert (got and (got[0][0], quantities.half_up(got[0][1] * got[0][2]))) == want


def test_ambiguous_reading_is_settled_by_the_other_column():
    own = quantities.readings("1,500 g")
    assert quantities.solve(own, ())[0][1] == 1500
    assert quantities.solve(own, quantities.readings("1.5 g"))[0][1] == 1.5


def test_residuals_decide_against_what_is_usual(monkeypatch):
    """Planted: the second statement holds a reading that no prior would choose; without residuals the usual one stands."""
    own, other = quantities.readings("Saffron 1,420 kg"), quantities.readings("1.42 kg")
    assert quantities.solve(own, other)[0][1] == 1420
    own, other = quantities.readings("Oil 3/4 oz"), quantities.readings("3 x 4 oz")
    assert (quantities.solve(own, other)[0][1:3], quantities.solve(own, ())[0][2]) == ((pytest.approx(4 * 28.349523125), 3), 3)
    two = (("g", 900.0, 1, 0.0), ("g", 1400.0, 1, 0.02))
    volume = (("ml", 1000.0, 1, 0.0),)
    assert quantities.solve(two, volume, density=1.4)[0][1] == 1400.0 and quantities.solve(two, volume, density=0.9)[0][1] == 900.0
    monkeypatch.setattr(quantities, "_residual", lambda x, y, density=1.0: 0.0)
    assert quantities.solve(two, volume, density=1.4)[0][1] == 900.0


def test_density_is_solved_from_the_records(spark):
    rows = [(i, f"Honey {n} g", f"{n / 1.4:.1f} ml", "honey") for i, n in enumerate((140, 280, 350, 420, 700))] + [(9, "Honey 1,400 g", "1 l", "honey"), (10, "Oil 5 g", "5 ml", "oil"), (11, None, "5 ml", None)]
    df = spark.createDataFrame(rows, "k int, own string, other string, kind string")
    assert {r["group"]: round(r["density"], 2) for r in quantities.densities(df, "own", "other", "kind").collect()} == {"honey": 1.4}
    got = {r["k"]: r["q"] for r in quantities.with_quantity(df, "own", "other", group="kind").collect()}
    assert got[9]["base_amount"] == 1400 and got[9]["residual"] == pytest.approx(0, abs=0.01) and got[0]["residual"] == pytest.approx(0, abs=0.01) and got[11]["base_amount"] is None
    assert quantities.densities(df.limit(0), "own", "other", "kind").count() == 0


def test_non_unique_solutions_are_flagged():
    own = (("g", 100.0, 1, 0.0), ("g", 200.0, 1, 0.0))
    assert quantities.solve(own, ())[2] is False
    assert quantities.solve(own, (("g", 200.0, 1, 0.0),))[2] is True


@pytest.mark.parametrize(("cell", "want"), [
    ('{"size_user_friendly":"6 \\u00d7 400 gr"}', "6 × 400 gr"), ('{"size_user_friendly": "9.9", "uom": "lb"}', "9.9 lb"), ("{'size_user_friendly': '6Oz'}", "6Oz"),
    ("null", ""), ("{}", ""), ("[]", ""), ('{"size_user_friendly":null}', ""), ('{"size_user_friendly":"3 oz', "3 oz"), (None, ""),
])
def test_size_cell(cell, want):
    assert quantities.size_cell(cell) == want


def test_quantity_column_with_nulls_and_clashing_names(spark):
    df = spark.createDataFrame([(1, "3 oz", None, "x"), (2, None, "3 oz", "x"), (3, "", "", "x"), (4, "word " * 20000 + "2 lb", None, "x")], "k int, own string, other string, q string")
    got = {r["k"]: r["q"] for r in quantities.with_quantity(df, "own", "other").collect()}
    assert got[1]["base_amount"] == 85 and got[2]["base_amount"] is None and got[3]["base_unit"] is None and got[4]["base_amount"] == 907
    assert quantities.with_quantity(df.limit(0), "own", "other").count() == 0


@pytest.mark.parametrize(("field", "want"), [
    ('{"a, b",c|d,}', ["a, b", "c|d"]), ("['x', \"kids' lunch\"]", ["x", "kids' lunch"]), ('a;;"b; c"|d\te', ["a", "b; c", "d", "e"]), ('"7"" tin"', ['7" tin']),
    ('{"7\\" tin"}', ['7" tin']), ("[]", []), ("{}", []), (",a,", ["a"]), ("a,a", ["a", "a"]), ('["caf\\u00e9"]', ["café"]), ('"open, end', ['"open', "end"]), ("chef's pick, x", ["chef's pick", "x"]),
    ('[""]', []), ("{a", ["a"]),
])
def test_segments(field, want):
    assert [v for v, _ in packed.segments(field)] == want


def test_dictionary_protects_known_values():
    a = packed.automaton(["salt, pepper & lime", "vegan"])
    values = lambda field, protect, known=a: [v for v, _ in packed.segments(field, packed.places(packed.notation(field)[0], known), protect)]
    assert values("vegan, salt, pepper & lime, raw", "known") == ["vegan", "salt, pepper & lime", "raw"]
    assert len(values("vegan, salt, pepper & lime, raw", "quoted")) == 4
    # A quote that never closes: only the dictionary knows where the value ends.
    assert values('{"salt, pepper & lime,keto}', "quoted") == ["salt, pepper & lime", "keto"]
    assert values('raw;"salt, pepper & lime; keto', "quoted") == ["raw", "salt, pepper & lime", "keto"]
    assert values('{"salt, pepper & lime,keto}', "quoted", packed.automaton([])) == ['"salt', "pepper & lime", "keto"]


@pytest.mark.parametrize("protect", ["quoted", "known"])
def test_dictionary_beyond_the_bound_gives_the_same_rows(spark, monkeypatch, protect):
    long = "long value, " + "x" * 200
    fields = ['"a, b"', '"a, b"', '{"a, b,c}', "a, b; c", "c|a, b", None, "", f'"{long}"', f'"{long}"', f'q;"{long}', '["a, b", c', "  a, b"]
    df = spark.createDataFrame(list(enumerate(fields)), "k bigint, tags string")
    got = sorted(tuple(r) for r in packed.split_packed(df, "k", "tags", protect).collect())
    assert (2, 1, "a, b") in got and (9, 2, long) in got
    monkeypatch.setattr(packed, "MOST_VALUES", 0)
    assert sorted(tuple(r) for r in packed.split_packed(df, "k", "tags", protect).collect()) == got


def test_split_packed(spark):
    df = spark.createDataFrame([(1, "a, b", "z"), (2, None, "z"), (3, "  ", "z"), (4, '"a, b"', "z"), (5, '"a, b"', "z")], "k bigint, tags string, value string")
    got = sorted(tuple(r) for r in packed.split_packed(df, "k", "tags").collect())
    assert got == [(1, 1, "a"), (1, 2, "b"), (4, 1, "a, b"), (5, 1, "a, b")]
    assert packed.split_packed(df.limit(0), "k", "tags").count() == 0
    assert [r["value"] for r in packed.dictionary(df, "tags").collect()] == ["a, b"]
    with pytest.raises(ValueError):
        packed.split_packed(df, "k", "tags", protect="all")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet='ab ,;|"\\x', min_size=1, max_size=8).filter(lambda s: s.strip() == s and s), max_size=5))
def test_round_trip_of_quoted_values(values):
    field = ";".join('"' + v.replace("\\", "\\\\").replace('"', '""') + '"' for v in values)
    assert [v for v, _ in packed.segments(field)] == values


COLUMNS = [f"c{i}" for i in range(4)]


def _brute(line):
    """(reason, cells) by a plain state machine over characters."""
    if line is None:
        return "wrong_column_count", None
    cells, i, n = [], 0, len(line)
    while True:
        cell = ""
        if i < n and line[i] == '"':
            i += 1
            while True:
                if i >= n:
                    return "broken_quoting", None
                if line[i] == '"':
                    if line[i + 1 : i + 2] == '"':
                        cell, i = cell + '"', i + 2
                        continue
                    i += 1
                    break
                cell, i = cell + line[i], i + 1
            if i < n and line[i] != ",":
                return "broken_quoting", None
        else:
            while i < n and line[i] != ",":
                if line[i] == '"':
                    return "broken_quoting", None
                cell, i = cell + line[i], i + 1
        cells.append(cell)
        if i >= n:
            return (None, cells) if len(cells) == 4 else ("wrong_column_count", None)
        i += 1


def test_rejects_against_brute_force(spark):
    rng = random.Random(5)
    lines = ["".join(rng.choice('a,"\n b') for _ in range(rng.randrange(14))) for _ in range(1500)] + ["", None, 'a,"b, ""c""",d,e', "x" * 200_000 + ",1,2,3"]
    df = spark.createDataFrame(list(enumerate(lines)), "n bigint, line string")
    got = {r["key"]: r for r in rejects.parse_records(df, "n", "line", COLUMNS).collect()}
    for i, line in enumerate(lines):
        reason, cells = _brute(line)
        assert got[i]["reason"] == reason, repr(line)
        if reason is None:
            assert [got[i][c] or "" for c in COLUMNS] == cells, repr(line)


def test_reject_table_gives_the_reasons(spark, monkeypatch):
    lines = ["a,b,c,d", "a,b,c", "a,b,c,d,e", 'a,"b",c\ue000,d', "a,b", "\ue000,1,2"]
    assert {i: k for i, k in rejects._load(lines[:3], 4)[1].items()} == {1: "MISSING COLUMNS", 2: "TOO MANY COLUMNS"}
    df = spark.createDataFrame(list(enumerate(lines)), "n bigint, line string").coalesce(1)
    got = {r["key"]: r for r in rejects.parse_records(df, "n", "line", COLUMNS).collect()}
    assert [got[i]["reason"] for i in range(6)] == [None, "wrong_column_count", "wrong_column_count", None, "wrong_column_count", "wrong_column_count"]
    assert got[3]["c2"] == "c\ue000"


@pytest.mark.parametrize(("value", "want"), [
    ("2024-02-29T23:59:59Z", True), ("2023-02-29T00:00:00Z", False), ("2024-01-01T24:00:00Z", False), ("", True), (None, True), (" ", False), ("2024-01-01", False),
    ("2024-01-01T00:00:00Z\n", False), ("1712041200", False),
])
def test_is_instant(one, value, want):
    assert one(rejects.is_instant(F.col("x")), x=value) is want


def test_reasons_in_order(spark):
    rows = [("x", "", "bad", ""), ("1", " ", "bad", ""), ("1", "a", "bad", ""), ("1", "a", None, "2024-01-01T00:00:00Z"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "item_id string, name string, created_at_utc string, updated_at_utc string")
    assert [r["r"] for r in df.select(rejects.invalid_reason().alias("r")).collect()] == ["non_numeric_item_id", "blank_name", "bad_timestamp", None, "non_numeric_item_id"]


def test_half_up():
    assert [quantities.half_up(x) for x in (0.5, 1.5, 2.4999, 2.5)] == [1, 2, 2, 3]
    assert not math.isnan(quantities.half_up(1e12))
