"""Text, JSON, size and attribute expressions, with the traps of both engines."""

import pytest
from pyspark.sql import functions as F

from shelfspark.functions import attrs, semi, sizes, taxonomy
from shelfspark.functions import text as tx


@pytest.mark.parametrize(("value", "want"), [("\t a \n", "a"), ("", ""), (None, None), ("a  b", "a  b")])
def test_strip_takes_any_white_space(one, value, want):
    assert one(tx.strip(F.col("x")), x=value) == want


@pytest.mark.parametrize(("value", "want"), [("12", True), ("12\n", False), (" 12", False), ("1.5", False), ("-1", False), ("", False), (None, False), ("１２", False)])
def test_numeric_id(one, value, want):
    assert one(tx.is_numeric_id(F.col("x")), x=value) is want


@pytest.mark.parametrize(("value", "want"), [(None, True), (" \t", True), ("None", True), ("{}", True), ("x", False)])
def test_missing(one, value, want):
    assert one(tx.is_missing(F.col("x")), x=value) is want


def test_longest_prefix_is_word_bounded(one):
    names = ["ol roy", "ol", "great value"]
    assert one(tx.longest_prefix(F.col("x"), names), x="ol roy bites") == "ol roy"
    assert one(tx.longest_prefix(F.col("x"), names), x="older") is None
    assert one(tx.longest_prefix(F.col("x"), names), x="ol") == "ol"


def test_number_text_and_gap(one):
    assert one(tx.number_text(F.col("x")), x=8.0) == "8"
    assert one(tx.number_text(F.col("x")), x=5.3) == "5.3"
    assert one(tx.relative_gap(F.col("x"), F.lit(0.0)), x=0.0) == 0.0
    assert one(tx.percent(F.lit(1), F.col("x")), x=0) == 0.0


def test_fold_ascii(one):
    assert one(tx.fold_ascii(F.col("x")), x="Crème & Co ™ 'n Café®") == "creme and co n cafe"


@pytest.mark.parametrize(("cell", "want"), [
    ('{"a":1}', "valid_dict"), ("[1]", "valid_other"), ("{'a':1}", "invalid"), ('{"a":1} tail', "invalid"), ('{"a":1,"a":2}', "valid_dict"),
    ("", "blank"), (None, "blank"), ('{"a":', "invalid"), ("null", "valid_other"),
])
def test_json_status(one, cell, want):
    assert one(semi.json_status(F.col("x")), x=cell) == want


def test_json_types_are_kept(one):
    v = semi.json_object(F.col("x"))
    assert one(semi.is_true(v, "k"), x='{"k":true}') is True
    assert one(semi.is_true(v, "k"), x='{"k":"true"}') is False
    assert one(semi.says_true(v, "k"), x='{"k":"True "}') is True
    assert one(semi.attribute(v, "k"), x='{"k":5}') is None
    assert one(semi.attribute(v, "k"), x='{"k":" Liquid "}') == "liquid"
    assert one(semi.attribute(v, "k"), x="[]") is None


@pytest.mark.parametrize(("cell", "want"), [
    ("", []), (None, []), ("{}", []), ("[]", []), ("{a,b}", ["a", "b"]), ('{"a b",c}', ["a b", "c"]), ('["a","b"]', ["a", "b"]), ("['a b', 'c']", ["a b", "c"]),
    ("a,b", ["a", "b"]), ("single", ["single"]), ('["a",', ["a"]),
])
def test_tags(one, cell, want):
    assert one(semi.tags(F.col("x")), x=cell) == want


def test_tags_without_split(one):
    assert one(semi.tags(F.col("x"), split_plain=False), x="a,b") == ["a,b"]


def test_key_paths(one):
    assert sorted(one(semi.key_paths(F.col("x")), x='{"a":{"b":1,"c":{"d":2}},"e":[1]}')) == ["a.b", "a.c.d", "e"]
    assert one(semi.key_paths(F.col("x")), x="[1]") is None


@pytest.mark.parametrize(("text", "want"), [
    ("Milk 1 gallon", ("gal", 1.0, 1)), ("12 x 5.3 ounce", ("oz", 5.3, 12)), ("12 x 5.3 ounce (63.6 oz)", ("oz", 5.3, 12)), ("5.3oz cup", ("oz", 5.3, 1)),
    ("8 fl oz", ("fl oz", 8.0, 1)), ("1 gal", None), ("6 floz", None), ("none", None), (None, None), ("8 counts", None),
])
def test_size_in_text(one, text, want):
    got = one(sizes.size_in_text(F.col("x")), x=text)
    assert (got and (got["unit"], got["unit_size"], got["pack_count"])) == want


def test_size_of_rows(spark):
    df = spark.createDataFrame([
        (1, "(12 Pack) Soda, 8 fl oz", None), (2, "(4 pack) Soda", '{"size_user_friendly":"2 x 8 ounce"}'), (3, "(4 pack) Soda", '{"size_user_friendly":"8 ounce"}'), (4, "Soda", None), (5, None, None),
    ], "k int, name string, sizing_comp string")
    got = {r["k"]: r["size"].asDict() for r in sizes.with_size(df, "A").collect()}
    assert got[1] == {"unit": "fl oz", "unit_size": 8.0, "pack_count": 12, "total_size": 96.0}
    assert (got[2]["pack_count"], got[3]["pack_count"], got[4]["pack_count"], got[5]["pack_count"]) == (2, 4, 1, 1)
    b = {r["k"]: r["size"]["pack_count"] for r in sizes.with_size(df, "B").collect()}
    assert b == {1: 1, 2: 2, 3: 1, 4: 1, 5: 1}


def test_base_size_families(spark):
    row = spark.range(1).select(sizes.base_size(sizes.size_struct(F.lit("lb"), F.lit(2.0), F.lit(3))).alias("a"), sizes.base_size(sizes.size_struct(F.lit("stone"), F.lit(2.0), F.lit(3))).alias("b")).first()
    assert (row["a"]["family"], row["a"]["value"], row["b"]) == ("weight", 96.0, None)


def test_profile_sizes(one):
    got = one(sizes.all_sizes(F.col("x")), x="Box of 6 x 330 ml and 1 1/2 lb, 12 ct")
    assert [(s["value"], s["unit"], s["pack"]) for s in got] == [(330.0, "ml", 6), (1.5, "lb", None), (12.0, "ct", None)]
    assert one(sizes.best_size(sizes.all_sizes(F.col("x"))), x="1 lb 12 ct")["unit"] == "lb"
    assert one(sizes.best_size(sizes.all_sizes(F.col("x"))), x="") is None
    assert one(sizes.number_in(F.col("x")), x="3/0") is None


def test_attributes(one):
    assert one(attrs.first_word(F.col("x"), attrs.FORM_WORDS), x="Whole Bean ground coffee") == "whole_bean"
    assert one(attrs.first_word(F.col("x"), attrs.FORM_WORDS), x="underground") is None
    assert one(attrs.core_name(F.col("x"), F.lit("acme")), x="(12 pack) ACME Acmeade, 8 oz bottle") == "acmeade"
    assert one(attrs.core_name(F.col("x"), F.lit("ac")), x="Acme Tea") == "me tea"  # not bounded by words
    assert one(attrs.is_own_label(F.col("x")), x="sam's choice") is False
    assert one(attrs.brand_of_name(F.col("x")), x="Sam's Choice Cola") == "sam s choice"
    assert one(attrs.brand_of_name(F.col("x"), brands=("Acme", "Acme Gold")), x="acme gold tea") == "acme gold"


@pytest.mark.parametrize(("path", "want"), [
    (("Food", "Beverages", "Red Wine"), "wine_beer_spirits"), (("food", "Dairy & Eggs", "Cheese"), "cheese"), (("food", "Dairy & Eggs", "Milk"), "dairy"),
    (("Home", "Kitchen & Dining", None), "kitchen_home"), (("Home", "Decor", None), None), (("Pets", None, None), "pets"), ((None, None, None), None),
])
def test_groups_a(spark, path, want):
    df = spark.createDataFrame([path], "category_0 string, category_1 string, category_2 string")
    assert taxonomy.with_group(df, taxonomy.RULES_A).first()["matchable_group"] == want


@pytest.mark.parametrize(("path", "want"), [
    (("Dairy", "Yogurt", "Cream Cheese"), "cheese"), (("Dairy", "Yogurt", None), "dairy"), (("More Departments", "Deli", "Ham"), "meat"),
    (("More Departments", "Deli", "x"), "prepared_foods"), (("More Departments", "Bulk Foods", "Bulk Nuts"), "snacks"), (("Grocery", "Soda", None), "beverages"),
    (("More Departments", "Personal Care & Makeup", "Hair Care"), "beauty"), (("Grocery", "Unheard of", None), None),
])
def test_groups_b(spark, path, want):
    df = spark.createDataFrame([path], "category_0 string, category_1 string, category_2 string")
    assert taxonomy.with_group(df, taxonomy.RULES_B).first()["matchable_group"] == want


def test_compatible_groups(one):
    assert one(taxonomy.compatible(F.col("x"), F.lit("cheese")), x="dairy") is True
    assert one(taxonomy.compatible(F.col("x"), F.lit("cheese")), x=None) is False
    assert one(taxonomy.compatible(F.col("x"), F.lit("snacks")), x="dairy") is False


def test_scope_is_a_parameter(one):
    e = taxonomy.in_scope(F.col("x"), F.lit("Wall Art"), ("toys",), {"home": ("wall art",)})
    assert one(e, x="Toys") == "excluded_category"
    assert one(e, x="Home") == "excluded_home"
    assert one(e, x="Food") is None
