"""Registered queries over small tables of their own: no row of the input is left out."""

from shelfspark.queries import catalogue, matching


def save(df, folder, name):
    df.write.parquet(f"{folder}/{name}.parquet")


def test_known_brands_reads_the_whole_list(spark, tmp_path):
    words = [a + b + c for a in "bdfgklm" for b in "aeiou" for c in ("rn", "st", "lk", "nd", "mp", "ft", "sk", "nt")]
    save(spark.createDataFrame([(1000 + i, w.title()) for i, w in enumerate([*words, f"{words[3]} farm"])], "brand_id bigint, brand_name string"), tmp_path, "brand_list")
    schema = "row_ord bigint, name string"
    save(spark.createDataFrame([(1, f"{words[3].title()} Tea"), (2, f"{words[250].title()} Tea"), (3, "Tea"), (4, None), (7, f"{words[3].upper()}  Farm tea"), (8, "")], schema), tmp_path, "mini_a")
    save(spark.createDataFrame([(5, words[-1]), (6, words[-1] + "s tea")], schema), tmp_path, "mini_b")
    got = {r["row_ord"]: r["brand"] for r in catalogue.known_brands(spark, str(tmp_path)).collect()}
    assert got == {1: words[3], 2: words[250], 5: words[-1], 7: f"{words[3]} farm"}


def test_required_rows_reads_the_whole_table(spark, tmp_path):
    save(spark.createDataFrame([(i, f"{i % 900}" if i else None) for i in range(1000)], "row_ord bigint, item_id string"), tmp_path, "mini_a")
    save(spark.createDataFrame([("5", "x", "accepted", "r", "s"), ("850", "y", "accepted", "r", "s")], "item_id_a string, item_id_b string, decision string, reason string, source string"), tmp_path, "matches_audit")
    got = {r["item_id_a"]: (r["item_id_b"], r["decision"]) for r in matching.required_rows(spark, str(tmp_path)).collect()}
    assert set(got) == {str(i) for i in range(900)} and got["850"] == ("y", "accepted") and got["800"] == (None, "absent_from_audit")
