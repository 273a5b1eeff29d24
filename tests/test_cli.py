"""The command lines end to end on a small pair of tables, and the driver's entry points."""

import os

import __spark_entry__
import pytest

from shelfspark import cli

SF = "/root/testdata/sf0.001"


@pytest.fixture
def tables(spark, tmp_path):
    rows = [(i, str(i), f"Acme Jam {w}, 10 oz", "Acme", None, '{"category_0":"Food","category_1":"Pantry"}', None, None) for i, w in enumerate(["Plum", "Fig", "Lime"], start=1)]
    b = [(r[0] + 10, str(r[0] + 10), r[2].replace(", 10 oz", ""), "Acme", '{"size_user_friendly":"10 oz"}', '{"category_0":"Grocery","category_1":"Pantry"}', None, None) for r in rows]
    schema = "row_ord bigint, item_id string, name string, brand_raw string, sizing_comp string, item_info string, tags string, is_organic string"
    for n, x in (("a", rows), ("b", b)):
        spark.createDataFrame(x, schema).selectExpr("*", "'' as description").write.parquet(str(tmp_path / f"{n}.parquet"))
    return tmp_path


def test_match_sample_profile_probe(spark, tables, capsys):
    t = str(tables)
    common = ["--a", f"{t}/a.parquet", "--b", f"{t}/b.parquet"]
    assert cli.main(["match", *common, "--out", f"{t}/out", "--min-rows", "3"]) == 0
    assert open(f"{t}/out/matches.csv").read().splitlines() == ["item_id_A,item_id_B", "1,11", "2,12", "3,13"]
    assert cli.main(["match", *common, "--out", f"{t}/out", "--min-rows", "4"]) == 1
    assert cli.main(["sample", "--audit", f"{t}/out/audit", "--out", f"{t}/s.csv"]) == 0
    assert len(open(f"{t}/s.csv").read().splitlines()) == 4
    assert cli.main(["profile", *common, "--out", f"{t}/p.md"]) == 0
    assert "Shared brands" in open(f"{t}/p.md").read()
    assert cli.main(["probe", "--b", f"{t}/b.parquet", "fig jam"]) == 0
    assert "## BM25" in capsys.readouterr().out


def test_every_sql_has_its_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")
def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
