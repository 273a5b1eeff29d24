"""Checks of a match file against its contract: every violation is a row, none stops the scan."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from shelfspark.functions.text import is_numeric_id

HEADER = ("item_id_A", "item_id_B")


@dataclass(frozen=True)
class ValidationResult:
    ok: bool
    errors: list[str]
    row_count: int


def violations(pairs: DataFrame, ids_a: DataFrame, ids_b: DataFrame, required: dict[str, str] | None = None, min_rows: int = 0) -> DataFrame:
    """(line_no, kind, item_id_a, item_id_b, expected) of every violation.

    ``pairs``: line_no, item_id_a, item_id_b; ``ids_a``, ``ids_b``: one column item_id each. An id that is no number
    is reported as that alone. A duplicate is any later row of an A id. The pair required of an id is held against
    its last row; violations without a line have a null line_no.
    """
    known_a = ids_a.select(F.col("item_id").alias("item_id_a")).distinct().withColumn("in_a", F.lit(True))
    known_b = ids_b.select(F.col("item_id").alias("item_id_b")).distinct().withColumn("in_b", F.lit(True))
    # The first line of an id by a grouped minimum, not a window: an id that fills a third of the file stays spread.
    first = pairs.groupBy("item_id_a").agg(F.min("line_no").alias("first_line"), F.min_by("item_id_b", "line_no").alias("first_b"))
    rows = pairs.join(first, pairs["item_id_a"].eqNullSafe(first["item_id_a"]), "left").drop(first["item_id_a"])
    rows = rows.join(known_a, "item_id_a", "left").join(known_b, "item_id_b", "left")
    num_a, num_b = is_numeric_id(F.col("item_id_a")), is_numeric_id(F.col("item_id_b"))
    kinds = F.array_compact(F.array(
        F.when(~num_a, F.lit("non_numeric_a")).when(F.col("in_a").isNull(), F.lit("unknown_a")),
        F.when(~num_b, F.lit("non_numeric_b")).when(F.col("in_b").isNull(), F.lit("unknown_b")),
        F.when(F.col("line_no") > F.col("first_line"), F.lit("duplicate_a")),
    ))
    found = rows.select("line_no", F.explode(kinds).alias("kind"), "item_id_a", "item_id_b", "first_b")
    out = found.select("line_no", "kind", "item_id_a", "item_id_b", F.when(F.col("kind") == "duplicate_a", F.col("first_b")).alias("expected"))
    spark = pairs.sparkSession
    if required:
        wanted = spark.createDataFrame(list(required.items()), "item_id_a string, expected string")
        last = pairs.join(F.broadcast(wanted.select("item_id_a")), "item_id_a", "left_semi").groupBy("item_id_a").agg(F.max_by("item_id_b", "line_no").alias("item_id_b"))
        held = wanted.join(last, "item_id_a", "left").where(F.col("item_id_b").isNull() | (F.col("item_id_b") != F.col("expected")))
        out = out.unionByName(held.select(
            F.lit(None).cast("bigint").alias("line_no"), F.when(F.col("item_id_b").isNull(), F.lit("required_missing")).otherwise(F.lit("required_mismatch")).alias("kind"),
            "item_id_a", "item_id_b", "expected",
        ))
    if min_rows:
        short = pairs.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") < min_rows)
        out = out.unionByName(short.select(
            F.lit(None).cast("bigint").alias("line_no"), F.lit("too_few_rows").alias("kind"), F.lit(None).cast("string").alias("item_id_a"),
            F.col("n").cast("string").alias("item_id_b"), F.lit(str(min_rows)).alias("expected"),
        ))
    return out


_CELL = r'"(?:[^"]|"")*"|[^",]*'
#: Messages brought to the driver; a last one says how many more there are.
MOST_MESSAGES = 1000


def _numbered(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, line) of a text file, counted from 1 across its splits: only the lines of each split are summed beforehand."""
    each = spark.read.text(path).select("value", F.monotonically_increasing_id().alias("id")).select("value", "id", F.shiftright("id", 33).alias("part"))
    sizes = each.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # one row a split
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    row = F.col("id").bitwiseAND(2**33 - 1)
    return each.join(F.broadcast(offsets), "part").select((F.col("offset") + row + 1).alias("line_no"), F.col("value").alias("line"))


def _cells(line: Column) -> Column:
    """The cells of a record, quotes undone; a record that is not well quoted is one cell."""
    raw = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(f",({_CELL})"), 1)
    plain = F.transform(raw, lambda c: F.when(c.startswith('"'), F.replace(F.substr(c, F.lit(2), F.char_length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(c))
    return F.when(line.rlike(rf"\A(?:{_CELL})(?:,(?:{_CELL}))*\z"), plain).otherwise(F.array(line))


def _messages(df: DataFrame, text: Callable[[Row], str]) -> list[str]:
    out = [text(r) for r in df.orderBy("line_no").limit(MOST_MESSAGES).collect()]
    more = df.count() - len(out) if len(out) == MOST_MESSAGES else 0
    return out + [f"and {more} more"] * (more > 0)


def read_match_lines(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """(line_no, item_id_a, item_id_b) of a match file, and the errors of its header and of rows with other than two cells.

    Line numbers count from 2 behind the header. The file is read in splits; a record is one line.
    """
    lines = _numbered(spark, path).select("line_no", _cells(F.col("line")).alias("cells"))
    head = lines.where("line_no = 1").select("cells").first()
    errors = []
    if head is None or head["cells"] == [""]:
        return lines.where("false").select("line_no", F.lit("").alias("item_id_a"), F.lit("").alias("item_id_b")), ["file is empty (no header)"]
    if tuple(head["cells"]) != HEADER:
        errors.append(f"invalid header: {head['cells']}")
    body = lines.where("line_no > 1")
    errors += _messages(body.where("size(cells) != 2"), lambda r: f"line {r['line_no']}: expected 2 columns, got {len(r['cells'])}")
    return body.where("size(cells) = 2").select("line_no", F.col("cells")[0].alias("item_id_a"), F.col("cells")[1].alias("item_id_b")), errors


def validate_file(spark: SparkSession, path: str, ids_a: DataFrame, ids_b: DataFrame, min_rows: int = 0, required: dict[str, str] | None = None) -> ValidationResult:
    """Summary of a file's violations; of many, the first messages and how many more there are."""
    import os

    if "://" not in path and not os.path.exists(path):
        return ValidationResult(False, [f"file not found: {path}"], 0)
    pairs, errors = read_match_lines(spark, path)
    errors += _messages(violations(pairs, ids_a, ids_b, required, min_rows), lambda r: f"line {r['line_no']}: {r['kind']} {r['item_id_a']} {r['item_id_b']} {r['expected'] or ''}".strip())
    return ValidationResult(not errors, errors, pairs.count())
