"""Catalogue files and the files that a run reads again. Every column is read as text: ids must stay as written."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.plans.match import last_delivered, quarantine

A_COLUMNS = (
    "item_id name brand_raw name_clean description category department url item_type item_info tags subcategory "
    "is_private_label sizing_comp size_raw datapoint_id raw_data_id created_at_utc updated_at_utc"
).split()
B_COLUMNS = (
    "item_id name brand_raw name_clean description category department url is_organic item_info tags subcategory "
    "sizing_comp size_raw datapoint_id raw_data_id created_at_utc updated_at_utc"
).split()


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Quoted cells may hold quotes (doubled) and line breaks; empty cells are null; a byte-order mark is no part of a name."""
    reader = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').option("encoding", "UTF-8")
    if columns:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns])).option("enforceSchema", True)
    df = reader.csv(path)
    return df.toDF(*(c.lstrip("\ufeff") for c in df.columns))


def with_arrival(df: DataFrame) -> DataFrame:
    """``row_ord`` in the order of the files' rows; increasing, not consecutive."""
    return df.withColumn("row_ord", F.monotonically_increasing_id())


def read_products(spark: SparkSession, path: str, source: str) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantined) rows of a catalogue of source A or B."""
    if source not in ("A", "B"):
        raise ValueError("source is 'A' or 'B'")
    rows = quarantine(with_arrival(read_csv(spark, path, A_COLUMNS if source == "A" else B_COLUMNS)))
    return rows.where("quarantine_reason is null").drop("quarantine_reason"), rows.where("quarantine_reason is not null")


def read_latest(spark: SparkSession, path: str, source: str) -> DataFrame:
    """Valid rows, the last of every id."""
    return last_delivered(read_products(spark, path, source)[0])


def valid_ids(df: DataFrame) -> DataFrame:
    return df.select("item_id").distinct()


def file_megabytes(spark: SparkSession, path: str) -> float:
    """Size of a file or folder to two places, by the file system that the path names."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return round(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength() / 1e6, 2)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    df = read_csv(spark, path)
    names = {c: c.lower() for c in df.columns}
    numbers = {"score", "retrieval_score", "top1_top2_margin", "llm_confidence"}
    return df.select(*(F.col(c).try_cast("double").alias(n) if n in numbers else F.col(c).alias(n) for c, n in names.items()))


def read_annotations(spark: SparkSession, path: str) -> DataFrame:
    """(item_id_a, item_id_b, label, notes): labels lower-cased and stripped, rows without id or content left out; empty for no file."""
    if "://" not in path and not os.path.exists(path):
        return spark.createDataFrame([], "item_id_a string, item_id_b string, label string, notes string")
    df = read_csv(spark, path).toDF(*(c.lower() for c in read_csv(spark, path).columns))
    out = df.select("item_id_a", F.coalesce("item_id_b", F.lit("")).alias("item_id_b"), F.lower(F.trim(F.coalesce("label", F.lit("")))).alias("label"), F.rtrim(F.coalesce("notes", F.lit(""))).alias("notes"))
    return out.where((F.coalesce("item_id_a", F.lit("")) != "") & ((F.col("label") != "") | (F.col("notes") != "")))


def labels(spark: SparkSession, path: str) -> DataFrame:
    return read_annotations(spark, path).where("label != ''").select("item_id_a", "item_id_b", "label")


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """(cache_key, opinion, line_no) of a JSON-lines cache: blank and malformed lines and lines without key or opinion left out."""
    schema = "key string, opinion struct<same_product_for_customer:boolean,confidence:double,reason:string,blocking_issue:string,raw_response_id:string,parse_error:boolean>"
    text = spark.read.text(path).withColumn("line_no", F.monotonically_increasing_id())
    parsed = text.where("trim(value) != ''").select("line_no", F.from_json("value", schema).alias("j"))
    return parsed.select(F.col("j.key").alias("cache_key"), "j.opinion", "line_no").where("cache_key is not null and opinion is not null")


def literal_queries(spark: SparkSession, texts: list[str]) -> DataFrame:
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "query_id bigint, text string")
