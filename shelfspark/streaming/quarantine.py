"""Arriving feed files split into loaded and rejected records by one incremental query.

``availableNow`` takes what has arrived since the last run and stops; the checkpoint makes each file count once. The
transformation is the batch one: parsing is local to a record, so no state and no watermark are needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfspark.sources.catalog import A_COLUMNS
from shelfspark.sources.rejects import invalid_reason, parse_records


def split_feed(lines: DataFrame, columns: list[str] = A_COLUMNS) -> DataFrame:
    """(line_no, *columns, reason) of raw feed lines, batch or stream."""
    parsed = parse_records(lines, "line_no", "line", list(columns)).withColumnRenamed("key", "line_no")
    return parsed.withColumn("reason", F.coalesce("reason", invalid_reason()))


def start(lines: DataFrame, loaded: str, rejected: str, checkpoint: str) -> StreamingQuery:
    """Write valid records to ``loaded`` and the others to ``rejected`` as Parquet, micro-batch by micro-batch."""

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            batch.where("reason is null").drop("reason").write.mode("overwrite").parquet(f"{loaded}/batch={number}")
            batch.where("reason is not null").select("line_no", "reason").write.mode("overwrite").parquet(f"{rejected}/batch={number}")
        finally:
            batch.unpersist()

    return split_feed(lines).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
