"""Session settings, table access and lineage cutting."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession


def build_session(name: str = "shelfspark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every operator assumes; keyword arguments override (dots as ``__``)."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.variant.allowDuplicateKeys": "true",
        "spark.ui.enabled": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    builder = SparkSession.builder.appName(name).config(map=settings)
    return (builder.master(master) if master else builder).getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the folder that ``spark.checkpoint.dir`` names.

    The folder must be shared by all executors. Only where neither the context nor the configuration
    names one, and the master is local (tests), a temporary folder is used.
    """
    _checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """The rows as Parquet in the checkpoint folder, a small part of what a checkpoint of wide rows takes; the files go when the driver ends."""
    folder = f"{_checkpoint_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    atexit.register(drop_stored, df.sparkSession, folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def drop_stored(spark: SparkSession, folder: str) -> None:
    """Delete what ``stored`` wrote to the folder, if the session still runs."""
    try:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # noqa: BLE001 - the session has ended; the folder is the cluster's to clear
        return


def _checkpoint_folder(spark: SparkSession) -> str:
    """The folder of this application's checkpoints, set if it was not."""
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
            folder = tempfile.mkdtemp(prefix="shelfspark-checkpoint-", dir=os.environ.get("TMPDIR"))
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
    return context._jsc.sc().getCheckpointDir().get()


def plain(pdf: pd.DataFrame) -> pd.DataFrame:
    """A frame as Spark takes it back: text as objects, and an empty frame without guessed numeric types."""
    if pdf.empty:
        return pdf.astype(object)
    return pdf.astype({c: object for c in pdf.columns if isinstance(pdf[c].dtype, pd.StringDtype)})


def width(spark: SparkSession, per_core: int = 2) -> int:
    """Partitions for CPU-heavy work on few bytes: some per core of the cluster.

    Never the number of shuffle partitions: a repartition equal to its child's partitioning is optimised out, and
    the shuffle left in its place is coalesced by size until few cores are busy.
    """
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(shuffle, per_core * spark.sparkContext.defaultParallelism)
    return wanted + 1 if wanted == shuffle else wanted


def spread(df: DataFrame, per_core: int = 2) -> DataFrame:
    """Spread rows evenly before a Python stage when the scan yields fewer splits than the cluster has cores."""
    spark = df.sparkSession
    wanted = width(spark, per_core)
    return df.repartition(wanted) if df.rdd.getNumPartitions() < spark.sparkContext.defaultParallelism else df
