"""Append-only prediction and verdict logs."""

from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..schemas import PREDICTION_FIELDS, PREDICTIONS, VERDICT_LOG


def prediction_rows(records: DataFrame, run_id: str, run_at: datetime) -> DataFrame:
    """The 17 logged fields; id and time are the run's own, so a repeat gives the same rows."""
    return records.select(
        F.sha2(F.concat_ws(":", F.lit(run_id), "video_id"), 256).alias("id"),
        *PREDICTION_FIELDS.names,
        F.lit(run_at).cast("timestamp").alias("created_at"), F.lit(run_id).alias("run_id"),
    )


def append_predictions(records: DataFrame, path: str, run_id: str, run_at: datetime) -> None:
    """Add one run. The run is its own directory: repeating it with its time changes nothing, and
    verdicts given since still apply."""
    append_runs(prediction_rows(records, run_id, run_at), path)


def append_runs(rows: DataFrame, path: str) -> None:
    """Add or replace the runs in ``rows(run_id, created_at, ...)``, and note each one's times.

    The notes (rows, oldest and newest time per run) are written after the rows. A run whose note is
    missing, because its job ended in between, is read as one that may hold anything.
    """
    def put(df: DataFrame, where: str) -> None:
        df.write.partitionBy("run_id").mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").parquet(where)

    put(rows, path)
    runs = rows.select("run_id").distinct()
    back = rows.sparkSession.read.schema(rows.schema).parquet(path).join(
        F.broadcast(runs) if _few(runs) else runs, "run_id", "left_semi")
    put(back.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("created_at").alias("oldest"),
        F.max("created_at").alias("newest")).coalesce(1), _zones(path))


ZONES = "run_id string, n long, oldest timestamp, newest timestamp"
_FEW_RUNS = 100_000


def _zones(path: str) -> str:
    return path.rstrip("/") + "_zones"


def _few(runs: DataFrame) -> bool:
    return runs.limit(_FEW_RUNS + 1).count() <= _FEW_RUNS


def read_newest(spark: SparkSession, path: str, limit: int, schema: T.StructType = PREDICTIONS
                ) -> DataFrame:
    """All runs of a log that can hold one of its newest ``limit`` rows; the others are pruned.

    T is the latest time with at least ``limit`` rows in runs that start at or after it. Rows before T
    cannot be among the newest, so runs that end before T are not read; ties at T are.
    """
    log = spark.read.schema(schema).parquet(path)
    noted = set(_run_folders(spark, _zones(path)))
    if not noted:
        return log
    zones = spark.read.schema(ZONES).parquet(_zones(path))
    # a row per run
    upto = F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy(F.desc("oldest")))
    cut = zones.withColumn("upto", upto).where(F.col("upto") >= limit).agg(F.max("oldest")).first()[0]
    if cut is None:
        return log
    late = {r[0] for r in zones.where(F.col("newest") >= F.lit(cut)).select("run_id").collect()}
    wanted = [r for r in _run_folders(spark, path) if r in late or r not in noted]
    return log.where(F.col("run_id").isin(*wanted))


def _run_folders(spark: SparkSession, path: str) -> list[str]:
    """Runs of a log by the names of its folders; none where there is no such folder."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []
    return [unquote(n.removeprefix("run_id=")) for n in names if n.startswith("run_id=")]


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PREDICTIONS).parquet(path)


def append_verdicts(verdicts: DataFrame, path: str) -> None:
    """Add reviewer verdicts (video_id, verdict, reviewed_by, reviewed_at), whatever they say."""
    verdicts.select(
        F.sha2(F.concat_ws(":", "video_id", "verdict", "reviewed_by", "reviewed_at"), 256)
        .alias("id"),
        "video_id", "verdict", "reviewed_by", "reviewed_at",
    ).write.mode("append").parquet(path)


def unknown_verdicts(verdicts: DataFrame) -> DataFrame:
    """Verdicts outside the vocabulary, NULL included, with their counts; logged all the same."""
    known = F.coalesce(F.col("verdict").isin(*K.VERDICTS), F.lit(False))
    return verdicts.where(~known).groupBy("verdict").agg(F.count(F.lit(1)).alias("n"))


def read_verdicts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(VERDICT_LOG).parquet(path)


def write_predictions_jdbc(records: DataFrame, url: str, table: str, run_id: str,
                           run_at: datetime, **options: str) -> None:
    """The same rows to a database table, in parallel batches instead of one insert per row.

    Rows carry their id: with a key on it, a retried task cannot insert a row twice.
    """
    rows = prediction_rows(records, run_id, run_at).drop("run_id")
    rows.write.mode("append").options(**options).jdbc(url, table)
