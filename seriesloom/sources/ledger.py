"""A run ledger: what was done with each series, stage by stage, and what went wrong.

A ledger is a table of (batch, series, stage, error); error is null where the series was done. A batch overwrites only its
own rows, so a batch can be repeated. A restart leaves out what an earlier run has done; what failed is tried again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.session import cut_lineage
from seriesloom.sources import sinks

SCHEMA = "batch string, series string, stage string, error string"


def entries(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a ledger; none where there is no ledger yet."""
    try:
        return spark.read.schema(SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], SCHEMA)
        raise


def record(status: DataFrame, path: str, batch: str, stage: str) -> None:
    """Writes (series, error) rows of a batch; repeating a batch replaces them."""
    rows = status.select(F.lit(batch).alias("batch"), "series", F.lit(stage).alias("stage"), F.col("error").cast("string").alias("error"))
    sinks.write_parts(rows, path, ("batch", "stage"))


def unfinished(df: DataFrame, path: str, stage: str) -> DataFrame:
    """Rows of the series that no batch has done yet in a stage."""
    done = entries(df.sparkSession, path).where((F.col("stage") == stage) & F.col("error").isNull())
    return df.join(done.select("series").distinct(), "series", "left_anti")


def latest(spark: SparkSession, path: str) -> DataFrame:
    """(series, stage, error): done if any batch has done it, else the error of the last batch by name."""
    done = F.bool_or(F.col("error").isNull())
    return entries(spark, path).groupBy("series", "stage").agg(F.when(~done, F.max_by("error", "batch")).alias("error"))


def run(rows: DataFrame, status: DataFrame, path: str, batch: str, stage: str, work: Callable[[DataFrame], None]) -> int:
    """work(rows) on the series that are neither done nor ruled out, and a ledger row for every series of the batch.

    ``status`` has (series, error); an error there rules a series out. Where work raises, its series get the text of the
    error and the batch ends; other batches are not touched. Returns the number of series that were worked on.
    """
    spark = rows.sparkSession
    todo = cut_lineage(unfinished(status.join(rows.select("series").distinct(), "series", "left_semi").select("series", "error"), path, stage))
    able = todo.where(F.col("error").isNull()).select("series")
    n = able.count()
    failed = None
    if n:
        try:
            work(rows.join(able, "series", "left_semi"))
        except Exception as e:  # noqa: BLE001  whatever a fit raises costs its batch only
            failed = f"{type(e).__name__}: {e}"[:500]
    error = F.coalesce(F.col("error"), F.lit(failed).cast("string"))
    if not todo.isEmpty():
        record(todo.select("series", error.alias("error")), path, batch, stage)
    return n
