"""Writers that can be repeated.

Results that are written in batches of series carry the name of their batch as the first partition
column. A batch overwrites only itself: batches of other series stay, whatever grains they share, and a run
that stopped half-way repeats its batch under the same name. ``read_batches`` returns all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH = "run_batch"


def _overwrite(df: DataFrame, path: str, by: tuple[str, ...], fmt: str = "parquet") -> str:
    writer = df.write.mode("overwrite").format(fmt).option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        writer = writer.option("header", True)
    if by:
        writer = writer.partitionBy(*by)
    writer.save(path)
    return path


def _batch(df: DataFrame, path: str, batch: str, by: tuple[str, ...], fmt: str) -> str:
    return _overwrite(df.withColumn(BATCH, F.lit(batch)), path, (BATCH, *by), fmt)


def read_batches(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None) -> DataFrame:
    """The rows of every batch under path."""
    reader = spark.read.format(fmt).option("header", True)
    if schema is not None:
        reader = reader.schema(f"{schema}, {BATCH} string")
    return reader.load(path).drop(BATCH)


def write_forecast(df: DataFrame, path: str, batch: str = "all", fmt: str = "parquet") -> str:
    """Forecast rows under grain folders.

    Series stays a data column: one folder per series would mean as many small
    files as there are series.
    """
    return _batch(df.repartitionByRange("grain", "series", "date"), path, batch, ("grain",), fmt)


def write_scores(df: DataFrame, path: str, batch: str = "all", fmt: str = "parquet") -> str:
    """Score rows by grain; called once for every batch of series."""
    return _batch(df, path, batch, ("grain",), fmt)


def write_clusters(df: DataFrame, path: str, batch: str = "all", fmt: str = "csv") -> str:
    """Cluster assignments, one folder per cluster."""
    return _batch(df, path, batch, ("cluster",), fmt)


def write_parts(df: DataFrame, path: str, by: tuple[str, ...]) -> str:
    """Rows under folders of ``by``; only the folders that df has rows for are replaced."""
    return _overwrite(df, path, by)


def write_merged(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """A merged table or prediction set as it is."""
    return _overwrite(df, path, (), fmt)


def write_multi(tables: dict[str, DataFrame], path: str, fmt: str = "parquet") -> dict[str, str]:
    """Several result tables under one path, one folder each."""
    return {name: _overwrite(df, f"{path}/{name}", (), fmt) for name, df in tables.items()}


def write_params(df: DataFrame, path: str, batch: str = "all") -> str:
    """(series, params map) as JSON lines."""
    return _batch(df.select("series", "params"), path, batch, (), "json")


def summary_rows(scores: DataFrame, clusters: DataFrame) -> DataFrame:
    """(series, cluster, grain, metric, value): the per-series summary as a table."""
    metrics = [c for c in scores.columns if c not in ("series", "grain")]
    long = scores.unpivot(["series", "grain"], metrics, "metric", "value")
    return long.join(clusters.select("series", "cluster"), "series", "left").select(
        "series", "cluster", "grain", "metric", "value"
    )


def write_summary(scores: DataFrame, clusters: DataFrame, path: str, batch: str = "all") -> str:
    return _batch(summary_rows(scores, clusters), path, batch, ("grain",), "parquet")


def write_series_dir(df: DataFrame, path: str, stem: str = "stem") -> str:
    """One folder of CSV per series file name, for exchange with per-file tools.

    Rows are dealt by ranges of all columns, so a stem that holds many rows is written by many tasks, a file each.
    """
    rest = [c for c in df.columns if c != stem]
    df.repartitionByRange(stem, *rest).write.mode("overwrite").partitionBy(stem).csv(path, header=True)
    return path
