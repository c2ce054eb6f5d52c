"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

# Settings for any cluster size. AQE picks the number of reduce tasks from the
# shuffled bytes and splits skewed join partitions, so no partition count is fixed here.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A shuffled panel row fans out into calendar days and frames of up to a year of
    # rows, so little shuffled data is already much work for a task.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
}


def local_session(app: str = "seriesloom", cores: str = "*", **conf: str) -> SparkSession:
    """A session for tests and benches on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir`` or the context's checkpoint folder.

    Only on a local master, as in tests, a new temporary folder is used where neither is set.
    """
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="seriesloom-"))
        root = context.getCheckpointDir()
    return root.rstrip("/")


_MADE: list[str] = []
_KNOWN: dict[tuple, object] = {}


def remembered(spark: SparkSession, key: tuple, make: Callable):
    """What make() gave the first time in this session; ``release`` forgets it. For values and tables as small as a calendar."""
    at = (spark.sparkContext.applicationId, *key)
    if at not in _KNOWN:
        _KNOWN[at] = make()
    return _KNOWN[at]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing else has used; ``release`` removes it."""
    path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def discard(context: SparkContext, path: str) -> None:
    """Removes a folder that no later step reads."""
    at = context._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)


def release(spark: SparkSession) -> None:
    """Removes what this process has written to scratch paths; results that still read them are lost."""
    _KNOWN.clear()
    while _MADE:
        discard(spark.sparkContext, _MADE.pop())


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows written as Parquet in the shared folder and read back, so later steps read only the columns they use."""
    spark = df.sparkSession
    path = scratch_path(spark, "cut")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
