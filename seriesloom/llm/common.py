"""Helpers shared by the operators: tables, text columns, the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: Runs of the six ASCII white-space characters, for Java and for RE2.
WHITE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: Column | str) -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all other characters left alone (`lower` would change É too)."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def let(value: Column, body) -> Column:
    """body(value) with value computed once, also inside lambdas of the body."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    return F.filter(F.split(text, WHITE), lambda w: w != "")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session. A folder of our own only on a local master without it."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="llm-"))
    return sc.getCheckpointDir().rstrip("/")


def store(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Writes df as Parquet in the shared folder and reads it back; also returns the path."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """df with its lineage cut: lost executors lose nothing that was computed before."""
    return store(df, name)[0]


def discard(spark: SparkSession, path: str) -> None:
    """Removes a table that store() wrote and that no later step reads."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
