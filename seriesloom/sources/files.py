"""Delimited-file readers with declared schemas (no inference pass over the data)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesloom.functions.calendar import parse_dmy, parse_mon_yy

ORDERS_SCHEMA = T.StructType(
    [
        T.StructField("Product ID", T.StringType()),
        T.StructField("Product Name", T.StringType()),
        T.StructField("Date", T.StringType()),
        T.StructField("Dispatched Quantity", T.DoubleType()),
        T.StructField("Customer Order Quantity", T.DoubleType()),
    ]
)
EXTERNAL_SCHEMA = T.StructType(
    [T.StructField("DATE", T.StringType())]
    + [
        T.StructField(n, T.DoubleType())
        for n in ("ECG_DESP", "TUAV", "PIB_CO", "ISE_CO", "VTOTAL_19", "OTOTAL_19", "ICI")
    ]
)
MONTHLY_SCHEMA = T.StructType(
    [
        T.StructField("YearMonth", T.DateType()),
        T.StructField("Product ID", T.StringType()),
        T.StructField("Product Name", T.StringType()),
        T.StructField("Dispatched Quantity", T.DoubleType()),
        T.StructField("Customer Order Quantity", T.DoubleType()),
    ]
)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.csv(path, schema=schema, header=True)


def read_orders(spark: SparkSession, path: str) -> DataFrame:
    """Order/dispatch rows with the date parsed from dd.MM.yyyy text."""
    raw = read_csv(spark, path, ORDERS_SCHEMA)
    return raw.select(
        F.col("Product ID").alias("series"),
        F.col("Product Name").alias("series_name"),
        parse_dmy(F.col("Date")).alias("date"),
        F.col("Dispatched Quantity").alias("dispatched"),
        F.col("Customer Order Quantity").alias("ordered"),
    )


def read_external(spark: SparkSession, path: str) -> DataFrame:
    """Monthly indicators with the month parsed from 'jan-17' text."""
    raw = read_csv(spark, path, EXTERNAL_SCHEMA)
    return raw.select(parse_mon_yy(F.col("DATE")).alias("month"), *EXTERNAL_SCHEMA.names[1:])


def read_monthly(spark: SparkSession, path: str) -> DataFrame:
    """A ready-made monthly table; the order quantity becomes ``Demand``."""
    raw = read_csv(spark, path, MONTHLY_SCHEMA)
    return raw.select(
        F.col("Product ID").alias("series"),
        F.col("YearMonth").alias("month"),
        F.col("Customer Order Quantity").alias("Demand"),
    )


def file_stem(path: Column) -> Column:
    """Name that identifies a series file.

    ``.../000000012_Item.csv`` gives the file name without its ending and
    ``.../stem=000000012_Item/part-0.csv`` the partition value.
    """
    decoded = F.url_decode(F.regexp_replace(path, r"\+", "%2B"))
    partition = F.regexp_extract(decoded, r"/stem=([^/]+)/[^/]*$", 1)
    return F.when(partition != "", partition).otherwise(F.regexp_extract(decoded, r"([^/]+)\.csv$", 1))


def read_series_dir(
    spark: SparkSession, path: str, schema: T.StructType, skip: tuple[str, ...] = ("combined_data",)
) -> DataFrame:
    """Union of one file (or partition folder) per series, without the files to skip.

    Empty files contribute no rows. The stem column says which file a row is from.
    """
    rows = spark.read.csv(path, schema=schema, header=True, recursiveFileLookup=True)
    with_stem = rows.select("*", file_stem(F.col("_metadata.file_path")).alias("stem"))
    return with_stem.where(~F.col("stem").isin(*skip)) if skip else with_stem


def read_series_by_prefix(
    spark: SparkSession, path: str, schema: T.StructType, ids: DataFrame, width: int = 9
) -> DataFrame:
    """Rows of the files whose name starts with a zero-padded id of ``ids`` (column ``id``)."""
    rows = read_series_dir(spark, path, schema, skip=())
    wanted = ids.select("id", F.lpad(F.col("id").cast("string"), width, "0").alias("prefix")).distinct()
    return rows.withColumn("prefix", F.substring("stem", 1, width)).join(wanted, "prefix").drop("prefix")


def read_results(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """An earlier score, importance or cluster-map table."""
    return read_csv(spark, path, schema)
