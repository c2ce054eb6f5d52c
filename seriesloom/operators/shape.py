"""Column selection by name and type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def feature_columns(
    df: DataFrame,
    prefixes: tuple[str, ...] = (),
    contains: tuple[str, ...] = (),
    exclude: tuple[str, ...] = (),
) -> list[str]:
    """Names that start with a prefix or contain a substring, without the excluded ones.

    With neither prefixes nor substrings every column that is not excluded counts.
    """
    everything = not prefixes and not contains
    return [
        c
        for c in df.columns
        if c not in exclude and (everything or c.startswith(prefixes) or any(s in c for s in contains))
    ]


def select_features(df: DataFrame, keep: list[str], **rules: tuple[str, ...]) -> DataFrame:
    return df.select(*keep, *[c for c in feature_columns(df, **rules) if c not in keep])


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def cast_double(df: DataFrame, columns: list[str]) -> DataFrame:
    """Named columns as double; text that is not a number becomes null."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns})


def rename_drop(df: DataFrame, rename: dict[str, str], drop: list[str], constants: dict[str, object]) -> DataFrame:
    return df.withColumnsRenamed(rename).drop(*drop).withColumns({k: F.lit(v) for k, v in constants.items()})
