"""Identifiers, feature names and run-log text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Indicator column names of the monthly economic table, by group.
ECONOMIC = ("PIB_CO", "ICI")
MARKET = ("ECG_DESP", "TUAV", "ISE_CO", "VTOTAL_19", "OTOTAL_19")
INDICATORS = ("ECG_DESP", "TUAV", "PIB_CO", "ISE_CO", "VTOTAL_19", "OTOTAL_19", "ICI")

# Text layout of the score block a forecast run prints.
LOG_GRAINS = ("Daily", "Weekly", "Monthly")
LOG_METRICS = {
    "R2": r"R2 \(correlation squared\): ([\d.]+)",
    "RMSE": r"RMSE: ([\d.]+)",
    "MAE": r"MAE: ([\d.]+)",
    "MAPE": r"MAPE: ([\d.]+)%",
}
LOG_START, LOG_END = "=== METRICS START ===", "=== METRICS END ==="


def pad_id(c: Column, width: int = 9) -> Column:
    """Left-pad an id with zeros; longer ids are kept whole."""
    text = c.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def strip_id(c: Column) -> Column:
    """Drop leading zeros so that ids from two sources compare equal."""
    return F.regexp_replace(c.cast("string"), "^0+", "")


def contains_any(c: Column, needles: tuple[str, ...]) -> Column:
    hit = F.lit(False)
    for needle in needles:
        hit = hit | F.contains(c, F.lit(needle))
    return hit


def _kind(c: Column, group: str, kinds: tuple[tuple[str, str], ...], rest: str) -> Column:
    out = F
    for needle, label in kinds:
        out = out.when(F.contains(c, F.lit(needle)), F.lit(f"{group} {label}"))
    return out.otherwise(F.lit(f"{group} {rest}"))


def category_fine(c: Column) -> Column:
    """Feature name -> one of twelve classes; the first matching test wins."""
    trio = (("lag", "Lag"), ("roll_mean", "Rolling Mean"), ("roll_std", "Rolling Std"))
    return (
        F.when(contains_any(c, ECONOMIC), _kind(c, "Economic Indicator", trio, "Direct"))
        .when(contains_any(c, MARKET), _kind(c, "Market Indicator", trio, "Direct"))
        .when(
            F.contains(c, F.lit("Demand")),
            _kind(c, "Demand", (("roll_std", "Rolling Std"), ("roll_mean", "Rolling Mean")), "Lag"),
        )
        .otherwise(F.lit("Time Features"))
    )


def category_coarse(c: Column) -> Column:
    """Feature name -> one of five classes."""
    pair = (("lag", "Lag"), ("roll_mean", "Rolling Mean"))
    return (
        F.when(contains_any(c, INDICATORS), _kind(c, "External Variable", pair, "Direct"))
        .when(F.contains(c, F.lit("Demand")), F.lit("Demand History"))
        .otherwise(F.lit("Time Features"))
    )


def scraped_metrics(log: Column) -> dict[str, Column]:
    """The twelve scores found in a run log; null when one is absent.

    The match may span lines, so a value that is not a number falls through to
    the next one further down.
    """
    out = {}
    for grain in LOG_GRAINS:
        for metric, tail in LOG_METRICS.items():
            hit = F.regexp_extract(log, rf"(?s){grain} Metrics:.*?{tail}", 1)
            out[f"{grain}_{metric}"] = F.when(hit != "", hit).try_cast("double")
    return out


def scraped_marked_r2(log: Column) -> dict[str, Column]:
    """R2 per grain from the lines between the start and end markers; N/A becomes null."""
    start, end = F.instr(log, LOG_START), F.instr(log, LOG_END)
    block = F.when((start > 0) & (end > 0), F.substring(log, start, F.greatest(end - start, F.lit(0))))
    return {
        f"{grain}_R2": F.regexp_extract(block, rf"{grain.upper()}_R2=([\d.]+|N/A)", 1).try_cast("double")
        for grain in LOG_GRAINS
    }
