"""Canonical names, codes, units and keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace that trimming removes, not the blank alone.
WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Surrogate key text for NULL and the separator.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"

# The canonical metric names.
METRIC_NAMES = (
    "demand",
    "day_ahead_demand_forecast",
    "net_generation",
    "total_interchange",
    "generation",
)

# The labels that the source gives its other metrics.
USUAL_LABELS = ("Day-ahead demand forecast", "Net generation", "Total interchange")

# The published fuel codes.
FUEL_CODES = (
    "BAT", "BIO", "COL", "GEO", "HPS", "HYC", "NG", "NUC", "OES", "OIL",
    "OTH", "PS", "SNB", "SUN", "UES", "UNK", "WAT", "WNB", "WND",
)


def trimmed(text: Column) -> Column:
    return F.trim(text, F.lit(WHITESPACE))


def _snake(label: Column) -> Column:
    return F.lower(F.regexp_replace(label, "[^a-zA-Z0-9]+", "_"))


def snake_label(label: Column) -> Column:
    """Lower case with underscores between the runs of letters and digits.

    The replacement costs some ten times the rest of a staged row. For the usual labels it
    folds into a constant when the query is planned; only others pay for it.
    """
    usual = F.when(label == USUAL_LABELS[0], _snake(F.lit(USUAL_LABELS[0])))
    for text in USUAL_LABELS[1:]:
        usual = usual.when(label == text, _snake(F.lit(text)))
    return usual.otherwise(_snake(label))


def metric_name(fueltype: Column, type_: Column, type_name: Column) -> Column:
    """Any fuel type, even a blank one, means generation; then demand; then the label."""
    return (
        F.when(fueltype.isNotNull(), F.lit("generation"))
        .when((F.lower(type_name) == "demand") | (F.lower(type_) == "d"), F.lit("demand"))
        .otherwise(snake_label(type_name))
    )


def energy_source(fueltype: Column) -> Column:
    return F.nullif(F.upper(trimmed(fueltype)), F.lit(""))


def unit_label(unit: Column) -> Column:
    return F.lower(trimmed(unit))


def timestamp_text(moment: Column) -> Column:
    """UTC text with zero, three or six fraction digits and a ``+00`` zone."""
    micros = F.unix_micros(moment)
    layout = (
        F.when(micros % 1_000_000 == 0, F.date_format(moment, "yyyy-MM-dd HH:mm:ss"))
        .when(micros % 1_000 == 0, F.date_format(moment, "yyyy-MM-dd HH:mm:ss.SSS"))
        .otherwise(F.date_format(moment, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    )
    return F.concat(layout, F.lit("+00"))


def surrogate_key(*texts: Column) -> Column:
    """NULL-safe md5 over the key texts, so it is never NULL itself."""
    parts = [F.coalesce(text, F.lit(NULL_TOKEN)) for text in texts]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))
