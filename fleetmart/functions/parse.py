"""Safe parsing of locale-formatted text; all built-in expressions, ANSI mode stays on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetmart.contract import COMPACT_TIME


def named(name: str) -> Column:
    """Column by its literal name, even when it holds dots, blanks or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def decimal_comma(text: Column) -> Column:
    """``"-43,123"`` -> -43.123; text that is no number becomes NULL, ``"nan"`` NaN."""
    return F.replace(text, F.lit(","), F.lit(".")).try_cast("double")


def compact_timestamp(text: Column, layout: str = COMPACT_TIME) -> Column:
    """``"20240131120000"`` -> timestamp in the session time zone; other text -> NULL."""
    return F.try_to_timestamp(text, F.lit(layout))


def clean_code(text: Column) -> Column:
    """Upper-case a code and cut the blanks around it (blanks only, as ``trim`` does)."""
    return F.trim(F.upper(text))
