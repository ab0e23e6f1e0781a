"""Text, time and flag expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def blank_to_null(column: str | Column) -> Column:
    """The trimmed text, or null where nothing is left."""
    text = F.trim(_col(column).cast("string"))
    return F.nullif(text, F.lit(""))


def reference_fallback(column: str | Column, fallback: str | Column) -> Column:
    """The reference value where there is one, else the fallback as it stands."""
    return F.coalesce(blank_to_null(column), _col(fallback))


def full_address(fields: Sequence[str | Column], separator: str = ", ") -> Column:
    """One address line: non-blank parts, trimmed, in the order given.

    All parts blank gives an empty string.
    """
    return F.concat_ws(separator, *[blank_to_null(f) for f in fields])


def hhmm_time(column: str | Column) -> Column:
    """Hour and minute as four digits; null or unreadable gives an empty string."""
    moment = _col(column).try_cast("timestamp")
    return F.concat_ws(
        "",
        F.lpad(F.hour(moment).cast("string"), 2, "0"),
        F.lpad(F.minute(moment).cast("string"), 2, "0"),
    )


def initial_flag(column: str | Column, letter: str) -> Column:
    """'Y' where the trimmed text starts with the letter, in any case, else ''."""
    first = F.substring(F.upper(F.trim(F.coalesce(_col(column), F.lit("")))), 1, 1)
    return F.when(first == F.lit(letter.upper()), F.lit("Y")).otherwise(F.lit(""))


def fill_blank(df: DataFrame) -> DataFrame:
    """Null strings become empty strings; other types keep their nulls."""
    return df.na.fill("")


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column
