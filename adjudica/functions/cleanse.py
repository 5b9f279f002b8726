"""Cleansing of raw text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adjudica.schema import NA_TOKENS


def _column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


_TOKEN_LIST = ", ".join(f"'{token}'" for token in NA_TOKENS)


def null_tokens(name: str) -> Column:
    """Missing-value texts become NULL, other text is kept as it is."""
    return F.expr(f"CASE WHEN trim(`{name}`) NOT IN ({_TOKEN_LIST}) THEN `{name}` END")


def clean_id(name: str) -> Column:
    return F.trim(null_tokens(name))


def lenient_date(col: Column | str) -> Column:
    """Year-month-day text, a time after it or not, as a date.

    Anything else is NULL instead of an error; the audit counts it.
    """
    text = F.trim(_column(col))
    return F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}([ T].*)?$"), text.try_cast("date"))


def lenient_int(col: Column | str) -> Column:
    return F.trim(_column(col)).try_cast("int")


def unreadable_date(name: str) -> Column:
    """There is a text, but it is no date."""
    return null_tokens(name).isNotNull() & lenient_date(name).isNull()


def _number(name: str) -> Column:
    return F.trim(null_tokens(name)).try_cast("double")


def unreadable_amount(name: str) -> Column:
    """There is a text, but it is no number."""
    return null_tokens(name).isNotNull() & _number(name).isNull()


def amount_too_large(name: str) -> Column:
    """A number that the stored type cannot hold."""
    return _number(name).isNotNull() & F.trim(F.col(name)).try_cast("decimal(12,2)").isNull()


def money_or_zero(col: Column | str) -> Column:
    """Amount with two decimals; missing gives 0.00.

    So do unreadable and too large ones, which the audit reports as errors first.
    """
    return F.coalesce(
        F.trim(_column(col)).try_cast("decimal(12,2)"), F.lit(0).cast("decimal(12,2)")
    )


def decode_flag(col: Column | str) -> Column:
    """Condition code: 1 is true, 2, missing and anything else is false."""
    return F.coalesce(F.trim(_column(col)) == "1", F.lit(False))


def decode_renal(col: Column | str) -> Column:
    return F.coalesce(F.upper(_column(col)).isin("Y", "1", "TRUE"), F.lit(False))


def decode_label(col: Column | str) -> Column:
    """Yes/No text as a flag; any other label stays NULL and shows in the audit."""
    label = F.trim(_column(col))
    return F.when(label == "Yes", F.lit(True)).when(label == "No", F.lit(False))


def length_of_stay(admission: Column | str, discharge: Column | str) -> Column:
    """Whole days between two dates, never below 0, 0 when a date is missing."""
    days = F.datediff(_column(discharge), _column(admission))
    return F.when(days > 0, days).otherwise(F.lit(0))
