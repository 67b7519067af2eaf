"""Column expressions for cleaning text, keys, statuses and sheet cells."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Canonical spellings and the variants that are mapped to them.
URGENT_VARIANT, URGENT = "عاجل جدا", "عاجل"
COMPLETED_VARIANT, COMPLETED = "مكتمل", "مكتملة"
IN_PROGRESS_VARIANT, IN_PROGRESS = "قيد المعالجه", "قيد المعالجة"
REJECTED, SAVED, ON_HOLD, REFERRED = "مرفوضة", "محفوظة", "معلقة", "محالة"
TRANSACTION_STATUSES = (COMPLETED, IN_PROGRESS, REJECTED, SAVED, ON_HOLD, REFERRED)
EMPLOYMENT_STATUSES = ("Active", "Inactive", "On Leave")
EMAIL_SHAPE = "%@%.%"


def ntz(value: datetime) -> Column:
    """A zone-less timestamp literal, frozen for the whole run."""
    if value.tzinfo is not None:
        raise ValueError(f"expected a timestamp without time zone, got {value!r}")
    return F.lit(value.isoformat(sep=" ")).cast(T.TimestampNTZType())


def day(value: date) -> Column:
    return F.lit(value.isoformat()).cast("date")


def norm(column: Column | str) -> Column:
    """Key form: no leading or trailing spaces, upper case."""
    return F.upper(F.trim(column))


def employment_status(column: Column | str) -> Column:
    """Known spellings become canonical, everything else is passed on untouched."""
    raw = F.col(column) if isinstance(column, str) else column
    spoken = F.lower(F.trim(raw))
    return (
        F.when(spoken == "active", "Active")
        .when(spoken == "inactive", "Inactive")
        .when(F.replace(spoken, F.lit("_"), F.lit(" ")) == "on leave", "On Leave")
        .otherwise(raw)
    )


def email(column: Column | str) -> Column:
    """Lower-cased address, NULL unless it looks like one."""
    raw = F.col(column) if isinstance(column, str) else column
    return F.when(raw.like(EMAIL_SHAPE), F.lower(F.trim(raw)))


def classification(column: Column | str) -> Column:
    tidy = F.trim(column)
    return F.when(tidy == URGENT_VARIANT, URGENT).otherwise(tidy)


def transaction_status(column: Column | str) -> Column:
    tidy = F.trim(column)
    return (
        F.when(tidy == COMPLETED_VARIANT, COMPLETED)
        .when(tidy == IN_PROGRESS_VARIANT, IN_PROGRESS)
        .otherwise(tidy)
    )


def cell(column: Column, source_type: T.DataType, target_type: T.DataType, strict: bool = False) -> Column:
    """A spreadsheet cell in its contract type: NaN becomes NULL, an unreadable cell too unless ``strict``, which raises."""
    if isinstance(source_type, (T.FloatType, T.DoubleType)):
        column = F.when(~F.isnan(column), column)
    if source_type == target_type:
        return column
    typed = column.try_cast(target_type)
    if strict:
        unreadable = F.raise_error(F.concat(F.lit(f"unreadable as {target_type.simpleString()}: "), column.cast("string")))
        typed = F.when(column.isNotNull() & typed.isNull(), unreadable.cast(target_type)).otherwise(typed)
    return typed
