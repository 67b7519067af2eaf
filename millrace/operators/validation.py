"""Reconciliation of a batch: counts, gates in order, next watermark."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.schemas import duplicate_keys, orphan_keys

COUNTS = (
    "raw_count",
    "clean_count",
    "rejected_count",
    "loaded_count",
    "fact_count",
    "duplicate_count",
    "employee_count",
    "department_count",
)


class ValidationError(Exception):
    """A gate failed; nothing may be published."""


def loaded_rows(clean: DataFrame, fact: DataFrame) -> DataFrame:
    """Clean rows that arrived in the fact; an inner join, so that any fan-out shows in the count."""
    return clean.select("transaction_id").join(fact.select("transaction_id"), "transaction_id")


def tally(parts: Mapping[str, DataFrame]) -> DataFrame:
    """One row with the row count of every part, counted in a single job."""
    labelled = [df.select(F.lit(name).alias("part")) for name, df in parts.items()]
    rows = labelled[0]
    for part in labelled[1:]:
        rows = rows.unionByName(part)
    return rows.agg(*[F.count_if(F.col("part") == name).alias(name) for name in parts])


def batch_counts(
    raw: DataFrame,
    clean: DataFrame,
    rejected: DataFrame,
    fact: DataFrame,
    dim_employee: DataFrame,
    dim_department: DataFrame,
) -> DataFrame:
    """The eight counts of the final validation as one row.

    Given only the part of the fact a batch may have touched, ``fact_count`` and
    ``duplicate_count`` cover that part.
    """
    return tally(
        {
            "raw_count": raw,
            "clean_count": clean,
            "rejected_count": rejected,
            "loaded_count": loaded_rows(clean, fact),
            "fact_count": fact,
            "duplicate_count": duplicate_keys(fact, "transaction_id"),
            "employee_count": dim_employee,
            "department_count": dim_department,
        }
    )


def gates(counts: DataFrame) -> DataFrame:
    """(gate_order, gate, failed) for a row of counts."""
    failed = {
        "DIM_EMPLOYEE_IS_EMPTY": F.col("employee_count") == 0,
        "DIM_DEPARTMENT_IS_EMPTY": F.col("department_count") == 0,
        "DUPLICATE_TRANSACTIONS_FOUND": F.col("duplicate_count") > 0,
        "BATCH_COUNT_MISMATCH": F.col("clean_count") != F.col("loaded_count"),
        "BATCH_ACCOUNTING_ERROR": F.col("raw_count") != F.col("clean_count") + F.col("rejected_count"),
    }
    rows = [
        F.struct(F.lit(i).alias("gate_order"), F.lit(gate).alias("gate"), rule.alias("failed"))
        for i, (gate, rule) in enumerate(failed.items(), 1)
    ]
    return counts.select(F.inline(F.array(*rows)))


def require_valid(counts: Mapping[str, int]) -> None:
    """Raise the first failing gate, in their fixed order."""
    c = counts
    if c["employee_count"] == 0:
        raise ValidationError("DIM_EMPLOYEE_IS_EMPTY")
    if c["department_count"] == 0:
        raise ValidationError("DIM_DEPARTMENT_IS_EMPTY")
    if c["duplicate_count"] > 0:
        raise ValidationError(f"DUPLICATE_TRANSACTIONS_FOUND: {c['duplicate_count']}")
    if c["clean_count"] != c["loaded_count"]:
        raise ValidationError(f"BATCH_COUNT_MISMATCH: clean={c['clean_count']}, loaded={c['loaded_count']}")
    if c["raw_count"] != c["clean_count"] + c["rejected_count"]:
        raise ValidationError(
            f"BATCH_ACCOUNTING_ERROR: raw={c['raw_count']}, clean={c['clean_count']}, rejected={c['rejected_count']}"
        )


def next_watermark(raw: DataFrame) -> DataFrame:
    """The greatest update time of the whole batch, rejected rows included; NULL if it is empty."""
    return raw.agg(F.max("last_updated_at").alias("next_watermark"))


def orphan_counts(fact: DataFrame, dim_employee: DataFrame, dim_department: DataFrame) -> DataFrame:
    """Distinct keys that break each of the three foreign keys, as one row."""
    return tally(
        {
            "employee_without_department": orphan_keys(
                dim_employee, "department_key", dim_department, "department_key"
            ),
            "fact_without_employee": orphan_keys(fact, "employee_key", dim_employee, "employee_key"),
            "fact_without_department": orphan_keys(fact, "department_key", dim_department, "department_key"),
        }
    )
