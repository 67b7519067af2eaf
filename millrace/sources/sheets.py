"""The reference sheets, delivered as tabular files. Columns are bound by position."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.normalize import cell
from millrace.schemas import DEPARTMENTS, EMPLOYEES


def bind_sheet(sheet: DataFrame, schema: T.StructType, strict: bool = True) -> DataFrame:
    """Name the columns of a sheet after the contract, whatever its header says, and type the cells.

    NaN becomes NULL. A cell that can't be read as its type fails the run, as it would the insert, or
    becomes NULL too if not ``strict``.
    """
    if len(sheet.columns) != len(schema):
        raise ValueError(f"the sheet has {len(sheet.columns)} columns, the contract {len(schema)}")
    source_types = [f.dataType for f in sheet.schema.fields]
    bound = sheet.toDF(*schema.names)
    return bound.select(
        *[cell(F.col(f.name), dtype, f.dataType, strict=strict).alias(f.name) for dtype, f in zip(source_types, schema.fields)]
    )


def read_sheet(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Read one sheet from Parquet, or from CSV with a header line.

    In CSV an empty cell is NULL and a quoted empty string stays an empty string. The header's width is
    the sheet's: it must be the contract's, and every line's.
    """
    if fmt == "csv":
        # The null marker is what the parser puts into empty cells; no cell holds it, so "" stays "".
        options = {"header": True, "mode": "FAILFAST", "multiLine": True, "escape": '"', "nullValue": "\u0001"}
        keep_spaces = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        sheet = spark.read.options(**options, **keep_spaces).csv(path)
    else:
        sheet = spark.read.format(fmt).load(path)
    return bind_sheet(sheet, schema)


def read_employees(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_sheet(spark, path, EMPLOYEES, fmt)


def read_departments(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_sheet(spark, path, DEPARTMENTS, fmt)
