"""Row checks that set bad rows aside instead of failing a job."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flag_errors(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Add ``error``: the first check that is not true, null for a good row."""
    failed = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(reason)) for reason, ok in checks.items()]
    return df.withColumn("error", F.coalesce(*failed) if failed else F.lit(None).cast("string"))


def quarantine(df: DataFrame, checks: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)``; bad rows keep all columns and carry ``error``."""
    flagged = flag_errors(df, checks)
    good = flagged.filter(F.col("error").isNull()).drop("error")
    return good, flagged.filter(F.col("error").isNotNull())


def validate_rows(
    df: DataFrame, schema: T.StructType, defaults: Mapping[str, object] | None = None
) -> tuple[DataFrame, DataFrame]:
    """``(valid, bad)`` against ``schema``: valid rows have its types, bad ones are left as read.

    Every field is required unless ``defaults`` names it with the value it takes when absent or
    null. A value that is present must have the field's type or be readable as such. Nested fields
    are checked for presence only.
    """
    defaults = defaults or {}
    checks, columns = {}, []
    for field in schema.fields:
        name, dtype = field.name, field.dataType
        raw = F.col(name) if name in df.columns else F.lit(None)
        nested = isinstance(dtype, (T.StructType, T.ArrayType, T.MapType))
        value = raw if nested and name in df.columns else raw.try_cast(dtype)
        if name in defaults:
            checks[f"{name}: not {dtype.simpleString()}"] = raw.isNull() | value.isNotNull()
            value = F.coalesce(value, F.lit(defaults[name]).cast(dtype))
        else:
            checks[f"{name}: missing"] = raw.isNotNull()
            checks[f"{name}: not {dtype.simpleString()}"] = value.isNotNull()
        columns.append(value.alias(name))
    good, bad = quarantine(df, checks)
    return good.select(*columns), bad


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Fail if ``df`` is empty. Call it on a stored table: it reads up to one row."""
    if df.isEmpty():
        raise ValueError(f"no {what}")
    return df
