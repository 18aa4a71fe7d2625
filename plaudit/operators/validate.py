"""Contract check of variant columns: typed values plus the first reason to reject a row."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plaudit.contracts import LIMITS
from plaudit.functions.documents import bounded, is_missing, once, typed

_TYPED = "_typed"


def add_typed(
    rows: DataFrame, values: Mapping[str, Column], contract: StructType, step: Callable[[Column], Column] = once
) -> DataFrame:
    """Convert the variants once per row; the struct of results is read by ``checked``. ``step`` is ``apart`` for many fields."""
    fields = [typed(values[f.name], f.dataType, LIMITS.get(f.name)).alias(f.name) for f in contract.fields]
    return rows.select("*", step(F.struct(*fields)).alias(_TYPED))


def checked(values: Mapping[str, Column], contract: StructType) -> tuple[dict[str, Column], list[Column]]:
    """Typed columns in contract order, and per field a column that names its fault or is null.

    The variant is looked at again only where its typed value is null.
    """
    columns, faults = {}, []
    for field in contract.fields:
        name = field.name
        result = F.col(f"{_TYPED}.{name}")
        absent = is_missing(values[name])
        bad = F.lit(f"bad_type:{name}")
        if field.nullable:
            fault = F.when(result.isNull() & ~absent, bad)
        else:
            fault = F.when(result.isNull(), F.when(absent, F.lit(f"missing_required:{name}")).otherwise(bad))
        columns[name] = result
        faults.append(fault)
    return columns, faults


def native_faults(
    contract: StructType, values: Mapping[str, Column], raw: Mapping[str, Column], broken: Mapping[str, Column]
) -> list[Column]:
    """Faults of fields that were parsed straight to their types.

    For messages written by a typed source. ``raw`` is the field's JSON text, read only where the
    parser marked the message ``broken`` and the value is null.
    """
    faults = []
    for field in contract.fields:
        name = field.name
        fault = F.when(values[name].isNull() & broken[name] & raw[name].isNotNull(), F.lit(f"bad_type:{name}"))
        within = bounded(values[name], field.dataType, LIMITS.get(name))
        if within is not values[name]:
            fault = F.when(values[name].isNotNull() & within.isNull(), F.lit(f"bad_type:{name}")).otherwise(fault)
        if not field.nullable:
            fault = F.coalesce(fault, F.when(values[name].isNull(), F.lit(f"missing_required:{name}")))
        faults.append(fault)
    return faults


def accepted(parsed: DataFrame, contract: StructType) -> DataFrame:
    return parsed.where(F.col("reason").isNull()).select(*contract.fieldNames())


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNotNull()).select("value", "reason")
