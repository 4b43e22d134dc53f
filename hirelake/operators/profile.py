"""Whole-table column profile (a scan, not a peek at the first rows)."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DateType, TimestampNTZType, TimestampType


def _as_text(c, dtype):
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    if isinstance(dtype, DateType):
        return F.date_format(c, "yyyy-MM-dd")
    if isinstance(dtype, ArrayType):
        return F.to_json(c)
    return c.cast("string")


def column_profile(df: DataFrame) -> DataFrame:
    """(position, column_name, non_null, nulls, min_value, max_value) per column.

    One aggregation pass computes every column's figures (partial aggregates
    per task, one tiny final merge); the wide row is then unpivoted.
    """
    aggs, structs = [], []
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        comparable = not isinstance(f.dataType, ArrayType)
        aggs += [F.count(c).alias(f"nn{i}"), F.count_if(c.isNull()).alias(f"nl{i}"),
                 (F.min(c) if comparable else F.min(F.to_json(c))).alias(f"mn{i}"),
                 (F.max(c) if comparable else F.max(F.to_json(c))).alias(f"mx{i}")]
        dtype = f.dataType if comparable else None
        mn = _as_text(F.col(f"mn{i}"), dtype) if dtype is not None else F.col(f"mn{i}")
        mx = _as_text(F.col(f"mx{i}"), dtype) if dtype is not None else F.col(f"mx{i}")
        structs.append(F.struct(F.lit(i + 1).alias("position"), F.lit(f.name).alias("column_name"),
                                F.col(f"nn{i}").cast("long").alias("non_null"),
                                F.col(f"nl{i}").cast("long").alias("nulls"),
                                mn.alias("min_value"), mx.alias("max_value")))
    wide = df.agg(*aggs)
    return wide.select(F.explode(F.array(*structs)).alias("p")).select("p.*")
