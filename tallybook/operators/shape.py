"""Typed projection and union."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in order; a missing column or failed cast gives NULL.

    Columns the schema does not name are dropped.  A column that has its type already
    is passed through, whatever its nullability, so structs are not copied.
    """
    have = {f.name: f.dataType.simpleString() for f in df.schema}

    def column(field: T.StructField) -> str:
        name, kind = f"`{field.name}`", field.dataType.simpleString()
        if field.name not in have:
            return f"CAST(NULL AS {kind}) AS {name}"
        if have[field.name] == kind:
            return name
        nested = isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType))
        return f"{'CAST' if nested else 'TRY_CAST'}({name} AS {kind}) AS {name}"

    return df.selectExpr(*[column(f) for f in schema])


def union_all(*dfs: DataFrame | None) -> DataFrame:
    """All rows of all frames, matched by name; ``None`` is skipped."""
    first, *rest = [d for d in dfs if d is not None]
    for other in rest:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
