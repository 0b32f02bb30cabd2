"""Projection and column manipulation.

Schema-only operators run no job; profile-style ones compute every column
in a single ``agg`` (one scan) and unpivot the one-row result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


def drop_columns(df: DataFrame, cols, strict: bool = False) -> DataFrame:
    """Drop named columns; ``strict`` raises on unknown names
    (``df.drop`` alone ignores them, like pandas ``errors='ignore'``)."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    if strict:
        missing = [c for c in cols if c not in df.columns]
        if missing:
            raise KeyError(f"columns not found: {missing}")
    return df.drop(*cols)


def select_features(df: DataFrame, include=None, exclude=None, keep=()) -> DataFrame:
    """Ordered feature list, or all columns except ``exclude``; ``keep``
    (key, label) are always carried along in front."""
    keep = [keep] if isinstance(keep, str) else list(keep)
    if include is not None:
        feats = [c for c in include if c not in keep]
    else:
        ex = set(exclude or [])
        feats = [c for c in df.columns if c not in ex and c not in keep]
    return df.select(*keep, *feats)


def columns_of_type(df: DataFrame, kind: str) -> list[str]:
    """Column names by kind: 'numeric' | 'string' | 'boolean'."""
    out = []
    for f in df.schema.fields:
        dt = f.dataType
        if kind == "numeric" and isinstance(dt, NUMERIC_TYPES):
            out.append(f.name)
        elif kind == "string" and isinstance(dt, T.StringType):
            out.append(f.name)
        elif kind == "boolean" and isinstance(dt, T.BooleanType):
            out.append(f.name)
    return out


def drop_rows_null(df: DataFrame, cols) -> DataFrame:
    """Keep rows where every listed column is non-null."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    return df.na.drop(how="any", subset=cols)


def drop_keys(df: DataFrame, key: str, values) -> DataFrame:
    """P5: remove rows by key. A literal list becomes an IN filter (pushed
    to the scan); a DataFrame of keys becomes a left-anti join."""
    if isinstance(values, DataFrame):
        return df.join(values.select(F.col(values.columns[0]).alias(key)).distinct(),
                       on=key, how="left_anti")
    return df.where(~F.col(key).isin(list(values)))


def head(df: DataFrame, n: int, order) -> DataFrame:
    """First ``n`` rows in an explicit order (TakeOrderedAndProject)."""
    order = [order] if isinstance(order, str) else list(order)
    return df.orderBy(*order).limit(n)


def table_info(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, non-null count, rows.
    One aggregate over the table, then unpivot of the single result row."""
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("_rows")] + [
        F.count(F.col(f"`{f.name}`")).alias(f"_nn{i}") for i, f in enumerate(fields)]
    row = df.agg(*aggs)
    stacked = F.explode(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"),
                 F.lit(f.dataType.simpleString()).alias("dtype"),
                 F.col(f"_nn{i}").alias("non_null")) for i, f in enumerate(fields)]))
    return row.select(F.col("_rows").alias("rows"), stacked.alias("_s")).select(
        "_s.position", "_s.column", "_s.dtype", "_s.non_null", "rows")


def cast_columns(df: DataFrame, spec: dict, on_error: str = "raise") -> DataFrame:
    """Cast columns. ``on_error='raise'`` uses ANSI ``cast``;
    ``'null'`` uses ``try_cast``; ``'ignore'`` keeps a column's original type
    when any non-null value would not convert (one small aggregate decides,
    for every column at once)."""
    if on_error == "raise":
        return df.withColumns({c: F.col(c).cast(t) for c, t in spec.items()})
    tried = {c: F.col(c).try_cast(t) for c, t in spec.items()}
    if on_error == "null":
        return df.withColumns(tried)
    bad = df.agg(*[F.count_if(F.col(c).isNotNull() & tried[c].isNull()).alias(c) for c in spec]).first()
    ok = {c: tried[c] for c in spec if bad[c] == 0}
    return df.withColumns(ok) if ok else df


def flatten_params(df: DataFrame, col: str, prefix: str = "", keys=None, drop: bool = True) -> DataFrame:
    """P10: map (or struct) column -> one column per key, with a prefix.
    Keys not given are read from the data (distinct map keys: a small set of
    parameter names)."""
    dt = df.schema[col].dataType
    if isinstance(dt, T.StructType):
        keys = keys or [f.name for f in dt.fields]
        cols = {f"{prefix}{k}": F.col(col).getField(k) for k in keys}
    else:
        if keys is None:
            keys = sorted(r[0] for r in df.select(F.explode(F.map_keys(col))).distinct().collect())
        cols = {f"{prefix}{k}": F.col(col).getItem(k) for k in keys}
    out = df.withColumns(cols)
    return out.drop(col) if drop else out
