"""Projections: reshape, flatten, conform and union."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def unpivot(
    wide: DataFrame,
    ids: Sequence[str],
    name: str,
    value: str,
    dtype: T.DataType,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """One row per value column. Unparsable values become null and are kept."""
    chosen = list(columns) if columns else [c for c in wide.columns if c not in set(ids)]
    quoted = [_quote(c) for c in chosen]
    typed = wide.select(
        *[F.col(_quote(c)) for c in ids],
        *[F.col(q).try_cast(dtype).alias(c) for q, c in zip(quoted, chosen)],
    )
    return typed.unpivot([_quote(c) for c in ids], quoted, name, value)


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def flatten(df: DataFrame, mapping: Mapping[str, str | Column]) -> DataFrame:
    """Project nested paths or expressions to flat columns, in mapping order."""
    return df.select(
        *[(F.col(e) if isinstance(e, str) else e).alias(name) for name, e in mapping.items()]
    )


def conform(
    df: DataFrame, schema: T.StructType, mapping: Mapping[str, str | Column] | None = None
) -> DataFrame:
    """Cast to ``schema``; a column with no source becomes a typed null."""
    mapping = mapping or {}
    present = {c.lower() for c in df.columns}
    out = []
    for field in schema.fields:
        source = mapping.get(field.name, field.name)
        if isinstance(source, Column):
            column = source.try_cast(field.dataType)
        elif source.lower() in present:
            column = F.col(_quote(source)).try_cast(field.dataType)
        else:
            column = F.lit(None).cast(field.dataType)
        out.append(column.alias(field.name))
    return df.select(*out)


def expand(df: DataFrame, struct: str, keep: Sequence[str] = ()) -> DataFrame:
    """Lift the fields of a struct to the top level."""
    return df.select(f"{struct}.*", *keep)


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; columns one side lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def stamp(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, F.current_timestamp())


def tag(df: DataFrame, value: str, name: str = "source") -> DataFrame:
    return df.withColumn(name, F.lit(value))


def calendar(df: DataFrame, day: str, parts: Sequence[str] = ("year", "month", "day")) -> DataFrame:
    """Add calendar columns derived from a date or timestamp."""
    known = {
        "year": F.year, "month": F.month, "day": F.dayofmonth, "hour": F.hour,
        "day_of_week": F.dayofweek, "week_of_year": F.weekofyear,
    }
    return df.withColumns({p: known[p](day) for p in parts})


def numeric_columns(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    """Model inputs: float and integer columns that are not excluded."""
    kinds = (T.DoubleType, T.FloatType, T.LongType, T.IntegerType)
    return [
        f.name for f in df.schema.fields if isinstance(f.dataType, kinds) and f.name not in exclude
    ]
