"""Bring a raw table to its declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lectern.functions.casting import cast_column, clean_name, missing_to_null
from lectern.specs import SPARK_TYPES, TableSpec


def clean_columns(df: DataFrame) -> DataFrame:
    """Normalised column names; texts and numbers that mean "missing" become NULL."""
    named = df.toDF(*[clean_name(c) for c in df.columns])
    return named.select(
        *[missing_to_null(f.name, f.dataType).alias(f.name) for f in named.schema.fields]
    )


def cast_declared(df: DataFrame, spec: TableSpec, legacy_nulls: bool = False) -> DataFrame:
    """Cast the declared columns that are present; undeclared columns stay as they are."""
    types = dict(spec.columns)
    return df.select(
        *[
            cast_column(f.name, types[f.name], f.dataType, legacy_nulls)
            if f.name in types else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Exactly the declared columns in order: missing ones as NULL, extra ones dropped."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(n) if n in present else F.lit(None)).cast(SPARK_TYPES[t]).alias(n)
            for n, t in spec.columns
        ]
    )
