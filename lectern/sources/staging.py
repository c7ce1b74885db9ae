"""Extraction into the raw zone and the staging tables read from it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.operators.conform import cast_declared
from lectern.specs import TableSpec


def extract(
    table: DataFrame, spec: TableSpec, window: tuple | None = None, legacy_nulls: bool = False
) -> DataFrame:
    """A source table, whole or limited to an ``updated_at`` window, cast to its spec.

    Both ends of the window belong to it.  It applies only when both are given, and stays
    a plain range on a bare column so that the source (Parquet or JDBC) evaluates it.
    """
    if window is not None and window[0] is not None and window[1] is not None:
        low, high = (F.lit(bound).cast("timestamp") for bound in window)
        table = table.where(F.col("updated_at").between(low, high))
    return cast_declared(table, spec, legacy_nulls)


def raw_path(base: str, table: str) -> str:
    return f"{base}/raw/{table}"


def write_raw(df: DataFrame, base: str, table: str) -> str:
    """Replace the table's raw folder with snappy Parquet files."""
    path = raw_path(base, table)
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return path


def staging_scan(spark: SparkSession, base: str, spec: TableSpec) -> DataFrame:
    """Raw files under the declared schema: absent columns read NULL, extra ones are left."""
    return spark.read.schema(spec.schema).parquet(raw_path(base, spec.name))


def declare_staging(
    spark: SparkSession, base: str, spec: TableSpec, database: str = "default"
) -> str:
    """Re-declare the external staging table and collect its statistics."""
    table = f"{database}.{spec.name}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{base}/{database}.db'")
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.catalog.createTable(
        table, path=raw_path(base, spec.name), source="parquet", schema=spec.schema
    )
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")
    return table


def staging_counts(staged: dict[str, DataFrame]) -> DataFrame:
    """Rows per staging table and whether its merge is skipped."""
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in staged.items()
    ]
    return reduce(DataFrame.unionByName, counts).withColumn("skipped", F.col("n_rows") == 0)


def bulk_load(spark: SparkSession, files: str, table: str) -> DataFrame:
    """Append Parquet files to a table by column position and return the table."""
    spark.read.parquet(files).write.insertInto(table)
    return spark.table(table)
