"""Stored marts: the plain mirror and the copy sorted for serving."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.sources.snapshots import SnapshotTable


def write_mirror(df: DataFrame, path: str) -> None:
    """Store a mart as the next version; readers of the one before are not disturbed, and
    it stays in force if this write fails."""
    SnapshotTable(df.sparkSession, path).replace(df)


def serving_order(df: DataFrame, order_key: str, grain: Sequence[str]) -> DataFrame:
    """Rows globally sorted by the order key, NULLs last.

    Order keys can be coarse (a status has two values), so the mart's grain is part of
    the range key: any run of equal order keys can be split over several files.
    """
    columns = [F.col(order_key).asc_nulls_last()]
    columns += [F.col(c).asc_nulls_last() for c in grain if c != order_key]
    return df.repartitionByRange(*columns).sortWithinPartitions(*columns)


def write_serving(df: DataFrame, path: str, order_key: str, grain: Sequence[str]) -> None:
    SnapshotTable(df.sparkSession, path).replace(serving_order(df, order_key, grain))


def read_serving(spark: SparkSession, path: str) -> DataFrame:
    return SnapshotTable(spark, path).read()


def publish(spark: SparkSession, database: str, name: str, path: str, home: str) -> str:
    """Point a catalog table at a mart's newest version and compute its statistics.

    A table of the same columns is moved in place, so it never goes missing; else it is
    declared anew.  ``home`` is the folder of the database.
    """
    table, mart = f"{database}.{name}", SnapshotTable(spark, path)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{home}'")
    if spark.catalog.tableExists(table) and spark.table(table).dtypes == mart.read().dtypes:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{mart.folder()}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.catalog.createTable(table, path=mart.folder(), source="parquet")
    spark.sql(f"REFRESH TABLE {table}")
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")
    return table
