"""Partitioned reads and batched appends over JDBC."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lectern.operators.upsert import rows_to_insert
from lectern.specs import TABLES

INSERT_PAGE = 1000


def read_options(
    url: str, table: str, partition_column: str | None = None,
    bounds: tuple | None = None, num_partitions: int = 1, fetch_size: int = 10_000, **connection,
) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **connection}
    if partition_column and bounds and bounds[0] is not None:
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(num_partitions),
        }
    return options


def key_bounds(
    spark: SparkSession, url: str, table: str, column: str, **connection
) -> tuple:
    """Smallest and largest key, computed by the database."""
    row = (
        spark.read.format("jdbc")
        .options(url=url, query=f"SELECT min({column}) AS lo, max({column}) AS hi FROM {table}",
                 **connection)
        .load().first()
    )
    return row[0], row[1]


def read_table(
    spark: SparkSession, url: str, table: str, partition_column: str | None = None,
    bounds: tuple | None = None, num_partitions: int = 1, **connection,
) -> DataFrame:
    """A database table read by ``num_partitions`` tasks over ranges of a numeric or time
    column.  Filters and column choices made on the result are sent to the database."""
    if partition_column and bounds is None:
        bounds = key_bounds(spark, url, table, partition_column, **connection)
    options = read_options(url, table, partition_column, bounds, num_partitions, **connection)
    return spark.read.format("jdbc").options(**options).load()


def range_query(table: str, column: str, parts: int) -> str:
    """SQL for the first value of each of ``parts`` equally filled ranges of a column."""
    tiles = f"SELECT {column} AS v, NTILE({parts}) OVER (ORDER BY {column}) AS t FROM {table}"
    return f"SELECT min(v) AS first FROM ({tiles}) tiles GROUP BY t ORDER BY 1"


def literal(value) -> str:
    return str(value) if isinstance(value, (int, float)) else "'" + str(value).replace("'", "''") + "'"


def range_predicates(column: str, firsts: list) -> list[str]:
    """One condition for each range that begins at one of the given values; together they
    hold for every row, also where the column is NULL."""
    starts = sorted(set(firsts))[1:]
    if not starts:
        return ["1 = 1"]
    between = [f"{column} >= {literal(a)} AND {column} < {literal(b)}"
               for a, b in zip(starts, starts[1:])]
    return [f"{column} < {literal(starts[0])} OR {column} IS NULL", *between,
            f"{column} >= {literal(starts[-1])}"]


def read_by_ranges(
    spark: SparkSession, url: str, table: str, column: str, parts: int, **connection
) -> DataFrame:
    """A table read by ``parts`` tasks of equally many rows, whatever the type and the gaps
    of the column; the database computes the ranges, the driver sees one value for each."""
    firsts = spark.read.format("jdbc").options(
        url=url, query=range_query(table, column, parts), **connection).load().collect()
    return spark.read.jdbc(
        url, table, predicates=range_predicates(column, [r[0] for r in firsts]),
        properties=connection)


def append_table(df: DataFrame, url: str, table: str, **connection) -> None:
    (
        df.write.format("jdbc").mode("append")
        .options(url=url, dbtable=table, batchsize=str(INSERT_PAGE), **connection)
        .save()
    )


def move_statement(table: str, stage: str, columns: list[str], key: list[str]) -> str:
    """SQL that moves staged rows whose keys the table lacks, whoever else inserts."""
    names = ", ".join(columns)
    return (f"INSERT INTO {table} ({names}) SELECT {names} FROM {stage} "
            f"ON CONFLICT ({', '.join(key)}) DO NOTHING")


def execute(spark: SparkSession, url: str, statement: str, **connection) -> None:
    """One statement, run by the driver's connection."""
    properties = spark._jvm.java.util.Properties()
    for name, value in connection.items():
        properties.setProperty(name, str(value))
    session = spark._jvm.java.sql.DriverManager.getConnection(url, properties)
    try:
        session.createStatement().execute(statement)
    finally:
        session.close()


def insert_ignore(
    batch: DataFrame, url: str, table: str, key: list[str], arrival: list[str],
    now: Column | None = None, **connection,
) -> None:
    """Insert the rows whose keys the database table lacks; rival inserts do no harm.

    Keys within the batch's range are looked up, which is all the database has to send; the
    remaining rows are staged in a table of their own and moved by one statement that passes
    over keys that have appeared since.
    """
    spark = batch.sparkSession
    low, high = batch.agg(F.min(key[0]), F.max(key[0])).first()
    if low is None:
        return
    held = read_table(spark, url, table, **connection).where(F.col(key[0]).between(low, high))
    new = rows_to_insert(held, batch, key, arrival, now)
    stage = f"{table}_stage_{uuid.uuid4().hex[:12]}"
    append_table(new, url, stage, **connection)
    try:
        execute(spark, url, move_statement(table, stage, new.columns, key), **connection)
    finally:
        execute(spark, url, f"DROP TABLE {stage}", **connection)


class JdbcSource(Mapping):
    """The declared tables of a database, each read by equally filled ranges of its first
    key column."""

    def __init__(
        self, spark: SparkSession, url: str, num_partitions: int = 64, **connection,
    ):
        self.spark, self.url, self.num_partitions = spark, url, num_partitions
        self.connection = connection

    def __iter__(self) -> Iterator[str]:
        return iter(TABLES)

    def __len__(self) -> int:
        return len(TABLES)

    def __getitem__(self, name: str) -> DataFrame:
        return read_by_ranges(self.spark, self.url, name, TABLES[name].key[0],
                              self.num_partitions, **self.connection)
