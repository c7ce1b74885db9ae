"""Every registered query: a callable of (spark, folder of the given tables).

Operators that write (extraction, merge, landing, serving, whole runs) write to a new
folder below the shared folder and return what they stored, read back.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lectern.operators import checks, ledger, serving, upsert
from lectern.operators.conform import cast_declared, conform
from lectern.plans import marts, marts_v1, pipelines
from lectern.plans.academic import AcademicSource, AcademicWarehouse
from lectern.session import work_path
from lectern.sources import landing, staging
from lectern.sources.snapshots import SnapshotTable
from lectern.specs import COHORT_FILES, LAND_ORDER, TABLES, WAREHOUSE_TABLES, TableSpec
from lectern.streaming.changes import live_rows, start_upserts
from lectern.streaming.land import start_landing

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries, shared with their expected results.
WINDOW = ("1996-03-01 00:00:00", "1998-02-06 00:00:00")
EARLY_WINDOW = ("1995-01-02 00:00:00", "1997-01-01 00:00:00")
SPLIT = "1999-06-30 00:00:00"
OVERLAP = "1998-01-01 00:00:00"
END = "2002-01-01 00:00:00"
NOW = datetime(2002, 1, 1, 6, 30, 0, 750000, tzinfo=timezone.utc)


def _ts(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _mart(build) -> Query:
    return lambda spark, sf_dir: build(AcademicWarehouse(spark, sf_dir))


def _with_double_rate(build) -> Query:
    """The stored pass rate is decimal(38,14); engines print decimals differently, so
    the compared column is the same ratio as a double."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rate = F.try_divide(
            F.lit(100.0) * F.col("num_students_passed"), F.col("num_students_enrolled")
        )
        return build(AcademicWarehouse(spark, sf_dir)).withColumn("pass_rate", rate)

    return query


# -- ingest ----------------------------------------------------------------------------


def extract_full(spark, sf_dir):
    base = work_path(spark, "extract")
    spec = TABLES["score_fact"]
    staging.write_raw(
        staging.extract(AcademicSource(spark, sf_dir)[spec.name], spec), base, spec.name
    )
    return staging.staging_scan(spark, base, spec)


def extract_window(spark, sf_dir):
    spec = TABLES["score_fact"]
    return conform(staging.extract(AcademicSource(spark, sf_dir)[spec.name], spec, WINDOW), spec)


ORDER_TEXT = TableSpec(
    "order_text", "source",
    (("order_id", "BIGINT"), ("placed_at", "TIMESTAMP"), ("total", "DOUBLE"),
     ("is_open", "BOOLEAN"), ("priority", "STRING")),
    ("order_id",),
)


def schema_cast(spark, sf_dir):
    status = F.col("o_orderstatus")
    texts = _read(spark, sf_dir, "orders").select(
        F.concat(F.col("o_orderkey").cast("string"), F.lit(".0")).alias("order_id"),
        F.when(status == "O", "no date")
        .when(status == "F", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .alias("placed_at"),
        F.col("o_totalprice").cast("string").alias("total"),
        F.when(status == "O", "True").when(status == "F", "False").alias("is_open"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
        .alias("priority"),
    )
    return cast_declared(texts, ORDER_TEXT)


def schema_conform(spark, sf_dir):
    return conform(AcademicSource(spark, sf_dir)["employee"], TABLES["employee"])


def csv_ingest(spark, sf_dir):
    """Customers as a student file with a byte-order mark, blanks and capitals in its
    header, missing texts and two date forms."""
    path = work_path(spark, "csv")
    odd = F.col("c_nationkey") % 2 == 1
    _read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("﻿Student ID"),
        F.col("c_name").alias("Student Name"),
        F.when(odd, "NaN").otherwise(F.col("c_mktsegment")).alias("Class Name"),
        F.when(odd, "").otherwise(F.concat(F.col("c_custkey").cast("string"), F.lit(".0")))
        .alias("National ID"),
        F.when(odd, "2001-05-17").otherwise("2001-05-17 08:30:00.000000")
        .alias("Student DOB"),
    ).write.option("header", True).csv(path)
    spec = TABLES["student"]
    return conform(landing.read_csv(spark, path, spec), spec)


def staging_scan(spark, sf_dir):
    base = work_path(spark, "staging")
    spec = TABLES["enrollment_fact"]
    staging.write_raw(
        staging.extract(AcademicSource(spark, sf_dir)[spec.name], spec), base, spec.name
    )
    return spark.table(
        staging.declare_staging(spark, base, spec, base.rsplit("/", 1)[1].replace("-", "_"))
    )


def staging_counts(spark, sf_dir):
    lake = pipelines.Lake(spark, work_path(spark, "counts"))
    source = AcademicSource(spark, sf_dir)
    pipelines.extract_to_raw(lake, source, WAREHOUSE_TABLES, EARLY_WINDOW)
    return staging.staging_counts(
        {t: staging.staging_scan(spark, lake.base, TABLES[t]) for t in WAREHOUSE_TABLES}
    )


def bulk_load(spark, sf_dir):
    path = work_path(spark, "bulkload")
    table = path.rsplit("/", 1)[1].replace("-", "_")
    source = f"{sf_dir}/customer.parquet"
    spark.catalog.createTable(
        table, path=path, source="parquet", schema=spark.read.parquet(source).schema
    )
    return staging.bulk_load(spark, source, table)


# -- merge -----------------------------------------------------------------------------


def _score_batches(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Scores up to the split, and a later batch that revises some of them."""
    scores = AcademicWarehouse(spark, sf_dir)["score_fact"]
    first = scores.where(F.col("last_modified_date") <= _ts(SPLIT))
    second = scores.where(F.col("last_modified_date") >= _ts(OVERLAP)).withColumns({
        "final_score": F.least(F.col("final_score") + 0.25, F.lit(10.0)),
        "etl_date": _ts(END),
    })
    return first, second


def merge_upsert(spark, sf_dir):
    first, second = _score_batches(spark, sf_dir)
    table = SnapshotTable(spark, work_path(spark, "merge"), TABLES["score_fact"])
    table.upsert(first)
    table.upsert(second)
    return table.read()


def merge_metrics(spark, sf_dir):
    first, second = _score_batches(spark, sf_dir)
    return upsert.merge_metrics(first, second, TABLES["score_fact"].key)


def merge_dedup(spark, sf_dir):
    return upsert.latest_per_key(
        _read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"]
    )


def insert_ignore(spark, sf_dir):
    """First order per customer: the table holds the early customers, the batch the rest."""
    columns = ["o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority"]
    arrival = ["o_orderdate", "o_orderkey"]
    orders = _read(spark, sf_dir, "orders").withColumn(
        "updated_at", F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate"))
    ).select(*columns, "updated_at")
    early = F.col("o_orderdate") < _ts(WINDOW[0])
    table = upsert.first_per_key(orders.where(early), ["o_custkey"], arrival)
    new = upsert.rows_to_insert(
        table, orders.where(~early), ["o_custkey"], arrival, F.lit(NOW).cast("timestamp")
    )
    return table.unionByName(new)


# -- checks ----------------------------------------------------------------------------


def check_primary_key(spark, sf_dir):
    return checks.primary_key_violations(
        _read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]
    )


def check_foreign_key(spark, sf_dir):
    return checks.all_foreign_keys(AcademicWarehouse(spark, sf_dir), TABLES)


def check_length(spark, sf_dir):
    source = AcademicSource(spark, sf_dir)
    return reduce(
        DataFrame.unionByName,
        [checks.length_violations(source[s.name], s) for s in TABLES.values() if s.lengths],
    )


# -- files, cohorts and windows --------------------------------------------------------


def route_files(spark, sf_dir):
    """One file name per order: table names and strangers, several extensions and cases."""
    names = F.array(*[F.lit(n) for n in [*LAND_ORDER, "other", "report", "SCORE_FACT"]])
    endings = F.array(*[F.lit(e) for e in ["csv", "CSV", "pdf", "exe"]])
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    files = _read(spark, sf_dir, "orders").select(
        F.concat(
            F.element_at(names, (key % F.lit(len(LAND_ORDER) + 3) + 1).cast("int")),
            F.lit("_"), key.cast("string"), F.lit("."),
            F.element_at(endings, (customer % 4 + 1).cast("int")),
        ).alias("file_name")
    )
    return landing.route_files(files)


def _cohort_entries(spark, sf_dir) -> DataFrame:
    """Folder listing: each customer a root, its orders the cohort folders."""
    folders = _read(spark, sf_dir, "orders").select(
        F.concat(
            F.lit("/landing/"), F.col("o_custkey").cast("string"),
            F.lit("/K"), (F.col("o_orderkey") % 12).cast("string"),
            F.when(F.col("o_orderpriority") == "1-URGENT", "_current").otherwise(""),
        ).alias("path")
    )
    return landing.cohort_entries(folders.distinct())


def current_batch(spark, sf_dir):
    return landing.current_batches(_cohort_entries(spark, sf_dir))


def batch_rotate(spark, sf_dir):
    return ledger.rotate(_cohort_entries(spark, sf_dir))


def batch_window(spark, sf_dir):
    """Run log from orders: one load per customer, urgent orders as bulk runs."""
    load = F.concat(F.lit("load_"), F.col("o_custkey").cast("string"))
    runs = _read(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderpriority") == "1-URGENT", pipelines.BULK_LOAD).otherwise(load)
        .alias("pipeline"),
        F.when(F.col("o_orderstatus") == "F", "success").otherwise("failed").alias("state"),
        F.col("o_orderdate").alias("run_at"),
    )
    loads = _read(spark, sf_dir, "customer").select(
        F.concat(F.lit("load_"), F.col("c_custkey").cast("string")).alias("pipeline")
    )
    return ledger.batch_windows(
        runs, loads, pipelines.BULK_LOAD, F.lit(NOW).cast("timestamp")
    )


def archive_raw(spark, sf_dir):
    path, bronze = work_path(spark, "csv"), work_path(spark, "bronze")
    _read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("student_id"), F.col("c_name").alias("student_name")
    ).write.option("header", True).csv(path)
    landing.archive(spark, path, "student", bronze, int(NOW.timestamp()))
    return (
        spark.read.parquet(bronze).where(F.col("line") != "student_id,student_name")
        .select("table_name", F.col("ingest_epoch").cast("bigint"), "archived_as", "line")
    )


# -- stored marts ----------------------------------------------------------------------


def mart_mirror(spark, sf_dir):
    path = work_path(spark, "mirror")
    serving.write_mirror(marts.score_distribution(AcademicWarehouse(spark, sf_dir)), path)
    return serving.read_serving(spark, path)


def serve_sorted(spark, sf_dir):
    build, order_key, grain = marts.MARTS["student_performance"]
    stored, served = work_path(spark, "mart"), work_path(spark, "served")
    serving.write_mirror(build(AcademicWarehouse(spark, sf_dir)), stored)
    serving.write_serving(serving.read_serving(spark, stored), served, order_key, grain)
    return serving.read_serving(spark, served)


# -- whole runs ------------------------------------------------------------------------


def _all_marts(spark, lake) -> DataFrame:
    """Rows of all six served marts under the name of each; absent columns are NULL."""
    served = [
        serving.read_serving(spark, lake.serving_path(name)).withColumn("mart", F.lit(name))
        for name in marts.MARTS
    ]
    rate = F.try_divide(F.lit(100.0) * F.col("num_students_passed"), F.col("num_students_enrolled"))
    served = [df.withColumn("pass_rate", rate) if "pass_rate" in df.columns else df
              for df in served]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), served)


def _all_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of several tables under the name of each; absent columns are NULL."""
    named = [df.withColumn("table_name", F.lit(name)) for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def warehouse_bulk_run(spark, sf_dir):
    lake = pipelines.Lake(spark, work_path(spark, "bulk"))
    pipelines.run_bulk(lake, AcademicSource(spark, sf_dir), NOW)
    return _all_marts(spark, lake)


def warehouse_incremental_run(spark, sf_dir):
    """Everything up to the split, then one cycle of the periodic loads for the rest."""
    lake = pipelines.Lake(spark, work_path(spark, "incremental"))
    source = AcademicSource(spark, sf_dir)
    pipelines.run_load(
        lake, pipelines.BULK_LOAD, source, WAREHOUSE_TABLES, ("1995-01-01 00:00:00", SPLIT),
        recreate=True, now=NOW, marts=False,
    )
    pipelines.run_cycle(lake, source, NOW, (SPLIT, END))
    return _all_marts(spark, lake)


def warehouse_first_cycle(spark, sf_dir):
    """The periodic loads on a new lake, without a bulk load before them."""
    lake = pipelines.Lake(spark, work_path(spark, "firstcycle"))
    pipelines.run_cycle(lake, AcademicSource(spark, sf_dir), NOW)
    return _all_marts(spark, lake)


def _landable(source: AcademicSource, name: str) -> DataFrame:
    """A derived table without the orphans and long texts it holds on purpose (see
    ``check_foreign_key``, ``check_length``), as landing refuses them."""
    df = source[name]
    if name == "student":
        return df.withColumns({
            "address_id": F.when(F.col("address_id") <= 24, F.col("address_id")),
            "gender": F.when(F.length("gender") <= 3, F.col("gender"))})
    if name == "instruction_fact":
        return df.withColumn("class_id", F.when(F.col("class_id") <= 24, F.col("class_id")))
    return df


#: Rows of one file of a table: compressed files are not split, so none may be large.
FILE_ROWS = 500_000


def _write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    rows = 0 if compression == "none" else FILE_ROWS
    # gzip at its fastest takes half the time for a quarter more bytes; a stamp that several
    # columns hold is formatted once here, by the writer for each of them
    texts = {f.name: F.date_format(f.name, "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")
             if isinstance(f.dataType, T.TimestampType) else F.col(f.name).cast("string")
             for f in df.schema.fields
             if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))}
    df.withColumns(texts).write.options(
        header=True, escape="\"", compression=compression, maxRecordsPerFile=rows,
        **{"zlib.compress.level": "BEST_SPEED"}).csv(path)


def land_bulk(spark, sf_dir):
    """All tables as CSV files; what the source tables hold afterwards."""
    lake = pipelines.Lake(spark, work_path(spark, "landbulk"))
    source = AcademicSource(spark, sf_dir)
    folder = f"{lake.base}/incoming"
    lake.together(lambda t: _write_csv(_landable(source, t), f"{folder}/{t}.csv", "gzip"),
                  LAND_ORDER)
    pipelines.land_bulk(lake, folder, NOW)
    return _all_tables(lake.source_tables())


def land_batch(spark, sf_dir):
    """Two cohorts: early seats and scores, then late ones; other files come with both."""
    lake = pipelines.Lake(spark, work_path(spark, "landbatch"))
    source = AcademicSource(spark, sf_dir)
    root = f"{lake.base}/data"
    split = ["enroll_student", "score_fact", "score_detail"]
    stamp = F.col("updated_at")
    once = [t for t in LAND_ORDER if t not in COHORT_FILES]

    def write(table: str) -> None:
        rows = _landable(source, table)
        if table in once:
            return _write_csv(rows, f"{lake.base}/first/{table}.csv", "gzip")
        early = rows.where(stamp <= _ts(SPLIT)) if table in split else rows
        late = rows.where(stamp >= _ts(SPLIT)) if table in split else rows
        _write_csv(early, f"{root}/K17_current/{table}.csv", "gzip")
        _write_csv(late, f"{root}/K18/{table}.csv", "gzip")

    lake.together(write, LAND_ORDER)
    pipelines.land_bulk(lake, f"{lake.base}/first", NOW, once)
    for _ in range(2):
        pipelines.land_batch(lake, root, NOW)
    return _all_tables(lake.source_tables())


def land_quoted_lines(spark, sf_dir):
    """Customers as students whose quoted names hold line breaks, quotes and commas."""
    lake = pipelines.Lake(spark, work_path(spark, "quoted"))
    path = f"{lake.base}/incoming/student.csv"
    _write_csv(_read(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("student_id"),
        F.concat(F.col("c_name"), F.lit('\n"x", ,'), F.col("c_mktsegment")).alias("student_name"),
    ), path)
    pipelines.land_files(lake, "student", path, NOW, multi_line=True)
    return lake.source("student").read().select("student_id", "student_name")


# -- streams ---------------------------------------------------------------------------

USER_STATE = TableSpec(
    "user_state", "source",
    (("user_id", "BIGINT"), ("ts", "TIMESTAMP"), ("event_id", "BIGINT"),
     ("event_type", "STRING"), ("value", "DOUBLE"), ("operation", "STRING")),
    ("user_id",),
)


def stream_upsert(spark, sf_dir):
    """Events as changes to one row per user; an error event deletes the user."""
    changes, work = work_path(spark, "changes"), work_path(spark, "upserts")
    _read(spark, sf_dir, "events").select(
        "user_id", "ts", "event_id", "event_type", "value",
        F.when(F.col("event_type") == "error", "delete").otherwise("upsert")
        .alias("operation"),
    ).repartitionByRange(4, "ts").write.parquet(changes)
    table = SnapshotTable(spark, f"{work}/table", USER_STATE)
    stream = (
        spark.readStream.schema(USER_STATE.schema).option("maxFilesPerTrigger", 2)
        .parquet(changes)
    )
    start_upserts(stream, table, f"{work}/checkpoint", ["ts", "event_id"]).awaitTermination()
    return live_rows(table, "operation")


def stream_land(spark, sf_dir):
    """Scores arrive one file at a time, the tables they refer to after them."""
    lake = pipelines.Lake(spark, work_path(spark, "streamland"))
    source = AcademicSource(spark, sf_dir)
    folder = f"{lake.base}/incoming"
    first = ["program", "program_semester", "course", "class", "address"]
    lake.together(lambda t: _write_csv(_landable(source, t), f"{folder}/{t}.csv"), first)
    pipelines.land_bulk(lake, folder, NOW, first)

    def watch(tables: list[str], max_files: int) -> None:
        for table in tables:
            _write_csv(_landable(source, table), f"{lake.base}/watched/{table}")
        start_landing(
            lake, f"{lake.base}/watched", f"{lake.base}/checkpoint", max_files=max_files,
            now=NOW, by_folder=True,
        ).awaitTermination()

    watch(["score_fact"], 4)
    watch(["student", "instruction_fact"], 8)
    return _all_tables({t: lake.source(t).read()
                        for t in ("student", "instruction_fact", "score_fact")})


def queries() -> dict[str, Query]:
    return {
        "student_performance": _mart(marts.student_performance),
        "course_performance": _with_double_rate(marts.course_performance),
        "lecturer_performance": _mart(marts.lecturer_performance),
        "instruction_aggregate": _mart(marts.instruction_aggregate),
        "score_distribution": _mart(marts.score_distribution),
        "student_program_completion": _mart(marts.student_program_completion),
        "student_performance_v1": _mart(marts_v1.student_performance),
        "course_performance_v1": _with_double_rate(marts_v1.course_performance),
        "lecturer_performance_v1": _mart(marts_v1.lecturer_performance),
        "instruction_aggregate_v1": _mart(marts_v1.instruction_aggregate),
        "score_histogram_v1": _mart(marts_v1.score_histogram),
        "extract_full": extract_full,
        "extract_window": extract_window,
        "schema_cast": schema_cast,
        "schema_conform": schema_conform,
        "csv_ingest": csv_ingest,
        "staging_scan": staging_scan,
        "staging_counts": staging_counts,
        "bulk_load": bulk_load,
        "merge_upsert": merge_upsert,
        "merge_metrics": merge_metrics,
        "merge_dedup": merge_dedup,
        "insert_ignore": insert_ignore,
        "check_primary_key": check_primary_key,
        "check_foreign_key": check_foreign_key,
        "check_length": check_length,
        "route_files": route_files,
        "current_batch": current_batch,
        "batch_rotate": batch_rotate,
        "batch_window": batch_window,
        "archive_raw": archive_raw,
        "mart_mirror": mart_mirror,
        "serve_sorted": serve_sorted,
        "warehouse_bulk_run": warehouse_bulk_run,
        "warehouse_incremental_run": warehouse_incremental_run,
        "warehouse_first_cycle": warehouse_first_cycle,
        "land_bulk": land_bulk,
        "land_batch": land_batch,
        "land_quoted_lines": land_quoted_lines,
        "stream_upsert": stream_upsert,
        "stream_land": stream_land,
    }
