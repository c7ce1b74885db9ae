"""Continuous landing of CSV files: each is parsed once; rows without their parents wait."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable
from datetime import datetime, timezone
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from lectern.operators.upsert import rows_to_insert
from lectern.plans.pipelines import (
    Lake, key_bounds, orphans, ranges_told, source_columns, waves,
)
from lectern.sources import landing
from lectern.sources.landing import ARRIVAL, PROBLEM, MalformedFileError, route_files
from lectern.specs import LAND_ORDER, TABLES

_FILES = "path string, modificationTime timestamp, length long, content binary"


def start_landing(
    lake: Lake, folder: str, checkpoint: str, max_files: int = 64,
    now: datetime | None = None, by_folder: bool = False, enforce: bool = True,
    multi_line: bool = False, **trigger,
) -> StreamingQuery:
    """Watch a folder and land its CSV files, routed by name, parents before children.

    The stream carries file names only (the content column is pruned).  Every file stands or
    falls by itself: one that cannot be routed or read, or has a row that breaks a type, a text
    limit or the primary key, is listed under ``rejected`` with the reason.  Rows that refer to
    rows their parents lack are parked in ``Lake.parked`` and land in the batch that brings
    their parents, so no file is read again.  Without ``enforce`` references and text limits
    are not asked for.  Files of no bytes are passed over by the source.  A batch that is
    repeated after a failure lands the same rows: archive and list are written per file and
    batch, the insert ignores known keys, and a row is parked once.  ``by_folder`` counts the
    name of the parent folder as part of the file name.
    """
    name = F.element_at(F.split("path", "/"), -1)
    if by_folder:
        name = F.concat_ws("_", F.element_at(F.split("path", "/"), -2), name)
    names = (
        lake.spark.readStream.format("binaryFile").schema(_FILES)
        .option("maxFilesPerTrigger", max_files).option("recursiveFileLookup", True)
        .load(folder)
        .select("path", "modificationTime", name.alias("file_name"))
    )
    restarted = [True]

    def step(batch: DataFrame, batch_id: int) -> None:
        files = route_files(batch) \
            .select("path", "table_name", "verdict", "modificationTime").collect()
        if not files:
            return
        # the archive's epoch must be the same if the batch is repeated
        at = now or max(f["modificationTime"] for f in files).replace(tzinfo=timezone.utc)
        refused = {f["path"]: f["verdict"] for f in files if f["verdict"] != "accepted"}
        by_table = defaultdict(list)
        for f in files:
            if f["verdict"] == "accepted":
                by_table[f["table_name"]].append(f["path"])
        rows = parse_files(lake, by_table, refused, multi_line, enforce)
        archived = {t: [p for p in paths if p not in refused] for t, paths in by_table.items()}
        lake.together(lambda t: landing.archive(
            lake.spark, archived[t], t, lake.bronze, int(at.timestamp())),
            [t for t, paths in archived.items() if paths])
        # parents may also have come from elsewhere since the stream last ran
        land_rows(lake, rows, at, enforce, LAND_ORDER if restarted[0] else ())
        restarted[0] = False
        if refused:
            lake.spark.createDataFrame(list(refused.items()), "path string, verdict string") \
                .coalesce(1).write.mode("overwrite") \
                .parquet(f"{lake.base}/rejected/batch={batch_id}")

    return (
        names.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def parse_files(
    lake: Lake, by_table: dict[str, list[str]], refused: dict[str, str], multi_line: bool,
    enforce: bool,
) -> dict[str, DataFrame]:
    """Rows of the acceptable files of each table; what is wrong with others in ``refused``.

    Files of one table and header are parsed together, each once, into typed Parquet, and
    judged by one pass over what that gives.
    """
    headers = landing.header_lines(lake.spark, [p for paths in by_table.values() for p in paths])
    groups = defaultdict(list)
    for table, paths in by_table.items():
        for path in paths:
            if headers[path] is None:
                refused[path] = "the file is gone"
            else:
                groups[table, headers[path]].append(path)
    parsed: dict[tuple[str, str], DataFrame] = {}

    def parse(group: tuple[str, str]) -> None:
        table, header = group
        spec, paths = TABLES[table], [p for p in groups[group] if p not in refused]
        try:
            rows = landing.read_with_problems(
                lake.spark, paths, header, spec, multi_line, enforce)
            rows = rows.select(ARRIVAL, *source_columns(rows, spec), PROBLEM)
        except (AnalysisException, MalformedFileError) as error:
            at_fault = {plain(f) for f in getattr(error, "files", ())}
            bad = [p for p in paths if plain(p) in at_fault] or paths
            refused.update(dict.fromkeys(bad, str(error).split("\n")[0]))
            if len(bad) < len(paths):
                parse(group)
            return
        path = lake.work(table)
        rows.write.parquet(path)
        stored = lake.spark.read.schema(rows.schema).parquet(path)
        file = F.col(f"{ARRIVAL}.file")
        seen = {r["file"]: r["problem"] for r in stored.groupBy(file.alias("file")).agg(
            F.min(PROBLEM).alias("problem")).collect()}
        seen = {plain(f): problem for f, problem in seen.items()}
        empty = f"{table}.csv holds no rows"
        bad = {p: seen.get(plain(p), empty) for p in paths if seen.get(plain(p), empty)}
        refused.update(bad)
        if len(bad) < len(paths):
            wrong = stored.where(F.col(PROBLEM).isNotNull()).select(file.alias("bad")).distinct()
            good = stored.join(wrong, file == F.col("bad"), "left_anti") if bad else stored
            parsed[group] = good.drop(PROBLEM)

    lake.together(parse, list(groups))
    tables = defaultdict(list)
    for (table, _), rows in sorted(parsed.items()):
        tables[table].append(rows)
    return {t: reduce(DataFrame.unionByName, rows) for t, rows in tables.items()}


def plain(path: str) -> str:
    """A path without its scheme, escaped or not."""
    return unquote(path.split(":", 1)[-1]).lstrip("/")


def land_rows(
    lake: Lake, rows: dict[str, DataFrame], now: datetime, enforce: bool,
    also: Iterable[str] = (),
) -> None:
    """Insert rows whose keys the source tables lack and whose parents are there, park others.

    A table's parked rows are tried again when a parent gains rows, and those of ``also`` in
    any case: its references and the batch's are looked up in one join.
    """
    gained: set[str] = set()

    def land(table: str) -> None:
        spec, parked = TABLES[table], lake.parked(table)
        candidates, held = rows.get(table), None
        due = table in also or gained & {fk.table for fk in spec.foreign_keys}
        if (candidates is not None or due) and spec.foreign_keys and enforce:
            held = parked.read()
            held = None if held.isEmpty() else held
        if held is not None and due:
            candidates = held if candidates is None else candidates.unionByName(held)
        if candidates is None:
            return
        seen = candidates.agg(F.count("*").alias("rows"), *key_bounds(spec)).first()
        ranges = ranges_told(spec, seen)
        ready, waiting = candidates, None
        if spec.foreign_keys and enforce:
            ready, waiting = split_orphans(lake, table, candidates, ranges)
        target = lake.source(table)
        new = rows_to_insert(
            target.read_between(*ranges[spec.key[0]]), ready, spec.key, [ARRIVAL],
            F.lit(now).cast("timestamp"), lake.work(f"{table}-met"),
            seen["rows"] if waiting is None else None)
        target.append(new, ranges[spec.key[0]])
        # rows leave the parked table only now that they have landed; those not tried stay,
        # and a repeated batch parks nothing twice
        keep = [df for df in (waiting, None if due else held) if df is not None]
        if waiting is not None:
            parked.replace(reduce(DataFrame.unionByName, keep).distinct())
        elif held is not None and due:
            parked.recreate()
        gained.add(table)

    for wave in waves(LAND_ORDER):
        lake.together(land, wave)


def split_orphans(
    lake: Lake, table: str, candidates: DataFrame, ranges: dict[str, list]
) -> tuple[DataFrame, DataFrame | None]:
    """Rows whose parents are all there, and the others (None if there are none).

    The values without a parent are found by one fold and one join; only if there are any, the
    rows meet them.
    """
    path = lake.work(f"{table}-orphans")
    orphans(lake, {table: candidates}, {table: ranges}).write.parquet(path)
    missing = lake.spark.read.schema("column_name string, value string").parquet(path)
    columns = [r["column_name"] for r in missing.select("column_name").distinct().collect()]
    if not columns:
        return candidates, None
    marked, lacks = candidates, F.lit(False)
    for i, column in enumerate(columns):
        kind = candidates.schema[column].dataType
        values = missing.where(F.col("column_name") == column).select(
            F.col("value").cast(kind).alias(column), F.lit(True).alias(f"_lacks_{i}"))
        marked = marked.join(values, column, "left")
        lacks = lacks | F.col(f"_lacks_{i}").isNotNull()
    path = lake.work(f"{table}-split")
    marked.select(*candidates.columns, lacks.alias("_lacks")).write.partitionBy("_lacks") \
        .parquet(path)
    split = lake.spark.read.schema(candidates.schema.add("_lacks", "boolean")).parquet(path)
    ready, waiting = (split.where(F.col("_lacks") == F.lit(flag)).drop("_lacks")
                      for flag in (False, True))
    return ready, waiting
