"""Landing, loading and streaming runs."""

import datetime as dt
import json
import threading
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lectern import jobs
from lectern.operators import serving
from lectern.plans import marts, pipelines
from lectern.plans.pipelines import Lake, land_files
from lectern.sources import landing
from lectern.sources.snapshots import SnapshotTable
from lectern.specs import COHORT_FILES, TABLES, WAREHOUSE_TABLES
from lectern.plans.registry import USER_STATE
from lectern.streaming import land as streaming_land
from lectern.streaming.changes import apply_changes, live_rows, start_upserts
from lectern.streaming.land import start_landing
from tests.tables import one_course_school, only, rows

NOW = dt.datetime(2024, 3, 1, 12, 0, 0, tzinfo=dt.timezone.utc)
T0 = dt.datetime(2024, 1, 1)
T1 = dt.datetime(2024, 2, 1)


def scored(spark, value, at):
    t = one_course_school(spark, score_fact=[
        {"score_id": 1, "instruction_id": 100, "student_id": "s1", "final_score": value,
         "final_score_4": 2.0}])
    return {name: df.withColumn("updated_at", F.lit(at)) for name, df in t.items()}


def test_bulk_then_incremental(spark, lake_dir):
    lake = Lake(spark, lake_dir)
    rebuilt = pipelines.run_bulk(lake, scored(spark, 3.0, T0), T0)
    assert rebuilt == list(marts.MARTS)
    served = lambda: only(serving.read_serving(spark, lake.serving_path("student_performance")))
    assert served()["total_courses_passed"] == 0

    assert pipelines.next_window(lake, "score_facts", T1) == (T0, T1)
    rebuilt = pipelines.run_incremental(lake, "score_facts", scored(spark, 6.0, T1), T1)
    assert rebuilt == [m for m in marts.MARTS if m != "instruction_aggregate"]
    assert served()["total_courses_passed"] == 1
    assert pipelines.next_window(lake, "score_facts", NOW.replace(tzinfo=None))[0] == T1
    assert pipelines.next_window(lake, "dimensions", NOW.replace(tzinfo=None))[0] == T0

    # A window without changes leaves every table as it is.
    before = lake.warehouse("score_fact").versions()
    pipelines.run_incremental(lake, "score_facts", scored(spark, 9.0, T0), NOW,
                              window=(T1, NOW.replace(tzinfo=None)))
    assert lake.warehouse("score_fact").versions() == before


def test_bulk_drops_rows_of_earlier_loads(spark, lake_dir):
    lake = Lake(spark, lake_dir)
    pipelines.run_bulk(lake, scored(spark, 3.0, T0), T0)
    empty = {n: df.limit(0) for n, df in scored(spark, 3.0, T0).items()}
    pipelines.run_bulk(lake, empty, T1)
    assert all(df.isEmpty() for df in lake.warehouse_tables().values())


def test_failed_run_is_logged_and_opens_no_window(spark, lake_dir):
    lake = Lake(spark, lake_dir)
    pipelines.run_bulk(lake, scored(spark, 3.0, T0), T0)
    broken = dict(scored(spark, 3.0, T1))
    broken["score_fact"] = broken["score_fact"].unionByName(broken["score_fact"])
    with pytest.raises(ValueError, match="repeats key"):
        pipelines.run_incremental(lake, "score_facts", broken, T1)
    log = {(r["pipeline"], r["state"]) for r in pipelines.run_log(lake).collect()}
    assert log == {("bulk", "success"), ("score_facts", "failed")}
    assert pipelines.next_window(lake, "score_facts", T1)[0] == T0


def test_first_cycle_on_a_new_lake(spark, lake_dir):
    lake = Lake(spark, lake_dir)
    assert pipelines.next_window(lake, "dimensions", T0) == (None, T0)
    with pytest.raises(pipelines.PredecessorError, match="waits for instruction_facts"):
        pipelines.run_incremental(lake, "score_facts", scored(spark, 6.0, T0), T0)
    pipelines.run_cycle(lake, scored(spark, 6.0, T0), T0)
    served = only(serving.read_serving(spark, lake.serving_path("student_performance")))
    assert served["total_courses_passed"] == 1
    counts = {r["pipeline"]: r["counts"] for r in pipelines.run_log(lake).collect()}
    assert json.loads(counts["score_facts"])["score_fact"] == {
        "staged": 1, "inserted": 1, "updated": 0, "unchanged": 0, "total": 1}
    pipelines.run_cycle(lake, scored(spark, 3.0, T1), T1, loads=["score_facts"])
    served = only(serving.read_serving(spark, lake.serving_path("student_performance")))
    assert served["total_courses_passed"] == 0


def test_a_failed_predecessor_stops_a_load(spark, lake_dir):
    lake = Lake(spark, lake_dir)
    pipelines.run_bulk(lake, scored(spark, 3.0, T0), T0)
    pipelines.log_run(lake, "instruction_facts", "failed", T1)
    with pytest.raises(pipelines.PredecessorError):
        pipelines.run_incremental(lake, "enrollment_facts", scored(spark, 3.0, T1), T1)


def test_a_failing_mart_leaves_the_old_one(spark, lake_dir):
    path = f"{lake_dir}/m"
    serving.write_mirror(spark.range(3), path)
    reader = serving.read_serving(spark, path)
    with pytest.raises(PySparkException):
        serving.write_mirror(
            spark.range(3).select(F.raise_error(F.lit("no")).cast("long").alias("id")), path)
    assert serving.read_serving(spark, path).count() == 3
    serving.write_mirror(spark.range(5), path)
    assert (reader.count(), serving.read_serving(spark, path).count()) == (3, 5)


def test_runs_declare_marts_in_the_catalog(spark, lake_dir):
    lake = Lake(spark, lake_dir, database="aggr_runs")
    for value, at in ((3.0, T0), (6.0, T1)):
        pipelines.run_bulk(lake, scored(spark, value, at), at)
    assert only(spark.table("aggr_runs.student_performance"))["total_courses_passed"] == 1
    assert len(spark.catalog.listTables("aggr_runs")) == len(marts.MARTS)
    assert spark.table("aggr_runs_staging.score_fact").count() == 1
    for name in ("aggr_runs", "aggr_runs_staging"):
        spark.sql(f"DROP DATABASE {name} CASCADE")


def test_load_order_and_waves():
    order = pipelines.load_order()
    for load, (_, before) in pipelines.INCREMENTAL_LOADS.items():
        assert all(order.index(b) < order.index(load) for b in before)
    groups = pipelines.waves(TABLES)
    place = {t: i for i, group in enumerate(groups) for t in group}
    assert set(place) == set(TABLES)
    for spec in TABLES.values():
        assert all(place[fk.table] < place[spec.name] for fk in spec.foreign_keys)
    loaded = [t for tables, _ in pipelines.INCREMENTAL_LOADS.values() for t in tables]
    assert sorted(loaded) == sorted(WAREHOUSE_TABLES)


def write_cohort(folder, number, extra=""):
    folder.mkdir(parents=True)
    columns = {
        "course": "course_id,course_name,total_credit", "program": "program_id,class_of",
        "program_semester": "program_semester_id,program_id,semester_name",
        "program_course": "program_semester_id,course_id",
        "student": "student_id,student_name", "instruction_fact": "instruction_id,course_id",
        "instruction_lecturer": "instruction_lecturer_id,instruction_id",
        "enrollment_fact": "enrollment_id,instruction_id",
        "enroll_student": "student_id,enrollment_id", "score_fact": "score_id,final_score",
        "score_detail": "score_detail_id,score_id"}
    assert list(columns) == COHORT_FILES
    for table, header in columns.items():
        line = ",".join(str(number) for _ in header.split(","))
        (folder / f"{table}.csv").write_text(f"{header}\n{line}\n{extra}")


def test_cohorts_land_one_after_another(spark, tmp_path):
    root = tmp_path / "data"
    write_cohort(root / "K18_current", 18)
    write_cohort(root / "K19", 19)
    lake = Lake(spark, str(tmp_path / "lake"))
    base = [lake.base]
    pipelines.create_source(lake)
    (root / "raw").mkdir()
    for _ in range(2):
        pipelines.register_cohorts(lake, landing.child_folders(spark, str(root)))
    assert lake.ledger().read().count() == 2
    assert pipelines.current_cohort(lake, str(root)) == (18, f"{root}/K18_current")
    jobs.main([*base, "land-batch", str(root)], spark)
    assert pipelines.current_cohort(lake, str(root))[0] == 19
    assert pipelines.land_batch(lake, str(root), NOW) == 19
    with pytest.raises(ValueError, match="no current batch"):
        pipelines.land_batch(lake, str(root), NOW)
    scores = rows(lake.source("score_fact").read().select("score_id", "updated_at"))
    assert [r["score_id"] for r in scores] == [18, 19]
    assert None not in {r["updated_at"] for r in scores}
    assert spark.read.parquet(lake.bronze).where("table_name = 'course'").count() == 4


def test_jobs_land_and_load(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for table, spec in TABLES.items():
        values = ["1" if kind in ("BIGINT", "STRING", "DOUBLE") else
                  "True" if kind == "BOOLEAN" else "2024-01-01" for _, kind in spec.columns]
        (folder / f"{table}.csv").write_text(
            ",".join(spec.names) + "\n" + ",".join(values) + "\n")
    base = [str(tmp_path / "lake")]
    jobs.main([*base, "land-bulk", str(folder)], spark)
    jobs.main([*base, "bulk"], spark)
    jobs.main([*base, "incremental", "score_facts"], spark)
    lake = Lake(spark, str(tmp_path / "lake"))
    assert only(serving.read_serving(spark, lake.serving_path("student_performance")))["GPA"] == 1.0
    jobs.main([*base, "marts", "v1"], spark)
    older = serving.read_serving(spark, lake.serving_path("score_distribution", "v1"))
    assert only(older)["score_range"] == "0-1"
    log = [(r["pipeline"], r["state"]) for r in pipelines.run_log(lake).collect()]
    assert sorted(log) == [("bulk", "success"), ("score_facts", "success")]


def test_landing_keeps_the_first_of_repeated_rows(spark, tmp_path):
    path = tmp_path / "program.csv"
    lake = Lake(spark, str(tmp_path / "lake"))
    path.write_text("program_id,class_of\nP,first\nP,second\nQ,x\n")
    pipelines.land_files(lake, "program", str(path), NOW)
    path.write_text("program_id,class_of\nP,third\nR,y\n")
    pipelines.land_files(lake, "program", str(path), NOW)
    got = {r["program_id"]: r["class_of"] for r in lake.source("program").read().collect()}
    assert got == {"P": "first", "Q": "x", "R": "y"}
    path.write_text("program_id,class_of\n")
    with pytest.raises(landing.EmptyInputError):
        pipelines.land_files(lake, "program", str(path), NOW)


def test_places_of_rows_are_not_stored(spark, tmp_path):
    path, lake = tmp_path / "program.csv", Lake(spark, str(tmp_path / "lake"))
    path.write_text("program_id,class_of\nP,x\n")
    pipelines.land_files(lake, "program", str(path), NOW)
    parsed = spark.read.parquet(f"{lake.base}/work/*/program")
    assert landing.ARRIVAL not in parsed.columns
    assert rows(parsed.select("program_id", "class_of")) == [{"program_id": "P", "class_of": "x"}]


def test_tables_wait_for_their_parents_only(spark, tmp_path, monkeypatch):
    """Scores are still landing when students enroll, whose parents are there."""
    lake, begun, enrolled = Lake(spark, str(tmp_path / "lake")), [], threading.Event()

    def land(lake, table, *rest):
        begun.append(table)
        if table == "score_fact":
            assert enrolled.wait(20)
        if table == "enroll_student":
            enrolled.set()

    monkeypatch.setattr(pipelines, "land_files", land)
    pipelines.land_bulk(lake, "in", NOW)
    assert sorted(begun) == sorted(TABLES)
    for spec in TABLES.values():
        assert all(begun.index(fk.table) < begun.index(spec.name) for fk in spec.foreign_keys)

    def refuse(lake, table, *rest):
        begun.append(table)
        if table == "program":
            raise pipelines.ConstraintError(table)

    begun.clear()
    monkeypatch.setattr(pipelines, "land_files", refuse)
    with pytest.raises(pipelines.ConstraintError):
        pipelines.land_bulk(lake, "in", NOW)
    assert not {"program_semester", "instruction_fact", "score_detail"} & set(begun)


def test_landing_refuses_broken_constraints(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    parent, child = tmp_path / "program.csv", tmp_path / "program_semester.csv"
    parent.write_text("program_id,class_of\nP,x\n")
    pipelines.land_files(lake, "program", str(parent), NOW)
    child.write_text("program_semester_id,program_id\nP_1,P\nQ_1,Q\nR_1,\n")
    with pytest.raises(pipelines.ConstraintError, match="program_id = Q is not in program"):
        pipelines.land_files(lake, "program_semester", str(child), NOW)
    child.write_text("program_semester_id,program_id,semester_name\nP_1,P," + "x" * 21 + "\n")
    with pytest.raises(pipelines.ConstraintError, match="21 characters, 20 allowed"):
        pipelines.land_files(lake, "program_semester", str(child), NOW)
    assert lake.source("program_semester").versions() == []
    pipelines.land_files(lake, "program_semester", str(child), NOW, enforce=False)
    child.write_text("program_semester_id,program_id\nP_2,P\nR_1,\n")
    pipelines.land_files(lake, "program_semester", str(child), NOW)
    assert lake.source("program_semester").read().count() == 3


def test_landing_again_leaves_the_archive(spark, tmp_path):
    lake, path = Lake(spark, str(tmp_path / "lake")), tmp_path / "program.csv"
    path.write_text("program_id,class_of\nP,x\nQ,y\n")
    for _ in range(2):
        pipelines.land_files(lake, "program", str(path), NOW)
    assert spark.read.parquet(lake.bronze).count() == 3
    assert lake.source("program").read().count() == 2


CHANGES = "user_id long, ts timestamp, event_id long, event_type string, value double, operation string"


def change(user, day, n, operation="upsert"):
    return (user, dt.datetime(2024, 1, day), n, "view", float(n), operation)


def test_late_and_repeated_changes(spark, lake_dir):
    table = SnapshotTable(spark, lake_dir, USER_STATE)
    version = ["ts", "event_id"]
    batches = [
        [change(1, 2, 10), change(1, 3, 11), change(2, 2, 12)],
        [change(1, 1, 1), change(2, 5, 13, "delete")],   # an older change, a deletion
        [change(2, 3, 14)],                               # older than the deletion
        [change(1, 3, 11)],                               # a repeat
    ]
    for batch in batches:
        apply_changes(table, spark.createDataFrame(batch, CHANGES), version)
    assert [(r["user_id"], r["event_id"]) for r in rows(live_rows(table, "operation"))] == [
        (1, 11)]
    apply_changes(table, spark.createDataFrame([change(2, 6, 15)], CHANGES), version)
    assert len(rows(live_rows(table, "operation"))) == 2


def test_upsert_stream_resumes(spark, tmp_path):
    folder, table = tmp_path / "in", SnapshotTable(spark, str(tmp_path / "t"), USER_STATE)

    def run(batch):
        spark.createDataFrame(batch, CHANGES).coalesce(1).write.mode("append").parquet(
            str(folder))
        stream = spark.readStream.schema(USER_STATE.schema).parquet(str(folder))
        start_upserts(stream, table, str(tmp_path / "cp"), ["ts", "event_id"]).awaitTermination()

    run([change(1, 1, 1), change(2, 1, 2)])
    versions = table.versions()
    run([change(1, 2, 3)])
    assert len(table.versions()) == len(versions) + 1
    assert [(r["user_id"], r["event_id"]) for r in rows(live_rows(table, "operation"))] == [
        (1, 3), (2, 2)]


def test_landing_stream_takes_each_file_once(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    lake = Lake(spark, str(tmp_path / "lake"))

    def run():
        start_landing(lake, str(folder), str(tmp_path / "cp"), now=NOW).awaitTermination()

    (folder / "program_semester_1.csv").write_text("program_semester_id,program_id\nP_1,P\n")
    (folder / "PROGRAM_1.csv").write_text("program_id,class_of\nP,x\n")
    (folder / "notes.csv").write_text("a\n1\n")
    (folder / "student.pdf").write_text("%PDF")
    run()
    (folder / "program_2.csv").write_text("program_id,class_of\nP,y\nQ,z\n")
    run()
    got = {r["program_id"]: r["class_of"] for r in lake.source("program").read().collect()}
    assert got == {"P": "x", "Q": "z"}
    assert only(lake.source("program_semester").read())["program_id"] == "P"
    verdicts = {r["verdict"] for r in spark.read.parquet(f"{lake.base}/rejected").collect()}
    assert verdicts == {"no table", "not csv"}
    assert spark.read.parquet(lake.bronze).where("table_name = 'program'").count() == 5


def test_children_wait_for_their_parents(spark, tmp_path):
    """One file a batch, the child first."""
    folder, lake = tmp_path / "in", Lake(spark, str(tmp_path / "lake"))
    folder.mkdir()

    def run():
        start_landing(lake, str(folder), str(tmp_path / "cp"), max_files=1,
                      now=NOW).awaitTermination()

    (folder / "program_semester_1.csv").write_text("program_semester_id,program_id\nP_1,P\n")
    run()
    waiting = lake.parked("program_semester")
    assert only(waiting.read())["program_id"] == "P"
    (folder / "program_1.csv").write_text("program_id,class_of\nP,x\n")
    run()
    assert only(lake.source("program_semester").read())["program_id"] == "P"
    assert waiting.read().isEmpty()


def test_each_file_is_parsed_once_however_long_its_rows_wait(spark, tmp_path, monkeypatch):
    """Rows without parents land with the batch that brings them, whatever came between."""
    folder, lake = tmp_path / "in", Lake(spark, str(tmp_path / "lake"))
    folder.mkdir()
    parsed = []
    read = landing.read_with_problems

    def counted(spark, paths, *more):
        parsed.extend(p.rsplit("/", 1)[1] for p in paths)
        return read(spark, paths, *more)

    monkeypatch.setattr(landing, "read_with_problems", counted)

    def run(name, text):
        (folder / name).write_text(text)
        start_landing(lake, str(folder), str(tmp_path / "cp"), max_files=1,
                      now=NOW).awaitTermination()

    def landed():
        return {r[0] for r in lake.source("program_semester").read()
                .select("program_semester_id").collect()}

    def parked():
        return {r[0] for r in lake.parked("program_semester").read()
                .select("program_semester_id").collect()}

    header = "program_semester_id,program_id\n"
    run("program_semester_1.csv", header + "P_1,P\nQ_1,Q\nN_1,\n")
    assert (landed(), parked()) == ({"N_1"}, {"P_1", "Q_1"})
    run("program_semester_2.csv", header + "P_2,P\nR_1,R\n")
    assert (landed(), parked()) == ({"N_1"}, {"P_1", "Q_1", "P_2", "R_1"})
    run("program_1.csv", "program_id,class_of\nP,x\n")
    assert (landed(), parked()) == ({"N_1", "P_1", "P_2"}, {"Q_1", "R_1"})
    run("class_1.csv", "class_id,class_name\n1,x\n")
    run("program_2.csv", "program_id,class_of\nR,x\nQ,y\n")
    assert (landed(), parked()) == ({"N_1", "P_1", "P_2", "Q_1", "R_1"}, set())
    assert len(parsed) == len(set(parsed)) == 5
    assert not Path(f"{lake.base}/rejected").exists()


def test_parked_rows_land_when_a_bulk_load_brings_their_parents(spark, tmp_path):
    folder, lake = tmp_path / "in", Lake(spark, str(tmp_path / "lake"))
    folder.mkdir()

    def run():
        start_landing(lake, str(folder), str(tmp_path / "cp"), now=NOW).awaitTermination()

    (folder / "program_semester.csv").write_text("program_semester_id,program_id\nP_1,P\n")
    run()
    (tmp_path / "program.csv").write_text("program_id,class_of\nP,x\n")
    land_files(lake, "program", str(tmp_path / "program.csv"), NOW)
    (folder / "class.csv").write_text("class_id,class_name\n1,x\n")
    run()
    assert only(lake.source("program_semester").read())["program_id"] == "P"
    assert lake.parked("program_semester").read().isEmpty()


def test_a_repeated_batch_lands_and_parks_nothing_twice(spark, tmp_path, monkeypatch):
    folder, lake = tmp_path / "in", Lake(spark, str(tmp_path / "lake"))
    folder.mkdir()
    (folder / "program.csv").write_text("program_id,class_of\nP,x\n")
    (folder / "program_semester.csv").write_text(
        "program_semester_id,program_id\nP_1,P\nQ_1,Q\nQ_1,Q\n")
    real = streaming_land.land_rows

    def fails_late(*given):
        real(*given)
        raise OSError("storage is gone")

    monkeypatch.setattr(streaming_land, "land_rows", fails_late)
    with pytest.raises(Exception, match="storage is gone"):
        start_landing(lake, str(folder), str(tmp_path / "cp"), now=NOW).awaitTermination()
    monkeypatch.undo()
    start_landing(lake, str(folder), str(tmp_path / "cp"), now=NOW).awaitTermination()
    assert lake.source("program").read().count() == 1
    assert only(lake.source("program_semester").read())["program_semester_id"] == "P_1"
    assert lake.parked("program_semester").read().count() == 2


def test_a_bad_file_falls_alone(spark, tmp_path):
    folder, lake = tmp_path / "in", Lake(spark, str(tmp_path / "lake"))
    folder.mkdir()
    files = {"program_1.csv": "program_id,class_of\nP,x\n", "program_2.csv": "program_id,class_of\n",
             "program_3.csv": "class_of,program_id\ny,Q\n",
             "program_4.csv": "program_id,class_of\nR,z,EXTRA\n",
             "program_5.csv": "program_id,class_of\nlong id here,x\n",
             "course_1.csv": "course_id,course_name\nnot a number,x\n",
             "course_2.csv": "course_id,course_name\n7,seven\n"}
    for name, text in files.items():
        (folder / name).write_text(text)
    start_landing(lake, str(folder), str(tmp_path / "cp"), now=NOW).awaitTermination()
    assert {r["program_id"] for r in lake.source("program").read().collect()} == {"P", "Q"}
    assert only(lake.source("course").read())["course_id"] == 7
    rejected = {r["path"].rsplit("/", 1)[1]: r["verdict"]
                for r in spark.read.parquet(f"{lake.base}/rejected").collect()}
    assert set(rejected) == {"program_2.csv", "program_4.csv", "program_5.csv", "course_1.csv"}
    assert "no rows" in rejected["program_2.csv"] and "10 allowed" in rejected["program_5.csv"]


def test_an_open_quote_refuses_its_file_only(spark, tmp_path):
    folder, lake = tmp_path / "in", Lake(spark, str(tmp_path / "lake"))
    folder.mkdir()
    header = "program_id,class_of\n"
    (folder / "program_1.csv").write_text(header + 'P,"a\nb"\n')
    (folder / "program_2.csv").write_text(header + 'Q,"a\n')
    start_landing(lake, str(folder), str(tmp_path / "cp"), now=NOW,
                  multi_line=True).awaitTermination()
    assert only(lake.source("program").read())["class_of"] == "a\nb"
    (rejected,) = spark.read.parquet(f"{lake.base}/rejected").collect()
    assert rejected["path"].endswith("program_2.csv") and "not closed" in rejected["verdict"]


def test_trouble_that_is_no_files_fault_ends_the_batch(spark, tmp_path, monkeypatch):
    folder, lake = tmp_path / "in", Lake(spark, str(tmp_path / "lake"))
    folder.mkdir()
    (folder / "program.csv").write_text("program_id,class_of\nP,x\n")

    def lost(*_):
        raise OSError("storage is gone")

    monkeypatch.setattr("lectern.streaming.land.land_rows", lost)
    with pytest.raises(Exception, match="storage is gone"):
        start_landing(lake, str(folder), str(tmp_path / "cp"), now=NOW).awaitTermination()
    monkeypatch.undo()
    start_landing(lake, str(folder), str(tmp_path / "cp"), now=NOW).awaitTermination()
    assert lake.source("program").read().count() == 1


def test_mirror_equals_mart(spark, tmp_path):
    t = one_course_school(spark)
    mart = marts.instruction_aggregate(t)
    serving.write_mirror(mart, str(tmp_path / "m"))
    assert rows(serving.read_serving(spark, str(tmp_path / "m"))) == rows(mart)
