"""Merge, duplicates, first-wins insert and versioned tables."""

import itertools
import random

import pytest
from pyspark.errors import SparkRuntimeException, UnsupportedOperationException
from pyspark.sql import functions as F

from lectern.operators import upsert
from lectern.sources import snapshots
from lectern.sources.snapshots import SnapshotTable, VersionConflict
from lectern.specs import TABLES, TableSpec
from tests.tables import frame, only, rows

KEY_BLOCK = 1 << 20  # keys far apart
KV = "k long, v string"
SPEC = TableSpec("kv", "source", (("k", "BIGINT"), ("v", "STRING")), ("k",))


def kv(spark, *pairs):
    return spark.createDataFrame(list(pairs), KV)


def pairs(df):
    return sorted(((r["k"], r["v"]) for r in df.collect()), key=repr)


def test_merge_replaces_and_adds(spark):
    got = upsert.merge(kv(spark, (1, "a"), (2, "b")), kv(spark, (2, "B"), (3, "c")), ["k"])
    assert pairs(got) == [(1, "a"), (2, "B"), (3, "c")]


def test_null_keys_never_match(spark):
    got = upsert.merge(kv(spark, (None, "a")), kv(spark, (None, "b")), ["k"])
    assert pairs(got) == [(None, "a"), (None, "b")]


def test_composite_key_needs_every_column(spark):
    old = frame(spark, "enroll_student", [{"student_id": "s", "enrollment_id": 1}])
    new = frame(spark, "enroll_student", [{"student_id": "s", "enrollment_id": 2},
                                          {"student_id": "t", "enrollment_id": 1}])
    key = TABLES["enroll_student"].key
    assert upsert.merge(old, new, key).count() == 3


def test_metrics(spark):
    old = kv(spark, (1, "a"), (2, "b"), (None, "x"))
    new = kv(spark, (2, "B"), (3, "c"), (None, "y"))
    assert only(upsert.merge_metrics(old, new, ["k"])) == {
        "inserted": 2, "updated": 1, "unchanged": 2, "total": 5}


def test_metrics_of_nothing(spark):
    assert only(upsert.merge_metrics(kv(spark), kv(spark), ["k"])) == {
        "inserted": 0, "updated": 0, "unchanged": 0, "total": 0}


def test_two_batches_add_up(spark, lake_dir):
    table = SnapshotTable(spark, lake_dir, SPEC)
    table.upsert(spark.range(350).select(F.col("id").alias("k"), F.lit("1").alias("v")))
    table.upsert(spark.range(350, 470).select(F.col("id").alias("k"), F.lit("2").alias("v")))
    assert table.read().count() == 470
    table.upsert(spark.range(23).select(F.col("id").alias("k"), F.lit("3").alias("v")))
    counts = {r["v"]: r["count"] for r in table.read().groupBy("v").count().collect()}
    assert counts == {"1": 327, "2": 120, "3": 23}


def test_repeated_source_key_is_an_error(spark, lake_dir):
    table = SnapshotTable(spark, lake_dir, SPEC)
    with pytest.raises(upsert.DuplicateKeyError):
        table.upsert(kv(spark, (1, "a"), (1, "b")))
    assert table.versions() == []
    table.upsert(kv(spark, (1, "a"), (1, "b")), latest_by=["v"])
    assert pairs(table.read()) == [(1, "b")]


def test_same_batch_twice_changes_nothing(spark, lake_dir):
    table = SnapshotTable(spark, lake_dir, SPEC)
    batch = kv(spark, *[(i * KEY_BLOCK, str(i)) for i in range(20)])
    table.upsert(batch)
    once = pairs(table.read())
    table.upsert(batch)
    assert pairs(table.read()) == once


def test_empty_batch_makes_no_version(spark, lake_dir):
    table = SnapshotTable(spark, lake_dir, SPEC)
    table.upsert(kv(spark, (1, "a")))
    table.upsert(kv(spark))
    assert table.versions() == [1]


def written(table, version):
    """Rows in the folders that a version has and the one before lacks."""
    now, before = table._pointer(version)[1], table._pointer(version - 1)[1]
    held = {a for attempts in before["parts"].values() for a in attempts}
    new = {p: [a for a in attempts if a not in held] for p, attempts in now["parts"].items()}
    return table._rows({"parts": new}, [p for p, attempts in new.items() if attempts]).count()


def parts(table):
    return {int(p): len(a) for p, a in table._pointer()[1]["parts"].items()}


def test_a_merge_reads_and_writes_only_the_parts_of_its_keys(spark, lake_dir):
    table = SnapshotTable(spark, lake_dir, SPEC, part_bits=4, most_parts=64)
    table.upsert(kv(spark, *[(i, "old") for i in range(-20, 160)]))
    assert set(parts(table)) == set(range(-2, 10))
    counts = table.upsert(kv(spark, (17, "new"), (18, "new"), (-1, "new"), (500, "new")))
    assert counts == {"inserted": 1, "updated": 3, "unchanged": 177, "total": 181}
    assert written(table, 2) == 33  # parts -1 and 1 with 16 rows each, and the new one
    assert table.read().count() == 181
    held = table.read_between(20, 30)
    assert [r["k"] for r in held.orderBy("k").collect()] == list(range(20, 31))
    assert {f.split("part=")[1].split("/")[0] for f in held.inputFiles()} == {"1"}
    assert "PushedFilters: [IsNotNull(k), GreaterThanOrEqual(k,20)" in \
        held._jdf.queryExecution().executedPlan().toString()


def test_reading_after_many_merges_costs_what_it_costs_after_one(spark, lake_dir):
    table = SnapshotTable(spark, lake_dir, SPEC, part_bits=4, most_parts=64)
    table.upsert(kv(spark, *[(i, "0") for i in range(64)]))
    first = table.read()
    for step in range(1, 13):
        table.upsert(kv(spark, *[(k % 64, str(step)) for k in range(step, step + 5)]))
    last = table.read()
    assert set(parts(table).values()) == {1}
    assert len(last.inputFiles()) <= len(first.inputFiles())
    plan = last._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and "Join" not in plan and "Aggregate" not in plan
    want = {i: "0" for i in range(64)}
    for step in range(1, 13):
        want |= {k % 64: str(step) for k in range(step, step + 5)}
    assert dict(pairs(last)) == want


def test_sparse_keys_get_wider_parts(spark, lake_dir):
    table = SnapshotTable(spark, lake_dir, SPEC, part_bits=4, most_parts=64)
    table.upsert(kv(spark, *[(i, "a") for i in range(40)]))
    assert set(parts(table)) == {0, 1, 2}
    far = [(i << 40, "b") for i in range(-300, 300)]
    counts = table.upsert(kv(spark, *far))
    assert (counts["inserted"], counts["updated"], counts["total"]) == (599, 1, 639)
    assert len(parts(table)) <= 2 * 64
    want = {i: "a" for i in range(40)} | dict(far)
    assert dict(pairs(table.read())) == want
    table.append(kv(spark, (7 << 50, "c")))
    assert dict(pairs(table.read())) == want | {7 << 50: "c"}
    assert len(parts(table)) <= 2 * 64
    low = 5 << 40
    assert pairs(table.read_between(low, low + 1)) == [(low, "b")]
    assert table.upsert(kv(spark, (low, "d")))["updated"] == 1
    assert written(table, 4) < 300  # of 640 rows


def test_text_keys_are_dealt_over_parts(spark, lake_dir):
    spec = TableSpec("t", "dim", (("k", "STRING"), ("v", "STRING")), ("k",))
    table = SnapshotTable(spark, lake_dir, spec)
    schema = "k string, v string"
    table.upsert(spark.createDataFrame([(str(i), "a") for i in range(200)], schema))
    assert len(parts(table)) == snapshots.TEXT_PARTS
    counts = table.upsert(spark.createDataFrame([("7", "b"), ("x", "b")], schema))
    assert (counts["inserted"], counts["updated"], counts["total"]) == (1, 1, 201)
    assert written(table, 2) < 60
    assert table.read().where("v = 'b'").count() == 2


def test_appended_rows_stand_beside_those_of_their_part(spark, lake_dir):
    table = SnapshotTable(spark, lake_dir, SPEC)
    for i in range(3):
        table.append(kv(spark, (i, "a")))
    assert parts(table) == {0: 3}
    table.upsert(kv(spark, (1, "b"), (9, "n")))
    assert parts(table) == {0: 1}
    assert pairs(table.read()) == [(0, "a"), (1, "b"), (2, "a"), (9, "n")]


def test_counts_are_taken_as_the_rows_are_written(spark, lake_dir):
    table = SnapshotTable(spark, lake_dir, SPEC)
    table.upsert(kv(spark, (1, "a"), (None, "x")))
    counts = table.upsert(kv(spark, (1, "b"), (2, "c"), (None, "y"), (None, "y")))
    assert counts == {"inserted": 3, "updated": 1, "unchanged": 1, "total": 5}


def test_rows_without_a_key_stay(spark, lake_dir):
    table = SnapshotTable(spark, lake_dir, SPEC)
    table.upsert(kv(spark, (None, "a"), (1, "x")))
    table.upsert(kv(spark, (None, "b"), (None, "b"), (1, "y")))
    assert pairs(table.read()) == [(1, "y"), (None, "a"), (None, "b"), (None, "b")]


def test_older_versions_stay_readable(spark, lake_dir):
    table = SnapshotTable(spark, lake_dir, SPEC)
    table.upsert(kv(spark, (1, "a")))
    table.upsert(kv(spark, (1, "b")))
    assert pairs(table.read(1)) == [(1, "a")]
    table.recreate()
    assert table.read().isEmpty()
    assert pairs(table.read(2)) == [(1, "b")]


def test_an_unfinished_version_is_ignored(spark, lake_dir):
    table = SnapshotTable(spark, lake_dir, SPEC)
    table.upsert(kv(spark, (1, "a")))
    kv(spark, (2, "junk")).write.parquet(f"{lake_dir}/data/broken")
    with open(f"{lake_dir}/pointer/v=2.json", "w") as half:
        half.write('{"parts": {')
    assert pairs(table.read()) == [(1, "a")] and table.versions() == [1]
    table.upsert(kv(spark, (3, "c")))
    assert pairs(table.read()) == [(1, "a"), (3, "c")] and table.versions() == [1, 3]


def test_the_loser_of_two_writers_harms_nothing(spark, lake_dir):
    """Both begin from version 1; the second to commit raises, the first one's rows stay."""
    one, two = (SnapshotTable(spark, lake_dir, SPEC) for _ in range(2))
    one.upsert(kv(spark, (1, "a")))
    seen, _ = two._pointer()
    mine = two._write(kv(spark, (3, "loser")), 22)
    one.upsert(kv(spark, (1, "b"), (2, "winner")))
    with pytest.raises(VersionConflict, match="written by another run"):
        two._commit(seen, {"parts": mine})
    for table in (one, two):
        assert pairs(table.read()) == [(1, "b"), (2, "winner")]
    two.upsert(kv(spark, (3, "again")))
    assert pairs(one.read()) == [(1, "b"), (2, "winner"), (3, "again")]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_batches_against_a_dict(spark, tmp_path, seed):
    r = random.Random(seed)
    table = SnapshotTable(spark, str(tmp_path / "t"), SPEC)
    held: dict = {}
    for step in range(4):
        keys = r.sample(range(30), r.randint(1, 15))
        batch = {k * KEY_BLOCK: f"{step}-{k}" for k in keys}
        table.upsert(kv(spark, *batch.items()))
        held |= batch
        assert dict(pairs(table.read())) == held


def test_disjoint_batches_commute(spark, tmp_path):
    batches = [[(1, "a"), (2, "b")], [(3, "c")], [(4, "d"), (5, "e")]]
    results = set()
    for n, order in enumerate(itertools.permutations(batches)):
        table = SnapshotTable(spark, str(tmp_path / str(n)), SPEC)
        for batch in order:
            table.upsert(kv(spark, *batch))
        results.add(tuple(pairs(table.read())))
    assert len(results) == 1


def test_latest_prefers_version_then_whole_row(spark):
    df = spark.createDataFrame(
        [(1, 5, "b"), (1, 5, "c"), (1, None, "z"), (2, None, "n"), (None, 1, "p"),
         (None, 1, "q")], "k long, version long, v string")
    got = [(r["k"], r["v"]) for r in upsert.latest_per_key(df, ["k"], ["version"]).collect()]
    assert sorted(got, key=repr) == [(1, "c"), (2, "n"), (None, "p"), (None, "q")]


def test_first_arrival_wins_and_conflicts_are_ignored(spark):
    schema = "k long, v string, updated_at timestamp, n long"
    batch = spark.createDataFrame(
        [(1, "late", None, 9), (1, "early", None, 2), (2, "taken", None, 1)], schema)
    target = spark.createDataFrame([(2, "held", None)], "k long, v string, updated_at timestamp")
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    got = only(upsert.rows_to_insert(target, batch, ["k"], ["n"], now))
    assert (got["k"], got["v"], str(got["updated_at"])) == (1, "early", "2024-01-01 00:00:00")
    assert "n" not in got


def test_insert_rejects_a_null_key(spark):
    batch = spark.createDataFrame([(None, "x", 1)], "k long, v string, n long")
    with pytest.raises(SparkRuntimeException, match="NULL in primary key"):
        upsert.rows_to_insert(kv(spark), batch, ["k"], ["n"]).collect()


def test_hot_key_is_folded_before_the_shuffle(spark):
    """A third of the rows share one key: each map task sends one row of it."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("n"), F.lit("v").alias("v"))
    got = upsert.latest_per_key(df, ["k"], ["n"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max") > plan.index("Exchange hashpartitioning(k")
    assert plan.count("Range (") == 1
    assert got.where("k = 0").collect()[0]["n"] == 29_997
    assert got.count() == 20_001
    assert rows(upsert.duplicate_keys(df, ["k"])) == [{"k": 0, "n_rows": 10_000}]


def test_plain_tables_refuse_row_level_merges(spark, tmp_path):
    """Why versioned tables exist; a catalog with row-level writes would take this merge."""
    spark.sql(f"CREATE TABLE merge_t (k BIGINT, v STRING) USING parquet LOCATION '{tmp_path}/t'")
    try:
        with pytest.raises(UnsupportedOperationException, match="TABLE_OPERATION"):
            upsert.merge_into(kv(spark, (1, "a")), "merge_t", ["k"])
    finally:
        spark.sql("DROP TABLE merge_t")


def test_only_keys_meet_before_an_insert(spark, tmp_path):
    """Rows of keys that are new and occur once pass without a shuffle; others as before."""
    schema = "k long, v string, n long"
    path = str(tmp_path / "batch")
    spark.createDataFrame([(k, f"v{k}", k) for k in range(20)], schema).write.parquet(path)
    batch = spark.read.parquet(path)

    def insert(target, batch, label):
        return upsert.rows_to_insert(
            target, batch, ["k"], ["n"], work=str(tmp_path / label), n_rows=batch.count())

    new = insert(kv(spark), batch, "new")
    assert "Exchange" not in new._jdf.queryExecution().executedPlan().toString()
    assert sorted(new.toPandas()["k"]) == list(range(20))
    assert insert(batch.drop("n"), batch, "held").isEmpty()
    mixed = batch.unionByName(spark.createDataFrame([(7, "late", 99), (7, "first", -1)], schema))
    target = batch.where("k < 5").drop("n")
    got = insert(target, mixed, "mixed")
    plain = upsert.rows_to_insert(target, mixed, ["k"], ["n"])
    assert rows(got.orderBy("k")) == rows(plain.orderBy("k"))
    assert [r["v"] for r in got.where("k = 7").collect()] == ["first"]
    with pytest.raises(SparkRuntimeException, match="NULL in primary key"):
        insert(kv(spark), spark.createDataFrame([(None, "x", 1)], schema), "null")


def test_large_stored_batches_go_to_their_parts_without_a_shuffle(spark, tmp_path, monkeypatch):
    table = SnapshotTable(spark, str(tmp_path / "t"), SPEC, part_bits=2)
    spark.range(32).selectExpr("id as k", "cast(id as string) as v").repartition(2) \
        .write.parquet(str(tmp_path / "batch"))
    batch = spark.read.schema(SPEC.schema).parquet(str(tmp_path / "batch"))
    assert not table._large(batch)
    monkeypatch.setattr(snapshots, "FILE_BYTES", 1)
    assert table._large(batch)
    hinted = []
    hint = type(batch).hint
    monkeypatch.setattr(type(batch), "hint", lambda df, *a: hinted.append(a) or hint(df, *a))
    table.append(batch, stored=True)
    assert not hinted and table.read().count() == 32
    table.recreate()
    assert table.upsert(batch)["inserted"] == 32 and not hinted
    assert table.upsert(batch)["updated"] == 32 and hinted
    assert sorted(r["k"] for r in table.read_between(4, 7).collect()) == [4, 5, 6, 7]
