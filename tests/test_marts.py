"""Marts on hand-made tables, and on random tables against DuckDB."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F, types as T

import oracles
from lectern.plans import marts, marts_v1
from lectern.specs import TABLES
from tests.compare import difference
from tests.tables import one_course_school, only, rows, warehouse


def score(score_id, value, four=None, student="s1", instruction=100, rank=None):
    return {"score_id": score_id, "instruction_id": instruction, "student_id": student,
            "final_score": value, "final_score_4": four, "academic_rank": rank}


@pytest.mark.parametrize("value, passed, passed_v1", [
    (3.99, 0, 0), (4.0, 1, 0), (4.99, 1, 0), (5.0, 1, 1), (None, 0, 0), (-1.0, 0, 0),
])
def test_pass_marks(spark, value, passed, passed_v1):
    t = one_course_school(spark, score_fact=[score(1, value)])
    assert only(marts.student_performance(t))["total_courses_passed"] == passed
    assert only(marts_v1.student_performance(t))["total_courses_passed"] == passed_v1


@pytest.mark.parametrize("four, gpa", [(None, 0.0), (0.99, 0.0), (1.0, 1.0), (3.8, 3.8)])
def test_gpa_counts_scores_from_one(spark, four, gpa):
    t = one_course_school(spark, score_fact=[score(1, 5.0, four)])
    assert only(marts.student_performance(t))["GPA"] == gpa


def test_gpa_rounds_half_up(spark):
    t = one_course_school(
        spark,
        course=[{"course_id": 1, "course_name": "Sets", "total_credit": 17},
                {"course_id": 2, "course_name": "Maps", "total_credit": 23}],
        instruction_fact=[
            {"instruction_id": 100, "program_semester_id": "P_1", "course_id": 1},
            {"instruction_id": 200, "program_semester_id": "P_1", "course_id": 2}],
        enrollment_fact=[{"enrollment_id": 7, "instruction_id": 100},
                         {"enrollment_id": 8, "instruction_id": 200}],
        enroll_student=[{"student_id": "s1", "enrollment_id": 7},
                        {"student_id": "s1", "enrollment_id": 8}],
        score_fact=[score(1, 9.0, 3.0), score(2, 9.0, 2.0, instruction=200)],
    )
    assert only(marts.student_performance(t))["GPA"] == 2.43  # 97 / 40 = 2.425


def test_two_seats_double_the_sums_but_not_the_distinct_count(spark):
    t = one_course_school(
        spark,
        enrollment_fact=[{"enrollment_id": 7, "instruction_id": 100},
                         {"enrollment_id": 8, "instruction_id": 100}],
        enroll_student=[{"student_id": "s1", "enrollment_id": 7},
                        {"student_id": "s1", "enrollment_id": 8}],
        score_fact=[score(1, 6.0, 2.0)],
    )
    row = only(marts.student_performance(t))
    assert (row["total_courses_enrolled"], row["total_courses_passed"],
            row["total_credits_earned"], row["GPA"]) == (1, 2, 6, 2.0)


def test_zero_credit_course(spark):
    t = one_course_school(
        spark, course=[{"course_id": 1, "course_name": "Sets", "total_credit": 0}],
        score_fact=[score(1, 9.0, 4.0)])
    assert only(marts.student_performance(t))["GPA"] == 0.0


def test_null_credit(spark):
    t = one_course_school(
        spark, course=[{"course_id": 1, "course_name": "Sets", "category": "required"}],
        score_fact=[score(1, 9.0, 4.0)])
    row = only(marts.student_performance(t))
    assert (row["total_credits_earned"], row["GPA"]) == (None, 0.0)
    assert only(marts.student_program_completion(t))["total_required_credit_registered"] == 0


def test_course_counts_equal_scores_of_a_student_once(spark):
    t = one_course_school(
        spark,
        instruction_fact=[
            {"instruction_id": i, "program_semester_id": "P_1", "course_id": 1,
             "instruction_status": "completed"} for i in (100, 101, 102)],
        score_fact=[score(1, 6.0), score(2, 6.0, instruction=101),
                    score(3, 3.0, instruction=102), score(4, 6.0, student="s2")],
    )
    row = only(marts.course_performance(t))
    assert row["num_students_enrolled"] == 3 and row["num_students_passed"] == 2
    assert row["average_final_score"] == 5.0
    assert str(row["pass_rate"]) == "66.66666666666667"


def test_pass_rate_is_decimal_and_null_without_students(spark):
    t = one_course_school(spark, score_fact=[score(1, 6.0, student=None)])
    df = marts.course_performance(t)
    assert df.schema["pass_rate"].dataType == T.DecimalType(38, 14)
    row = only(df)
    assert (row["num_students_enrolled"], row["num_students_passed"], row["pass_rate"]) == (
        0, 1, None)


def test_older_pass_rate_can_exceed_hundred(spark):
    t = one_course_school(
        spark,
        instruction_fact=[
            {"instruction_id": i, "program_semester_id": "P_1", "course_id": 1}
            for i in (100, 101)],
        score_fact=[score(1, 9.0), score(2, 8.0, instruction=101)])
    assert only(marts_v1.course_performance(t))["pass_rate"] == 200


def test_only_completed_classes_count(spark):
    t = one_course_school(
        spark,
        instruction_fact=[{"instruction_id": 100, "program_semester_id": "P_1",
                           "course_id": 1, "instruction_status": "cannot_open"}],
        score_fact=[score(1, 6.0)])
    assert marts.course_performance(t).isEmpty()
    assert marts.instruction_aggregate(t).isEmpty()
    assert not marts_v1.instruction_aggregate(t).isEmpty()


def test_lecturer_listed_twice_weighs_twice(spark):
    listed = [("theory", 1, 100), ("practice", 2, 100), ("theory", 3, 101)]
    t = one_course_school(
        spark,
        employee=[{"employee_id": 5, "employee_name": "Kim"}],
        lecturer=[{"lecturer_id": 50, "employee_id": 5}],
        instruction_fact=[
            {"instruction_id": i, "program_semester_id": "P_1", "course_id": 1,
             "instruction_status": "completed"} for i in (100, 101)],
        instruction_lecturer=[
            {"instruction_lecturer_id": k, "instruction_id": i, "lecturer_id": 50,
             "lecturer_type": kind} for kind, k, i in listed],
        score_fact=[score(1, 4.0), score(2, 8.0, student="s2"),
                    score(3, 9.0, instruction=101)])
    row = only(marts.lecturer_performance(t))
    assert row["lecturer_name"] == "Kim" and row["num_classes_taught"] == 2
    assert row["average_class_score"] == pytest.approx((4 + 8 + 4 + 8 + 9) / 5)


def test_lecturer_without_scored_values(spark):
    t = one_course_school(
        spark,
        employee=[{"employee_id": 5, "employee_name": "Kim"}],
        lecturer=[{"lecturer_id": 50, "employee_id": 5}],
        instruction_lecturer=[{"instruction_lecturer_id": 1, "instruction_id": 100,
                               "lecturer_id": 50}],
        score_fact=[score(1, None)])
    row = only(marts.lecturer_performance(t))
    assert (row["num_classes_taught"], row["average_class_score"]) == (1, None)


def test_null_rank_is_a_group(spark):
    t = one_course_school(
        spark, score_fact=[score(1, 6.0, rank="C"), score(2, None, student="s2")])
    got = {r["academic_rank"]: r["num_students_with_rank"]
           for r in marts.score_distribution(t).collect()}
    assert got == {"C": 1, None: 1}


def test_older_histogram(spark):
    values = [0.0, 1.0, 1.01, 4.0, 4.01, -1.0, None]
    t = one_course_school(spark, score_fact=[score(i, v) for i, v in enumerate(values)])
    got = {r["score_range"]: r["num_students_in_range"]
           for r in marts_v1.score_histogram(t).collect()}
    assert got == {"0-1": 2, "1-2": 1, "3-4": 1, "Unknown": 3}


def test_completion_counts_registered_credits(spark):
    t = one_course_school(spark)  # a seat without a score
    row = only(marts.student_program_completion(t))
    assert row["total_required_credit_registered"] == 3
    assert row["total_required_credit_passed"] == 0
    assert row["completion_status"] == "Completed"


def test_completion_with_unknown_requirement(spark):
    t = one_course_school(
        spark, program_semester=[{"program_semester_id": "P_1", "program_id": "P",
                                  "semester_name": "One", "required_credit": 3}])
    row = only(marts.student_program_completion(t))
    assert row["total_elective_credit"] is None
    assert row["completion_status"] == "Not Completed"


def test_student_without_seat_is_absent(spark):
    assert [r["student_id"] for r in rows(marts.student_program_completion(
        one_course_school(spark)))] == ["s1"]


def random_school(seed: int) -> dict[str, list[dict]]:
    """Few keys and many NULLs, so every join meets repeats, gaps and strangers."""
    r = random.Random(seed)
    maybe = lambda v: None if r.random() < 0.1 else v
    ids = list(range(1, 7))
    return {
        "student": [{"student_id": f"s{i}", "student_name": maybe(f"n{i % 3}")} for i in ids],
        "program": [{"program_id": p} for p in "PQ"],
        "program_semester": [
            {"program_semester_id": f"ps{i}", "program_id": maybe(r.choice("PQ")),
             "semester_name": maybe(f"sem{i % 3}"), "required_credit": maybe(r.randint(0, 4)),
             "elective_credit": maybe(r.randint(0, 3))} for i in ids],
        "course": [
            {"course_id": i, "course_name": f"c{i % 4}", "course_code": i % 3,
             "category": maybe(r.choice(["required", "elective"])),
             "total_credit": maybe(r.randint(0, 5))} for i in ids],
        "employee": [{"employee_id": i, "employee_name": f"e{i % 2}"} for i in ids[1:]],
        "lecturer": [{"lecturer_id": i, "employee_id": maybe(r.choice(ids))} for i in ids],
        "instruction_fact": [
            {"instruction_id": i, "program_semester_id": maybe(f"ps{r.randint(1, 7)}"),
             "course_id": maybe(r.randint(1, 7)), "num_student": maybe(r.randint(0, 9)),
             "avg_final_score": maybe(r.randint(0, 40) / 4),
             "instruction_status": maybe(r.choice(["completed", "cannot_open"]))}
            for i in range(1, 13)],
        "instruction_lecturer": [
            {"instruction_lecturer_id": i, "instruction_id": maybe(r.randint(1, 13)),
             "lecturer_id": maybe(r.randint(1, 7))} for i in range(40)],
        "enrollment_fact": [
            {"enrollment_id": i, "instruction_id": maybe(r.randint(1, 13))}
            for i in range(1, 21)],
        "enroll_student": [
            {"student_id": f"s{s}", "enrollment_id": e}
            for s in range(1, 8) for e in range(1, 22) if r.random() < 0.4],
        "score_fact": [
            {"score_id": i, "instruction_id": maybe(r.randint(1, 13)),
             "student_id": maybe(f"s{r.randint(1, 7)}"),
             "final_score": maybe(r.randint(-1, 40) / 4),
             "final_score_4": maybe(r.choice([0.0, 0.5, 1.0, 1.5, 2.5, 3.8, 4.0])),
             "academic_rank": maybe(r.choice("ABC"))} for i in range(120)],
    }


BUILDERS = {
    **{name: entry[0] for name, entry in marts.MARTS.items()},
    "student_performance_v1": marts_v1.student_performance,
    "course_performance_v1": marts_v1.course_performance,
    "lecturer_performance_v1": marts_v1.lecturer_performance,
    "instruction_aggregate_v1": marts_v1.instruction_aggregate,
    "score_histogram_v1": marts_v1.score_histogram,
}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_tables_against_sql(spark, seed):
    tables = random_school(seed)
    t = warehouse(spark, **tables)
    con = duckdb.connect()
    for name in tables:
        kinds = {"BIGINT": "BIGINT", "STRING": "VARCHAR", "DOUBLE": "DOUBLE",
                 "BOOLEAN": "BOOLEAN", "TIMESTAMP": "TIMESTAMP"}
        columns = ", ".join(f"{c} {kinds[k]}" for c, k in TABLES[name].columns)
        con.execute(f"CREATE TABLE {name} ({columns})")
        marks = ", ".join("?" * len(TABLES[name].columns))
        con.executemany(
            f"INSERT INTO {name} VALUES ({marks})",
            [[row.get(c) for c in TABLES[name].names] for row in tables[name]])
    for name, build in BUILDERS.items():
        df, sql = build(t), oracles.MART[name]
        if "pass_rate" in df.columns:
            df = df.withColumn("pass_rate", F.round(F.col("pass_rate").cast("double"), 9))
            sql = f"SELECT * REPLACE (round(pass_rate, 9) AS pass_rate) FROM ({sql})"
        statement = oracles.with_tables(sql, only=("offering", "seat"))
        assert difference(df, con, statement) is None, name
