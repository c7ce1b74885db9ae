"""The older marts: pass mark 5, no status filter, unweighted averages."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lectern.functions import scores as S
from lectern.plans import marts
from lectern.plans.marts import Tables


def student_performance(t: Tables) -> DataFrame:
    rows = (
        marts.seats(t)
        .join(marts.scores_per_study(t, S.PASS_MARK_V1), marts.STUDY_KEY)
        .join(marts.offerings(t, ["total_credit"], ["program_id", "semester_name"]),
              "instruction_id")
    )
    per_semester = rows.groupBy("student_id", "program_id", "semester_name").agg(
        F.sum("n_scores").alias("total_courses_enrolled"),
        F.sum(F.col("n_seats") * F.col("n_passed")).alias("total_courses_passed"),
        F.sum(F.col("n_seats") * F.col("n_rows") * F.col("total_credit"))
        .alias("total_credits_earned"),
        S.mean(
            F.sum(F.col("n_seats") * F.col("score_sum")),
            F.sum(F.col("n_seats") * F.col("score_count")),
        ).alias("GPA"),
    )
    names = t["student"].select("student_id", "student_name")
    return per_semester.join(names, "student_id").select(
        "student_id", "student_name", "program_id", "semester_name",
        "total_courses_enrolled", "total_courses_passed", "total_credits_earned", "GPA",
    )


def course_performance(t: Tables) -> DataFrame:
    """Passed rows are counted per row and students once, so the rate can exceed 100."""
    keys = ["course_id", "course_name", "semester_name"]
    n_students = F.count_distinct("student_id")
    n_passed = F.sum(S.passed("final_score", S.PASS_MARK_V1))
    return (
        t["score_fact"].select("instruction_id", "student_id", "final_score")
        .join(marts.offerings(t, ["course_name"], ["semester_name"]), "instruction_id")
        .groupBy(*keys)
        .agg(
            n_students.alias("num_students_enrolled"),
            n_passed.alias("num_students_passed"),
            S.pass_rate(n_passed, n_students).alias("pass_rate"),
            F.avg("final_score").alias("average_final_score"),
        )
    )


def lecturer_performance(t: Tables) -> DataFrame:
    return marts.lecturer_performance(t, status=None)


def instruction_aggregate(t: Tables) -> DataFrame:
    return marts.instruction_aggregate(t, status=None)


def score_histogram(t: Tables) -> DataFrame:
    return marts.spread(
        t, S.score_range("final_score"), "score_range", ["semester_name"],
        "num_students_in_range",
    )


MARTS_V1 = {
    "student_performance": (
        student_performance, "student_id", ["student_id", "program_id", "semester_name"]),
    "course_performance": (
        course_performance, "course_id", ["course_id", "course_name", "semester_name"]),
    "lecturer_performance": (
        lecturer_performance, "lecturer_id", ["lecturer_id", "course_id", "semester_name"]),
    "instruction_aggregate": (
        instruction_aggregate, "instruction_id", ["instruction_id"]),
    "score_distribution": (
        score_histogram, "course_id", ["course_id", "semester_name", "score_range"]),
}
