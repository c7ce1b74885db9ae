"""The six current marts over the warehouse tables.

Each mart takes a mapping of warehouse tables and returns a DataFrame.  The tables hold
one row per primary key (``operators.upsert`` keeps that), so facts are reduced to one
row per join key before they meet: a hot student, class or rank is folded on the map
side, and repeated seats or lecturer listings become multipliers, not repeated rows.
No join is hinted; Catalyst broadcasts a side only when its measured size allows it and
falls back to a shuffled join with skew splitting.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from lectern.functions import scores as S

Tables = Mapping[str, DataFrame]

STUDY_KEY = ["student_id", "instruction_id"]


def offerings(t: Tables, course: list[str], semester: list[str], status: str | None = None,
              own: list[str] | None = None) -> DataFrame:
    """instruction_fact with the asked columns of its course and semester."""
    instructions = t["instruction_fact"]
    if status is not None:
        instructions = instructions.where(F.col("instruction_status") == status)
    return (
        instructions.select("instruction_id", "program_semester_id", "course_id", *(own or []))
        .join(t["course"].select("course_id", *course), "course_id")
        .join(t["program_semester"].select("program_semester_id", *semester),
              "program_semester_id")
    )


def seats(t: Tables) -> DataFrame:
    """One row per student and instruction with the number of enrollments behind it."""
    return (
        t["enroll_student"].select("student_id", "enrollment_id")
        .join(t["enrollment_fact"].select("enrollment_id", "instruction_id"), "enrollment_id")
        .groupBy(*STUDY_KEY)
        .agg(F.count("*").alias("n_seats"))
    )


def scores_per_study(t: Tables, mark: float = S.PASS_MARK) -> DataFrame:
    """score_fact folded to one row per student and instruction."""
    weighs = F.col("final_score_4") >= 1
    return t["score_fact"].groupBy(*STUDY_KEY).agg(
        F.count("*").alias("n_rows"),
        F.count("score_id").alias("n_scores"),
        F.sum(S.passed("final_score", mark)).alias("n_passed"),
        F.sum("final_score").alias("score_sum"),
        F.count("final_score").alias("score_count"),
        F.sum(F.when(weighs, F.col("final_score_4").cast(S.SCORE_4))).alias("weight"),
        F.sum(F.when(weighs, 1).otherwise(0)).alias("n_weighted"),
    )


def study_record(t: Tables, mark: float = S.PASS_MARK) -> DataFrame:
    """Seats with their folded scores; seats without a score keep NULL score columns.

    Both student marts start here, so a run can store it once and pass it to each.
    """
    return seats(t).join(scores_per_study(t, mark), STUDY_KEY, "left")


def student_performance(t: Tables, record: DataFrame | None = None) -> DataFrame:
    record = study_record(t) if record is None else record
    rows = record.where(F.col("n_rows").isNotNull()).join(
        offerings(t, ["total_credit"], ["program_id", "semester_name"]), "instruction_id"
    )
    seat_credit = F.col("n_seats") * F.col("total_credit")
    per_semester = rows.groupBy("student_id", "program_id", "semester_name").agg(
        F.sum("n_scores").alias("total_courses_enrolled"),
        F.sum(F.col("n_seats") * F.col("n_passed")).alias("total_courses_passed"),
        F.sum(seat_credit * F.col("n_rows")).alias("total_credits_earned"),
        S.grade_point_average(
            F.sum(F.coalesce(F.col("weight"), F.lit(0)) * seat_credit),
            F.sum(F.col("n_weighted") * seat_credit),
        ).alias("GPA"),
    )
    return per_semester.join(_student_names(t), "student_id").select(
        "student_id", "student_name", "program_id", "semester_name",
        "total_courses_enrolled", "total_courses_passed", "total_credits_earned", "GPA",
    )


def _student_names(t: Tables) -> DataFrame:
    return t["student"].select("student_id", "student_name")


def course_performance(t: Tables) -> DataFrame:
    keys = ["course_code", "course_name", "semester_name"]
    unique_scores = (
        t["score_fact"].select("instruction_id", "student_id", "final_score")
        .join(offerings(t, keys[:2], keys[2:], "completed"), "instruction_id")
        .select(*keys, "student_id", "final_score")
        .distinct()
    )
    n_passed = F.sum(S.passed("final_score"))
    return unique_scores.groupBy(*keys).agg(
        F.count("student_id").alias("num_students_enrolled"),
        n_passed.alias("num_students_passed"),
        S.pass_rate(n_passed, F.count("student_id")).alias("pass_rate"),
        F.avg("final_score").alias("average_final_score"),
    )


def lecturer_performance(t: Tables, status: str | None = "completed") -> DataFrame:
    """Scores are folded per instruction and listings per lecturer and instruction before
    they meet, so a class of n scores and m listings costs n + m rows, not n * m.  Folded
    listings make distinct classes a plain count; each listing still weighs the average."""
    per_instruction = t["score_fact"].groupBy("instruction_id").agg(
        F.sum("final_score").alias("score_sum"), F.count("final_score").alias("score_count")
    )
    listings = (
        t["instruction_lecturer"].groupBy("lecturer_id", "instruction_id")
        .agg(F.count("*").alias("n_listings"))
    )
    classes = offerings(t, ["course_name"], ["semester_name"], status).join(
        per_instruction, "instruction_id"
    )
    per_lecturer = (
        listings.join(classes, "instruction_id")
        .groupBy("lecturer_id", "course_id", "course_name", "semester_name")
        .agg(
            F.count("*").alias("num_classes_taught"),
            S.mean(
                F.sum(F.col("n_listings") * F.col("score_sum")),
                F.sum(F.col("n_listings") * F.col("score_count")),
            ).alias("average_class_score"),
        )
    )
    names = (
        t["lecturer"].select("lecturer_id", "employee_id")
        .join(t["employee"].select("employee_id", "employee_name"), "employee_id")
        .select("lecturer_id", F.col("employee_name").alias("lecturer_name"))
    )
    return per_lecturer.join(names, "lecturer_id").select(
        "lecturer_id", "lecturer_name", "course_id", "course_name", "semester_name",
        "num_classes_taught", "average_class_score",
    )


def instruction_aggregate(t: Tables, status: str | None = "completed") -> DataFrame:
    return offerings(
        t, ["course_name"], ["program_id", "semester_name"], status,
        ["num_student", "avg_final_score"],
    ).select(
        "instruction_id", "course_id", "course_name", "program_id", "semester_name",
        F.col("num_student").alias("num_students"), "avg_final_score",
    )


def spread(t: Tables, label: Column, name: str, semester: list[str], count: str) -> DataFrame:
    """Score rows per course, semester columns and label, counted per instruction first."""
    counted = (
        t["score_fact"].select("instruction_id", label.alias(name))
        .groupBy("instruction_id", name)
        .agg(F.count("*").alias("n"))
    )
    return (
        counted.join(offerings(t, ["course_name"], semester), "instruction_id")
        .groupBy("course_id", "course_name", *semester, name)
        .agg(F.sum("n").alias(count))
    )


def score_distribution(t: Tables) -> DataFrame:
    return spread(
        t, F.col("academic_rank"), "academic_rank", ["program_id", "semester_name"],
        "num_students_with_rank",
    )


def student_program_completion(t: Tables, record: DataFrame | None = None) -> DataFrame:
    record = study_record(t) if record is None else record
    requirements = t["program_semester"].groupBy("program_id").agg(
        F.sum("required_credit").alias("total_required_credit"),
        F.sum("elective_credit").alias("total_elective_credit"),
    )
    rows = record.join(
        offerings(t, ["category", "total_credit"], ["program_id"]), "instruction_id"
    )
    # A seat without a score still registers its credits once.
    registered = F.col("n_seats") * F.coalesce(F.col("n_rows"), F.lit(1)) * F.col("total_credit")
    achieved = F.col("n_seats") * F.coalesce(F.col("n_passed"), F.lit(0)) * F.col("total_credit")

    def credits(category: str, amount: Column) -> Column:
        of_category = F.when(F.col("category") == category, amount).otherwise(0)
        return F.coalesce(F.sum(of_category), F.lit(0))

    per_program = rows.groupBy("student_id", "program_id").agg(
        credits("required", registered).alias("total_required_credit_registered"),
        credits("elective", registered).alias("total_elective_credit_registered"),
        credits("required", achieved).alias("total_required_credit_passed"),
        credits("elective", achieved).alias("total_elective_credit_passed"),
    )
    complete = (
        F.col("total_required_credit_registered") >= F.col("total_required_credit")
    ) & (F.col("total_elective_credit_registered") >= F.col("total_elective_credit"))
    return (
        per_program.join(requirements, "program_id")
        .join(_student_names(t), "student_id")
        .select(
            "student_id", "student_name", "program_id",
            "total_required_credit", "total_elective_credit",
            "total_required_credit_registered", "total_elective_credit_registered",
            "total_required_credit_passed", "total_elective_credit_passed",
            F.when(complete, "Completed").otherwise("Not Completed").alias("completion_status"),
        )
    )


# name -> (builder, order key of the served copy, grain that makes a row unique)
MARTS = {
    "student_performance": (
        student_performance, "GPA", ["student_id", "program_id", "semester_name"]),
    "course_performance": (
        course_performance, "average_final_score",
        ["course_code", "course_name", "semester_name"]),
    "lecturer_performance": (
        lecturer_performance, "average_class_score",
        ["lecturer_id", "course_id", "semester_name"]),
    "instruction_aggregate": (
        instruction_aggregate, "avg_final_score", ["instruction_id"]),
    "score_distribution": (
        score_distribution, "num_students_with_rank",
        ["course_id", "program_id", "semester_name", "academic_rank"]),
    "student_program_completion": (
        student_program_completion, "completion_status", ["student_id", "program_id"]),
}

# Warehouse tables each mart reads; decides which marts an incremental run rebuilds.
MART_INPUTS = {
    "student_performance": {
        "student", "enroll_student", "enrollment_fact", "instruction_fact",
        "program_semester", "course", "score_fact"},
    "course_performance": {"course", "instruction_fact", "program_semester", "score_fact"},
    "lecturer_performance": {
        "lecturer", "employee", "instruction_lecturer", "instruction_fact", "course",
        "program_semester", "score_fact"},
    "instruction_aggregate": {"instruction_fact", "course", "program_semester"},
    "score_distribution": {"score_fact", "instruction_fact", "course", "program_semester"},
    "student_program_completion": {
        "student", "enroll_student", "enrollment_fact", "instruction_fact",
        "program_semester", "course", "score_fact"},
}
