"""Small warehouse tables for tests."""

from __future__ import annotations

from lectern.specs import TABLES


def frame(spark, table: str, rows: list[dict]):
    """Rows given as dicts; declared columns that are not named are NULL."""
    spec = TABLES[table]
    return spark.createDataFrame(
        [tuple(row.get(c) for c in spec.names) for row in rows], spec.schema
    )


def warehouse(spark, **tables) -> dict:
    return {name: frame(spark, name, tables.get(name, [])) for name in TABLES}


def one_course_school(spark, **more) -> dict:
    """One programme with one semester, one course of 3 credits and one completed class."""
    base = {
        "student": [{"student_id": "s1", "student_name": "Ann"},
                    {"student_id": "s2", "student_name": "Bo"}],
        "program": [{"program_id": "P"}],
        "program_semester": [{"program_semester_id": "P_1", "program_id": "P",
                              "semester_name": "One", "required_credit": 3,
                              "elective_credit": 0}],
        "course": [{"course_id": 1, "course_name": "Sets", "course_code": 11,
                    "category": "required", "total_credit": 3}],
        "instruction_fact": [{"instruction_id": 100, "program_semester_id": "P_1",
                              "course_id": 1, "instruction_status": "completed",
                              "num_student": 2, "avg_final_score": 6.0}],
        "enrollment_fact": [{"enrollment_id": 7, "instruction_id": 100}],
        "enroll_student": [{"student_id": "s1", "enrollment_id": 7}],
    }
    return warehouse(spark, **(base | more))


def rows(df) -> list[dict]:
    return sorted((r.asDict() for r in df.collect()), key=repr)


def only(df) -> dict:
    found = df.collect()
    assert len(found) == 1, found
    return found[0].asDict()
