"""Declared tables: columns, keys, references and source text limits."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

SPARK_TYPES = {
    "BIGINT": T.LongType(),
    "STRING": T.StringType(),
    "BOOLEAN": T.BooleanType(),
    "DOUBLE": T.DoubleType(),
    "TIMESTAMP": T.TimestampType(),
}


@dataclass(frozen=True)
class ForeignKey:
    column: str
    table: str
    parent_column: str


@dataclass(frozen=True)
class TableSpec:
    name: str
    kind: str
    columns: tuple[tuple[str, str], ...]
    key: tuple[str, ...]
    foreign_keys: tuple[ForeignKey, ...] = ()
    lengths: dict[str, int] = field(default_factory=dict, hash=False)

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.columns]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, SPARK_TYPES[t], True) for n, t in self.columns])

    def source_schema(self) -> T.StructType:
        """Schema of the table at the source: the declared columns plus its change stamp."""
        return self.schema.add("updated_at", T.TimestampType(), True)


def _table(name, kind, key, foreign_keys=(), lengths=None, **columns: str) -> TableSpec:
    for column, type_name in columns.items():
        if type_name not in SPARK_TYPES:
            raise ValueError(f"{name}.{column}: unsupported column type {type_name}")
    return TableSpec(
        name, kind, tuple(columns.items()), key,
        tuple(ForeignKey(*fk) for fk in foreign_keys), dict(lengths or {}),
    )


# Table names, column names, types, keys, references and text limits
# of the academic source system.
TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        _table(
            "employee", "dim", ("employee_id",),
            employee_id="BIGINT",
            employee_name="STRING",
            day_of_birth="TIMESTAMP",
            nationality="STRING",
            insurance_id="STRING",
        ),
        _table(
            "lecturer", "dim", ("lecturer_id",),
            foreign_keys=[
                ("employee_id", "employee", "employee_id"),
            ],
            lengths={"academic_title": 20, "degree": 50, "degree_issue_place": 100,
                     "major": 100, "department": 100},
            lecturer_id="BIGINT",
            employee_id="BIGINT",
            academic_title="STRING",
            academic_title_date="TIMESTAMP",
            degree="STRING",
            degree_issue_date="TIMESTAMP",
            degree_issue_place="STRING",
            major="STRING",
            department="STRING",
            number_of_exp="BIGINT",
        ),
        _table(
            "program", "dim", ("program_id",),
            lengths={"program_id": 10, "class_of": 50},
            program_id="STRING",
            class_of="STRING",
        ),
        _table(
            "program_semester", "dim", ("program_semester_id",),
            foreign_keys=[
                ("program_id", "program", "program_id"),
            ],
            lengths={"program_semester_id": 10, "program_id": 10, "semester_name": 20},
            program_semester_id="STRING",
            program_id="STRING",
            semester_name="STRING",
            total_credit="BIGINT",
            required_credit="BIGINT",
            elective_credit="BIGINT",
        ),
        _table(
            "course", "dim", ("course_id",),
            lengths={"course_name": 200, "category": 100},
            course_id="BIGINT",
            course_name="STRING",
            course_code="BIGINT",
            category="STRING",
            total_credit="BIGINT",
            theory_credit="BIGINT",
            practice_credit="BIGINT",
            self_learning_credit="BIGINT",
        ),
        _table(
            "program_course", "source", ("program_semester_id", "course_id",),
            foreign_keys=[
                ("program_semester_id", "program_semester", "program_semester_id"),
                ("course_id", "course", "course_id"),
            ],
            lengths={"program_semester_id": 10},
            program_semester_id="STRING",
            course_id="BIGINT",
        ),
        _table(
            "class", "dim", ("class_id",),
            lengths={"class_name": 100, "class_type": 20},
            class_id="BIGINT",
            class_name="STRING",
            last_modified_date="TIMESTAMP",
        ),
        _table(
            "address", "dim", ("address_id",),
            lengths={"ward": 100, "district": 100, "city": 100},
            address_id="BIGINT",
            ward="STRING",
            district="STRING",
            city="STRING",
        ),
        _table(
            "student", "dim", ("student_id",),
            foreign_keys=[
                ("address_id", "address", "address_id"),
            ],
            lengths={"student_id": 20, "student_name": 100, "class_name": 100, "edu_mail": 100,
                     "key_year": 100, "gender": 3},
            student_id="STRING",
            student_name="STRING",
            class_name="STRING",
            edu_mail="STRING",
            address_id="BIGINT",
            national_id="BIGINT",
            key_year="STRING",
            gender="STRING",
            student_dob="TIMESTAMP",
        ),
        _table(
            "instruction_fact", "fact", ("instruction_id",),
            foreign_keys=[
                ("program_semester_id", "program_semester", "program_semester_id"),
                ("course_id", "course", "course_id"),
                ("class_id", "class", "class_id"),
            ],
            lengths={"program_semester_id": 10, "instruction_status": 100},
            instruction_id="BIGINT",
            program_semester_id="STRING",
            course_id="BIGINT",
            class_id="BIGINT",
            is_required="BOOLEAN",
            num_student="BIGINT",
            num_pass_student="BIGINT",
            num_fail_student="BIGINT",
            avg_final_score="DOUBLE",
            instruction_status="STRING",
            instruction_allocate="TIMESTAMP",
            instruction_time_start="TIMESTAMP",
            instruction_time_end="TIMESTAMP",
            last_modified_date="TIMESTAMP",
            etl_date="TIMESTAMP",
        ),
        _table(
            "instruction_lecturer", "fact", ("instruction_lecturer_id",),
            foreign_keys=[
                ("instruction_id", "instruction_fact", "instruction_id"),
                ("lecturer_id", "lecturer", "lecturer_id"),
            ],
            lengths={"lecturer_type": 100},
            instruction_lecturer_id="BIGINT",
            instruction_id="BIGINT",
            lecturer_id="BIGINT",
            lecturer_type="STRING",
        ),
        _table(
            "enrollment_fact", "fact", ("enrollment_id",),
            foreign_keys=[
                ("instruction_id", "instruction_fact", "instruction_id"),
            ],
            lengths={"enrollment_status": 100},
            enrollment_id="BIGINT",
            instruction_id="BIGINT",
            enrollment_start_time="TIMESTAMP",
            enrollment_end_time="TIMESTAMP",
            enrollment_class="STRING",
            enrollment_status="STRING",
            last_modified_date="TIMESTAMP",
            etl_date="TIMESTAMP",
        ),
        _table(
            "enroll_student", "fact", ("student_id", "enrollment_id",),
            foreign_keys=[
                ("student_id", "student", "student_id"),
                ("enrollment_id", "enrollment_fact", "enrollment_id"),
            ],
            lengths={"student_id": 20},
            student_id="STRING",
            enrollment_id="BIGINT",
            enrollment_time="TIMESTAMP",
        ),
        _table(
            "score_fact", "fact", ("score_id",),
            foreign_keys=[
                ("instruction_id", "instruction_fact", "instruction_id"),
                ("student_id", "student", "student_id"),
            ],
            lengths={"student_id": 20, "academic_rank": 100},
            score_id="BIGINT",
            instruction_id="BIGINT",
            student_id="STRING",
            final_score="DOUBLE",
            final_score_4="DOUBLE",
            academic_rank="STRING",
            is_practice="BOOLEAN",
            last_modified_date="TIMESTAMP",
            etl_date="TIMESTAMP",
        ),
        _table(
            "score_detail", "fact", ("score_detail_id",),
            foreign_keys=[
                ("score_id", "score_fact", "score_id"),
            ],
            score_detail_id="BIGINT",
            score_id="BIGINT",
            regular_score_1="DOUBLE",
            regular_score_2="DOUBLE",
            regular_score_3="DOUBLE",
            mid_term_score="DOUBLE",
            final_term_score="DOUBLE",
            practice_score_1="DOUBLE",
            practice_score_2="DOUBLE",
            practice_score_3="DOUBLE",
            last_modified_date="TIMESTAMP",
        ),
    )
}

# Tables in an order that puts every parent before its children.
LAND_ORDER = list(TABLES)
WAREHOUSE_TABLES = [name for name, spec in TABLES.items() if spec.kind != "source"]

# The table groups that are refreshed together, and the cohort files.
DIMENSIONS = [name for name, spec in TABLES.items() if spec.kind == "dim"]
INSTRUCTION_FACTS = ["instruction_fact", "instruction_lecturer"]
ENROLLMENT_FACTS = ["enrollment_fact", "enroll_student"]
SCORE_FACTS = ["score_fact", "score_detail"]
COHORT_FILES = [
    "course", "program", "program_semester", "program_course", "student",
    *INSTRUCTION_FACTS, *ENROLLMENT_FACTS, *SCORE_FACTS,
]
