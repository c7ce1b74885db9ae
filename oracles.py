"""DuckDB statements that state the expected result of each registered query."""

from __future__ import annotations

import re

from lectern.plans import marts, registry
from lectern.plans.academic import BANDS, LOADED_AT
from lectern.specs import LAND_ORDER, TABLES, WAREHOUSE_TABLES

_LOADED = f"TIMESTAMP '{LOADED_AT}' AS updated_at"


def _bands(position: int, lowest: str) -> str:
    cases = " ".join(
        f"WHEN final_score >= {band[0]} THEN {band[position]!r}" for band in BANDS
    )
    return f"CASE WHEN final_score IS NULL THEN NULL {cases} ELSE {lowest} END"


# The academic tables as common table expressions over the given tables.
CTE = {
    "study": """
        SELECT l_partkey % 200 * 100 + l_suppkey % 25 AS instruction_id, o_custkey,
               max(l_quantity) FILTER (WHERE l_returnflag <> 'N') AS top_quantity,
               bool_or(l_returnflag = 'R') AS repeat_seat,
               bool_or(l_returnflag <> 'R') AS first_seat,
               min(o_orderdate) AS first_order, max(o_orderdate) AS last_order
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL""",
    "scored": """
        SELECT *, CASE WHEN top_quantity > 3 THEN floor(top_quantity * 4 / 5) / 4 END
                  AS final_score
        FROM study""",
    "employee": f"""
        SELECT s_suppkey + 1000 AS employee_id, s_name AS employee_name,
               CAST(NULL AS TIMESTAMP) AS day_of_birth, 'N' || s_nationkey AS nationality,
               'I' || s_suppkey AS insurance_id, {_LOADED} FROM supplier""",
    "lecturer": f"""
        SELECT s_suppkey AS lecturer_id, s_suppkey + 1000 AS employee_id,
               CASE WHEN s_acctbal > 5000 THEN 'PhD' ELSE 'MSc' END AS degree,
               CAST(s_nationkey AS BIGINT) AS number_of_exp, {_LOADED} FROM supplier""",
    "program": f"""
        SELECT 'P' || r_regionkey AS program_id, r_name AS class_of, {_LOADED} FROM region""",
    "program_semester": f"""
        SELECT 'P' || n_regionkey || '_' || n_nationkey AS program_semester_id,
               'P' || n_regionkey AS program_id, n_name AS semester_name,
               CAST(6 + n_nationkey % 4 AS BIGINT) AS total_credit,
               CAST(4 + n_nationkey % 2 AS BIGINT) AS required_credit,
               CAST(2 + n_nationkey % 4 - n_nationkey % 2 AS BIGINT) AS elective_credit,
               n_nationkey AS sem_key, {_LOADED} FROM nation""",
    "course": f"""
        SELECT course_id, 'Course ' || (course_id % 150) AS course_name,
               4203000000 + course_id % 150 AS course_code,
               CASE WHEN size % 2 = 0 THEN 'required' ELSE 'elective' END AS category,
               size % 5 AS total_credit, {_LOADED}
        FROM (SELECT p_partkey % 200 AS course_id, CAST(sum(p_size) AS BIGINT) AS size
              FROM part GROUP BY 1)""",
    "class": f"""
        SELECT CAST(n_nationkey AS BIGINT) AS class_id, 'Class ' || n_nationkey AS class_name,
               {_LOADED} FROM nation""",
    "address": f"""
        SELECT CAST(n_nationkey AS BIGINT) AS address_id, n_name AS district,
               'City ' || n_regionkey AS city, {_LOADED} FROM nation""",
    "student": f"""
        SELECT CAST(c_custkey AS VARCHAR) AS student_id, c_name AS student_name,
               c_mktsegment AS class_name, CAST(c_nationkey + 2 AS BIGINT) AS address_id,
               c_custkey * 7 + 1000 AS national_id,
               CASE WHEN c_acctbal < 0 THEN 'other' ELSE 'n/s' END AS gender, {_LOADED}
        FROM customer""",
    "instruction_fact": """
        SELECT instruction_id, program_semester_id, instruction_id // 100 AS course_id,
               instruction_id // 100 % 30 AS class_id, instruction_id % 2 = 0 AS is_required,
               num_student, num_pass_student, num_fail_student, avg_final_score,
               CASE WHEN instruction_id % 3 = 0 THEN 'cannot_open' ELSE 'completed' END
                   AS instruction_status,
               folded.updated_at AS last_modified_date, folded.updated_at
        FROM (SELECT instruction_id, count(*) AS num_student,
                     count(*) FILTER (WHERE final_score >= 4) AS num_pass_student,
                     count(*) FILTER (WHERE final_score < 4) AS num_fail_student,
                     avg(final_score) AS avg_final_score, max(last_order) AS updated_at
              FROM scored GROUP BY 1) folded
        JOIN program_semester ON sem_key = instruction_id % 100""",
    "instruction_lecturer": f"""
        SELECT (instruction_id * 10000000000 + lecturer_id) * 2
                   + CASE WHEN practice THEN 1 ELSE 0 END AS instruction_lecturer_id,
               instruction_id, lecturer_id,
               CASE WHEN practice THEN 'practice' ELSE 'theory' END AS lecturer_type, {_LOADED}
        FROM (SELECT DISTINCT l_partkey % 200 * 100 + l_suppkey % 25 AS instruction_id,
                     l_suppkey AS lecturer_id, l_returnflag = 'R' AS practice FROM lineitem)""",
    "enrollment_fact": """
        SELECT instruction_id * 2 + sitting AS enrollment_id, instruction_id,
               'closed' AS enrollment_status, last_modified_date, updated_at
        FROM instruction_fact CROSS JOIN (VALUES (0), (1)) sittings(sitting)""",
    "enroll_student": """
        SELECT CAST(o_custkey AS VARCHAR) AS student_id, instruction_id * 2 AS enrollment_id,
               first_order AS enrollment_time, first_order AS updated_at
        FROM study WHERE first_seat
        UNION ALL
        SELECT CAST(o_custkey AS VARCHAR), instruction_id * 2 + 1, first_order, first_order
        FROM study WHERE repeat_seat""",
    "score_fact": f"""
        SELECT instruction_id * 100000000000 + o_custkey AS score_id, instruction_id,
               CAST(o_custkey AS VARCHAR) AS student_id, final_score,
               CAST({_bands(1, "0.0")} AS DOUBLE) AS final_score_4,
               {_bands(2, "'F'")} AS academic_rank, repeat_seat AS is_practice,
               last_order AS last_modified_date, last_order AS updated_at
        FROM scored WHERE top_quantity IS NOT NULL""",
    "score_detail": """
        SELECT score_id AS score_detail_id, score_id, final_score AS final_term_score,
               last_modified_date, updated_at FROM score_fact""",
    "program_course": f"""
        SELECT DISTINCT program_semester_id, course_id, {_LOADED} FROM instruction_fact""",
    "offering": """
        SELECT i.instruction_id, i.instruction_status, i.num_student, i.avg_final_score,
               course_id, course_code, course_name, category, c.total_credit,
               program_semester_id, program_id, semester_name
        FROM instruction_fact i JOIN course c USING (course_id)
             JOIN program_semester p USING (program_semester_id)""",
    "seat": """
        SELECT student_id, student_name, o.* FROM enroll_student
        JOIN student USING (student_id) JOIN enrollment_fact USING (enrollment_id)
        JOIN offering o USING (instruction_id)""",
}


def with_tables(body: str, only: tuple[str, ...] = (), **extra: str) -> str:
    """Prefix a statement with the table expressions it uses, directly or through others.

    ``only`` limits the expressions; other names are then tables of the database.
    """
    known = {n: t for n, t in CTE.items() if not only or n in only} | extra
    order: list[str] = []

    def visit(text: str) -> None:
        for word in dict.fromkeys(re.findall(r'(?:FROM|JOIN)\s+"?(\w+)', text)):
            if word in known and word not in order:
                visit(known[word])
                if word not in order:
                    order.append(word)

    visit(body)
    parts = ", ".join(f'"{name}" AS ({known[name]})' for name in order)
    return f"WITH {parts} {body}" if parts else body


MART = {
    "student_performance": """
        SELECT student_id, student_name, program_id, semester_name,
               count(DISTINCT score_id) AS total_courses_enrolled,
               count(*) FILTER (WHERE final_score >= 4) AS total_courses_passed,
               CAST(sum(total_credit) AS BIGINT) AS total_credits_earned,
               -- in millionths: half a hundredth is added, whole hundredths remain
               coalesce((200 * CAST(sum(CAST(final_score_4 AS DECIMAL(12, 6))
                                        * CAST(total_credit AS DECIMAL(10, 0)) * 1000000)
                                    FILTER (WHERE final_score_4 >= 1) AS HUGEINT)
                         + 1000000 * CAST(sum(total_credit)
                                          FILTER (WHERE final_score_4 >= 1) AS HUGEINT))
                        // (2000000 * nullif(CAST(sum(total_credit)
                               FILTER (WHERE final_score_4 >= 1) AS HUGEINT), 0)), 0)
                   / 100.0::DOUBLE AS "GPA"
        FROM seat JOIN score_fact USING (student_id, instruction_id) GROUP BY ALL""",
    "course_performance": """
        SELECT course_code, course_name, semester_name,
               count(student_id) AS num_students_enrolled,
               count(*) FILTER (WHERE final_score >= 4) AS num_students_passed,
               100.0::DOUBLE * count(*) FILTER (WHERE final_score >= 4)
                   / nullif(count(student_id), 0) AS pass_rate,
               avg(final_score) AS average_final_score
        FROM (SELECT DISTINCT course_code, course_name, semester_name, student_id, final_score
              FROM offering JOIN score_fact USING (instruction_id)
              WHERE instruction_status = 'completed')
        GROUP BY ALL""",
    "lecturer_performance": """
        SELECT lecturer_id, employee_name AS lecturer_name, course_id, course_name,
               semester_name, count(DISTINCT instruction_id) AS num_classes_taught,
               avg(final_score) AS average_class_score
        FROM instruction_lecturer JOIN offering USING (instruction_id)
             JOIN score_fact USING (instruction_id)
             JOIN lecturer USING (lecturer_id) JOIN employee USING (employee_id)
        WHERE instruction_status = 'completed' GROUP BY ALL""",
    "instruction_aggregate": """
        SELECT instruction_id, course_id, course_name, program_id, semester_name,
               num_student AS num_students, avg_final_score
        FROM offering WHERE instruction_status = 'completed'""",
    "score_distribution": """
        SELECT course_id, course_name, program_id, semester_name, academic_rank,
               count(*) AS num_students_with_rank
        FROM score_fact JOIN offering USING (instruction_id) GROUP BY ALL""",
    "student_program_completion": """
        SELECT *, CASE WHEN total_required_credit_registered >= total_required_credit
                        AND total_elective_credit_registered >= total_elective_credit
                       THEN 'Completed' ELSE 'Not Completed' END AS completion_status
        FROM (
            SELECT s.student_id, s.student_name, s.program_id, r.total_required_credit,
                   r.total_elective_credit,
                   CAST(coalesce(sum(s.total_credit) FILTER (WHERE category = 'required'), 0)
                        AS BIGINT) AS total_required_credit_registered,
                   CAST(coalesce(sum(s.total_credit) FILTER (WHERE category = 'elective'), 0)
                        AS BIGINT) AS total_elective_credit_registered,
                   CAST(coalesce(sum(s.total_credit) FILTER
                        (WHERE category = 'required' AND final_score >= 4), 0)
                        AS BIGINT) AS total_required_credit_passed,
                   CAST(coalesce(sum(s.total_credit) FILTER
                        (WHERE category = 'elective' AND final_score >= 4), 0)
                        AS BIGINT) AS total_elective_credit_passed
            FROM seat s LEFT JOIN score_fact USING (student_id, instruction_id)
            JOIN (SELECT program_id,
                         CAST(sum(required_credit) AS BIGINT) AS total_required_credit,
                         CAST(sum(elective_credit) AS BIGINT) AS total_elective_credit
                  FROM program_semester GROUP BY 1) r ON r.program_id = s.program_id
            GROUP BY ALL)""",
    "student_performance_v1": """
        SELECT student_id, student_name, program_id, semester_name,
               count(DISTINCT score_id) AS total_courses_enrolled,
               count(*) FILTER (WHERE final_score >= 5) AS total_courses_passed,
               CAST(sum(total_credit) AS BIGINT) AS total_credits_earned,
               avg(final_score) AS "GPA"
        FROM seat JOIN score_fact USING (student_id, instruction_id) GROUP BY ALL""",
    "course_performance_v1": """
        SELECT course_id, course_name, semester_name,
               count(DISTINCT student_id) AS num_students_enrolled,
               count(*) FILTER (WHERE final_score >= 5) AS num_students_passed,
               100.0::DOUBLE * count(*) FILTER (WHERE final_score >= 5)
                   / nullif(count(DISTINCT student_id), 0) AS pass_rate,
               avg(final_score) AS average_final_score
        FROM offering JOIN score_fact USING (instruction_id) GROUP BY ALL""",
    "lecturer_performance_v1": """
        SELECT lecturer_id, employee_name AS lecturer_name, course_id, course_name,
               semester_name, count(DISTINCT instruction_id) AS num_classes_taught,
               avg(final_score) AS average_class_score
        FROM instruction_lecturer JOIN offering USING (instruction_id)
             JOIN score_fact USING (instruction_id)
             JOIN lecturer USING (lecturer_id) JOIN employee USING (employee_id)
        GROUP BY ALL""",
    "instruction_aggregate_v1": """
        SELECT instruction_id, course_id, course_name, program_id, semester_name,
               num_student AS num_students, avg_final_score
        FROM offering""",
    "score_histogram_v1": """
        SELECT course_id, course_name, semester_name,
               CASE WHEN final_score < 0 OR final_score > 4 OR final_score IS NULL
                    THEN 'Unknown'
                    WHEN final_score <= 1 THEN '0-1' WHEN final_score <= 2 THEN '1-2'
                    WHEN final_score <= 3 THEN '2-3' ELSE '3-4' END AS score_range,
               count(*) AS num_students_in_range
        FROM score_fact JOIN offering USING (instruction_id) GROUP BY ALL""",
}


def _declared(table: str, source: str | None = None, more: list[str] = []) -> str:
    """Declared columns of a table; those its source lacks as typed NULL."""
    names = {"BIGINT": "BIGINT", "STRING": "VARCHAR", "BOOLEAN": "BOOLEAN",
             "DOUBLE": "DOUBLE", "TIMESTAMP": "TIMESTAMP"}
    text = CTE[table]
    columns = [
        name if re.search(rf"\b{name}\b", text) else f"CAST(NULL AS {names[kind]}) AS {name}"
        for name, kind in TABLES[table].columns
    ]
    return f"SELECT {', '.join(columns + more)} FROM {source or table}"


_SCORES = _declared("score_fact")
_REVISED = f"""
    SELECT * REPLACE (least(final_score + 0.25, 10.0) AS final_score,
                      TIMESTAMP '{registry.END}' AS etl_date)
    FROM scores WHERE last_modified_date >= TIMESTAMP '{registry.OVERLAP}'"""
_FIRST = f"""
    SELECT * FROM scores WHERE last_modified_date <= TIMESTAMP '{registry.SPLIT}'"""
_NOW = registry.NOW.strftime("%Y-%m-%d %H:%M:%S.%f")
_EPOCH = int(registry.NOW.timestamp())


# Every mart of a run under its name; columns that a mart lacks are NULL.
_ALL_MARTS = " UNION ALL BY NAME ".join(
    f"SELECT '{name}' AS mart, * FROM ({MART[name]})" for name in marts.MARTS)


def _landed(tables: list[str]) -> str:
    """Source tables as landed from clean files, each under its name."""
    clean = {
        "student": """(SELECT * REPLACE (
            CASE WHEN address_id <= 24 THEN address_id END AS address_id,
            CASE WHEN length(gender) <= 3 THEN gender END AS gender) FROM student)""",
        "instruction_fact": """(SELECT * REPLACE (
            CASE WHEN class_id <= 24 THEN class_id END AS class_id) FROM instruction_fact)""",
    }
    return " UNION ALL BY NAME ".join(
        f"SELECT '{t}' AS table_name, * FROM ({_declared(t, clean.get(t), ['updated_at'])})"
        for t in tables)


def _between(window: tuple[str, str]) -> str:
    return f"updated_at BETWEEN TIMESTAMP '{window[0]}' AND TIMESTAMP '{window[1]}'"


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def _length_checks() -> str:
    return _union([
        f"""SELECT '{spec.name}' AS table_name,
                   concat_ws('/', {", ".join(spec.key)}) AS row_key,
                   '{column}' AS column_name, CAST({limit} AS INTEGER) AS max_length,
                   CAST(length({column}) AS INTEGER) AS length
            FROM "{spec.name}" WHERE length({column}) > {limit}"""
        for spec in TABLES.values() for column, limit in spec.lengths.items()
        if re.search(rf"\b{column}\b", CTE[spec.name])
    ])


def _reference_checks() -> str:
    return _union([
        f"""SELECT '{spec.name}' AS table_name, '{fk.column}' AS column_name,
                   CAST({fk.column} AS VARCHAR) AS value, count(*) AS n_rows
            FROM {spec.name}
            WHERE {fk.column} NOT IN (SELECT {fk.parent_column} FROM "{fk.table}")
            GROUP BY 3"""
        for spec in TABLES.values() for fk in spec.foreign_keys
    ])


_COHORTS = """
    SELECT *, root || '/K' || cohort || CASE state WHEN 'current' THEN '_current' ELSE '' END
              AS folder
    FROM (SELECT DISTINCT '/landing/' || o_custkey AS root, o_orderkey % 12 AS cohort,
                 CASE WHEN o_orderpriority = '1-URGENT' THEN 'current' ELSE 'plain' END AS state
          FROM orders)"""
_ROOTS = """
    SELECT root, count(*) FILTER (WHERE state = 'current') AS n_current,
           max(cohort) FILTER (WHERE state = 'current') AS closing,
           any_value(folder) FILTER (WHERE state = 'current') AS folder
    FROM cohorts GROUP BY root"""
_PROBLEMS = """
    SELECT root, closing,
           CASE WHEN n_current = 0 THEN 'no current batch'
                WHEN n_current > 1 THEN 'several current batches'
                WHEN EXISTS (SELECT 1 FROM cohorts c WHERE c.root = roots.root
                             AND c.cohort = closing AND c.state = 'plain')
                THEN 'closed name exists' END AS problem
    FROM roots"""


def _routes() -> str:
    names = [*LAND_ORDER, "other", "report", "SCORE_FACT"]
    tables = " ".join(
        f"WHEN contains(lower(file_name), '{t}') THEN '{t}'"
        for t in sorted(TABLES, key=len, reverse=True)
    )
    return f"""
        SELECT *, CASE WHEN extension = 'exe' THEN 'unknown type'
                       WHEN extension <> 'csv' THEN 'not csv'
                       WHEN table_name IS NULL THEN 'no table' ELSE 'accepted' END AS verdict
        FROM (SELECT file_name, lower(string_split(file_name, '.')[-1]) AS extension,
                     CASE {tables} END AS table_name
              FROM (SELECT {names!r}[o_orderkey % {len(names)} + 1] || '_' || o_orderkey
                           || '.' || ['csv', 'CSV', 'pdf', 'exe'][o_custkey % 4 + 1]
                           AS file_name FROM orders))"""


OPERATOR = {
    "extract_full": with_tables(_SCORES),
    "extract_window": with_tables(f"{_SCORES} WHERE {_between(registry.WINDOW)}"),
    "schema_cast": """
        SELECT o_orderkey AS order_id,
               CASE WHEN o_orderstatus <> 'O' THEN o_orderdate END AS placed_at,
               o_totalprice AS total,
               CASE o_orderstatus WHEN 'O' THEN true WHEN 'F' THEN false END AS is_open,
               nullif(o_orderpriority, '5-LOW') AS priority
        FROM orders""",
    "schema_conform": with_tables(_declared("employee")),
    "csv_ingest": """
        SELECT CAST(c_custkey AS VARCHAR) AS student_id, c_name AS student_name,
               CASE WHEN c_nationkey % 2 = 0 THEN c_mktsegment END AS class_name,
               CAST(NULL AS VARCHAR) AS edu_mail, CAST(NULL AS BIGINT) AS address_id,
               CASE WHEN c_nationkey % 2 = 0 THEN c_custkey END AS national_id,
               CAST(NULL AS VARCHAR) AS key_year, CAST(NULL AS VARCHAR) AS gender,
               CASE WHEN c_nationkey % 2 = 1 THEN TIMESTAMP '2001-05-17 00:00:00'
                    ELSE TIMESTAMP '2001-05-17 08:30:00' END AS student_dob
        FROM customer""",
    "staging_scan": with_tables(_declared("enrollment_fact")),
    "staging_counts": with_tables(
        "SELECT *, n_rows = 0 AS skipped FROM (" + _union([
            f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t} "
            f"WHERE {_between(registry.EARLY_WINDOW)}"
            for t in WAREHOUSE_TABLES
        ]) + ")"),
    "bulk_load": "SELECT * FROM customer",
    "merge_upsert": with_tables(
        """SELECT * FROM first_batch
           WHERE score_id NOT IN (SELECT score_id FROM revised)
           UNION ALL SELECT * FROM revised""",
        scores=_SCORES, revised=_REVISED, first_batch=_FIRST),
    "merge_metrics": with_tables(
        """SELECT count(*) FILTER (WHERE f.score_id IS NULL) AS inserted,
                  count(*) FILTER (WHERE f.score_id = r.score_id) AS updated,
                  count(*) FILTER (WHERE r.score_id IS NULL) AS unchanged,
                  count(*) AS total
           FROM first_batch f FULL JOIN revised r ON f.score_id = r.score_id""",
        scores=_SCORES, revised=_REVISED, first_batch=_FIRST),
    "merge_dedup": """
        SELECT * FROM lineitem QUALIFY row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                     l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
                     l_linestatus DESC) = 1""",
    "insert_ignore": f"""
        SELECT o_custkey, o_orderdate, o_orderkey, o_orderpriority,
               CASE WHEN o_orderstatus <> 'O' THEN o_orderdate
                    WHEN o_orderdate >= TIMESTAMP '{registry.WINDOW[0]}'
                    THEN TIMESTAMP '{_NOW}' END AS updated_at
        FROM orders QUALIFY row_number() OVER (
            PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""",
    "check_primary_key": """
        SELECT l_orderkey, l_linenumber, count(*) AS n_rows, 'duplicate key' AS problem
        FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
    "check_foreign_key": with_tables(_reference_checks()),
    "check_length": with_tables(_length_checks()),
    "route_files": _routes(),
    "current_batch": with_tables(
        """SELECT root, n_current, CASE WHEN n_current = 1 THEN closing END AS cohort,
                  CASE WHEN n_current = 1 THEN folder END AS folder,
                  CASE WHEN n_current = 0 THEN 'no current batch'
                       WHEN n_current > 1 THEN 'several current batches' END AS problem
           FROM roots""", cohorts=_COHORTS, roots=_ROOTS),
    "batch_rotate": with_tables(
        """SELECT root, cohort, folder, problem,
                  CASE WHEN problem IS NOT NULL THEN state
                       WHEN state = 'current' THEN 'plain'
                       WHEN cohort = closing + 1 THEN 'current' ELSE state END AS state
           FROM cohorts JOIN problems USING (root)""",
        cohorts=_COHORTS, roots=_ROOTS, problems=_PROBLEMS),
    "batch_window": f"""
        SELECT 'load_' || c_custkey AS pipeline,
               coalesce(max(o_orderdate) FILTER (WHERE o_orderpriority <> '1-URGENT'
                                                 AND o_orderstatus = 'F'),
                        (SELECT max(o_orderdate) FROM orders
                         WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'))
                   AS ext_from,
               date_trunc('second', TIMESTAMP '{_NOW}') AS ext_to
        FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey""",
    "archive_raw": f"""
        SELECT 'student' AS table_name, CAST({_EPOCH} AS BIGINT) AS ingest_epoch,
               'student_{_EPOCH}.csv' AS archived_as, c_custkey || ',' || c_name AS line
        FROM customer""",
    "mart_mirror": with_tables(MART["score_distribution"]),
    "serve_sorted": with_tables(MART["student_performance"]),
    "warehouse_bulk_run": with_tables(_ALL_MARTS),
    "warehouse_incremental_run": with_tables(_ALL_MARTS),
    "warehouse_first_cycle": with_tables(_ALL_MARTS),
    "land_bulk": with_tables(_landed(LAND_ORDER)),
    "land_batch": with_tables(_landed(LAND_ORDER)),
    "land_quoted_lines": """
        SELECT CAST(c_custkey AS VARCHAR) AS student_id,
               c_name || chr(10) || '"x", ,' || c_mktsegment AS student_name FROM customer""",
    "stream_upsert": """
        SELECT user_id, ts, event_id, event_type, value
        FROM (SELECT * FROM events QUALIFY row_number() OVER (
                  PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
        WHERE event_type <> 'error'""",
    "stream_land": with_tables(_landed(["student", "instruction_fact", "score_fact"])),
}


def oracle_sql() -> dict[str, str]:
    return {name: with_tables(body) for name, body in MART.items()} | OPERATOR
