"""Academic tables derived from the retail test tables.

``AcademicSource`` plays the operational database: it yields every table with its
``updated_at`` stamp and some undeclared columns.  ``AcademicWarehouse`` is the same data
conformed to the declared schemas.  All rows of the input tables take part.

Tables that need a shuffle of the input are written once per session to the shared folder
and read back: above all the join of lineitem and orders, folded to one row per student
and instruction, which feeds most of the others.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from threading import RLock

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lectern.operators.conform import conform
from lectern.session import is_complete, size_tasks, work_path
from lectern.specs import TABLES

LOADED_AT = "1995-01-01 00:00:00"

# Score from which a band starts, its 4-point value and its rank.
BANDS = [
    (9.0, 4.0, "A+"), (8.5, 3.8, "A"), (8.0, 3.5, "B+"), (7.0, 3.0, "B"),
    (6.5, 2.5, "C+"), (5.7, 2.0, "C"), (5.0, 1.5, "D+"), (4.0, 1.0, "D"),
]

_written: dict[tuple[str, str, str], str] = {}
_writing = RLock()


def _band(score: Column, position: int, lowest) -> Column:
    result = F.when(score.isNull(), F.lit(None))
    for band in BANDS:
        result = result.when(score >= band[0], F.lit(band[position]))
    return result.otherwise(F.lit(lowest))


class AcademicSource(Mapping):
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        size_tasks(spark, [f"{self.sf_dir}/{t}.parquet" for t in ("lineitem", "orders")])

    def __iter__(self) -> Iterator[str]:
        return iter(TABLES)

    def __len__(self) -> int:
        return len(TABLES)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise KeyError(name)
        return getattr(self, f"_{name}")()

    def _raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _stored(self, label: str, build) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.sf_dir, label)
        with _writing:  # tables are asked for by several threads of a run
            if key not in _written or not is_complete(self.spark, _written[key]):
                path = work_path(self.spark, label)
                build().write.parquet(path)
                _written[key] = path
        return self.spark.read.parquet(_written[key])

    def store(self) -> None:
        """Write the stored tables now, so that later queries only read them."""
        for name in ("instruction_fact", "course", "instruction_lecturer"):
            self[name]

    def study(self) -> DataFrame:
        """One row per student and instruction; ``top_quantity`` is NULL while unscored."""
        return self._stored("study", self._build_study)

    def _build_study(self) -> DataFrame:
        lines = self._raw("lineitem").select(
            "l_orderkey", "l_quantity", "l_returnflag",
            (F.col("l_partkey") % 200 * 100 + F.col("l_suppkey") % 25).alias("instruction_id"),
        )
        orders = self._raw("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        return (
            lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .groupBy("instruction_id", "o_custkey")
            .agg(
                F.max(F.when(F.col("l_returnflag") != "N", F.col("l_quantity")))
                .alias("top_quantity"),
                F.max(F.col("l_returnflag") == "R").alias("repeat_seat"),
                F.max(F.col("l_returnflag") != "R").alias("first_seat"),
                F.min("o_orderdate").alias("first_order"),
                F.max("o_orderdate").alias("last_order"),
            )
        )

    def _loaded(self) -> Column:
        return F.lit(LOADED_AT).cast("timestamp").alias("updated_at")

    def _employee(self) -> DataFrame:
        return self._raw("supplier").select(
            (F.col("s_suppkey") + 1000).alias("employee_id"),
            F.col("s_name").alias("employee_name"),
            F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("nationality"),
            F.concat(F.lit("I"), F.col("s_suppkey").cast("string")).alias("insurance_id"),
            F.col("s_acctbal").alias("salary"),
            self._loaded(),
        )

    def _lecturer(self) -> DataFrame:
        return self._raw("supplier").select(
            F.col("s_suppkey").alias("lecturer_id"),
            (F.col("s_suppkey") + 1000).alias("employee_id"),
            F.when(F.col("s_acctbal") > 5000, "PhD").otherwise("MSc").alias("degree"),
            F.col("s_nationkey").cast("bigint").alias("number_of_exp"),
            self._loaded(),
        )

    def _program(self) -> DataFrame:
        return self._raw("region").select(
            F.concat(F.lit("P"), F.col("r_regionkey").cast("string")).alias("program_id"),
            F.col("r_name").alias("class_of"),
            self._loaded(),
        )

    def _program_semester(self) -> DataFrame:
        key = F.col("n_nationkey").cast("bigint")
        program = F.concat(F.lit("P"), F.col("n_regionkey").cast("string"))
        return self._raw("nation").select(
            F.concat(program, F.lit("_"), key.cast("string")).alias("program_semester_id"),
            program.alias("program_id"),
            F.col("n_name").alias("semester_name"),
            (6 + key % 4).alias("total_credit"),
            (4 + key % 2).alias("required_credit"),
            (2 + key % 4 - key % 2).alias("elective_credit"),
            key.alias("sem_key"),
            self._loaded(),
        )

    def _course(self) -> DataFrame:
        return self._stored("course", self._build_course)

    def _build_course(self) -> DataFrame:
        size = F.col("size")
        return (
            self._raw("part")
            .groupBy((F.col("p_partkey") % 200).alias("course_id"))
            .agg(F.sum("p_size").alias("size"))
            .select(
                "course_id",
                F.concat(F.lit("Course "), (F.col("course_id") % 150).cast("string"))
                .alias("course_name"),
                (F.lit(4203000000) + F.col("course_id") % 150).alias("course_code"),
                F.when(size % 2 == 0, "required").otherwise("elective").alias("category"),
                (size % 5).alias("total_credit"),
                self._loaded(),
            )
        )

    def _class(self) -> DataFrame:
        key = F.col("n_nationkey").cast("bigint")
        return self._raw("nation").select(
            key.alias("class_id"),
            F.concat(F.lit("Class "), key.cast("string")).alias("class_name"),
            F.lit("theory").alias("class_type"),
            self._loaded(),
        )

    def _address(self) -> DataFrame:
        return self._raw("nation").select(
            F.col("n_nationkey").cast("bigint").alias("address_id"),
            F.col("n_name").alias("district"),
            F.concat(F.lit("City "), F.col("n_regionkey").cast("string")).alias("city"),
            self._loaded(),
        )

    def _student(self) -> DataFrame:
        return self._raw("customer").select(
            F.col("c_custkey").cast("string").alias("student_id"),
            F.col("c_name").alias("student_name"),
            F.col("c_mktsegment").alias("class_name"),
            (F.col("c_nationkey") + 2).cast("bigint").alias("address_id"),
            (F.col("c_custkey") * 7 + 1000).alias("national_id"),
            F.when(F.col("c_acctbal") < 0, "other").otherwise("n/s").alias("gender"),
            self._loaded(),
        )

    def _instruction_fact(self) -> DataFrame:
        return self._stored("instruction", self._build_instruction)

    def _build_instruction(self) -> DataFrame:
        key = F.col("instruction_id")
        score = self._score()
        folded = self.study().groupBy("instruction_id").agg(
            F.count("*").alias("num_student"),
            F.count(F.when(score >= 4, 1)).alias("num_pass_student"),
            F.count(F.when(score < 4, 1)).alias("num_fail_student"),
            F.avg(score).alias("avg_final_score"),
            F.max("last_order").alias("updated_at"),
        )
        semester = self._program_semester().select("sem_key", "program_semester_id")
        return (
            folded.withColumn("sem_key", key % 100)
            .join(semester, "sem_key")
            .select(
                "instruction_id", "program_semester_id",
                F.expr("instruction_id div 100").alias("course_id"),
                (F.expr("instruction_id div 100") % 30).alias("class_id"),
                (key % 2 == 0).alias("is_required"),
                "num_student", "num_pass_student", "num_fail_student", "avg_final_score",
                F.when(key % 3 == 0, "cannot_open").otherwise("completed")
                .alias("instruction_status"),
                F.col("updated_at").alias("last_modified_date"),
                "updated_at",
            )
        )

    def _score(self) -> Column:
        """0 to 10 in quarters, so sums are exact; the lowest quantities count as absent."""
        quantity = F.col("top_quantity")
        return F.when(quantity > 3, F.floor(quantity * 4 / 5) / 4)

    def _instruction_lecturer(self) -> DataFrame:
        return self._stored("listing", self._build_listing)

    def _build_listing(self) -> DataFrame:
        practice = F.col("l_returnflag") == "R"
        return (
            self._raw("lineitem")
            .select(
                (F.col("l_partkey") % 200 * 100 + F.col("l_suppkey") % 25)
                .alias("instruction_id"),
                F.col("l_suppkey").alias("lecturer_id"),
                F.when(practice, "practice").otherwise("theory").alias("lecturer_type"),
            )
            .distinct()
            .select(
                (
                    (F.col("instruction_id") * 10000000000 + F.col("lecturer_id")) * 2
                    + F.when(F.col("lecturer_type") == "practice", 1).otherwise(0)
                ).alias("instruction_lecturer_id"),
                "instruction_id", "lecturer_id", "lecturer_type",
                self._loaded(),
            )
        )

    def _enrollment_fact(self) -> DataFrame:
        """Two enrollments per instruction: a first sitting and a repeat sitting."""
        return self._instruction_fact().select(
            F.explode(F.array(F.col("instruction_id") * 2, F.col("instruction_id") * 2 + 1))
            .alias("enrollment_id"),
            "instruction_id",
            F.lit("closed").alias("enrollment_status"),
            "last_modified_date", "updated_at",
        )

    def _enroll_student(self) -> DataFrame:
        sittings = F.array_compact(
            F.array(
                F.when(F.col("first_seat"), F.col("instruction_id") * 2),
                F.when(F.col("repeat_seat"), F.col("instruction_id") * 2 + 1),
            )
        )
        return self.study().select(
            F.col("o_custkey").cast("string").alias("student_id"),
            F.explode(sittings).alias("enrollment_id"),
            F.col("first_order").alias("enrollment_time"),
            F.col("first_order").alias("updated_at"),
        )

    def _score_fact(self) -> DataFrame:
        score = F.col("final_score")
        return (
            self.study()
            .where(F.col("top_quantity").isNotNull())
            .withColumn("final_score", self._score())
            .select(
                (F.col("instruction_id") * 100000000000 + F.col("o_custkey")).alias("score_id"),
                "instruction_id",
                F.col("o_custkey").cast("string").alias("student_id"),
                "final_score",
                _band(score, 1, 0.0).alias("final_score_4"),
                _band(score, 2, "F").alias("academic_rank"),
                F.col("repeat_seat").alias("is_practice"),
                F.col("last_order").alias("last_modified_date"),
                F.col("last_order").alias("updated_at"),
            )
        )

    def _score_detail(self) -> DataFrame:
        return self._score_fact().select(
            F.col("score_id").alias("score_detail_id"), "score_id",
            F.col("final_score").alias("final_term_score"),
            "last_modified_date", "updated_at",
        )

    def _program_course(self) -> DataFrame:
        return (
            self._instruction_fact().select("program_semester_id", "course_id").distinct()
            .withColumn("updated_at", self._loaded())
        )


class AcademicWarehouse(AcademicSource):
    def __getitem__(self, name: str) -> DataFrame:
        return conform(super().__getitem__(name), TABLES[name])
