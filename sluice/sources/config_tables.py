"""Job definitions from the three config tables.

These are control data: one job's few rows are collected, never a data table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.spec import ConfigError, InferenceSpec, JobSpec, KafkaSpec, LakeSpec, StepSpec, TableSchema

# Table names, and the status of a row that is in use.
JOB_TABLE = "td_flink_job"
STEP_TABLE = "td_pipeline_processor"
FUNCTION_TABLE = "td_ai_function"
ACTIVE = 1


@dataclass(frozen=True)
class ConfigTables:
    jobs: DataFrame
    steps: DataFrame
    functions: DataFrame

    @classmethod
    def from_jdbc(cls, spark: SparkSession, url: str, properties: dict[str, str]) -> ConfigTables:
        """Read from a relational database; filters on name and status are pushed to it."""
        tables = (JOB_TABLE, STEP_TABLE, FUNCTION_TABLE)
        return cls(*(_lower_names(spark.read.jdbc(url, t, properties=properties)) for t in tables))

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str | None = None) -> ConfigTables:
        prefix = f"{database}." if database else ""
        return cls(*(spark.table(prefix + t) for t in (JOB_TABLE, STEP_TABLE, FUNCTION_TABLE)))

    def job_row(self, name: str) -> DataFrame:
        """The active row of a job, or none."""
        return self.jobs.filter((F.col("job_name") == name) & (F.col("status") == ACTIVE)).limit(1)

    def step_rows(self, name: str) -> DataFrame:
        """Active steps in order; inference steps carry their active function (or nulls) in ``fn``."""
        steps = self.steps.filter((F.col("job_name") == name) & (F.col("status") == ACTIVE))
        active = self.functions.filter(F.col("status") == ACTIVE)
        fn = active.select(
            F.col("function_id").alias("_fn_id"),
            F.struct(*(F.col(c) for c in active.columns)).alias("fn"),
        )
        match = (F.col("processor_type") == "ai-inference") & (F.col("function_id") == F.col("_fn_id"))
        return steps.join(fn, match, "left").orderBy("step_order").select(
            "step_order", "processor_type", "function_id", "processor_config", "fn"
        )

    def load(self, name: str) -> JobSpec:
        """The whole definition of an active job, checked."""
        found = self.job_row(name).collect()
        if not found:
            raise ConfigError(f"job {name!r} does not exist or is disabled")
        job = found[0].asDict()
        steps = []
        for row in self.step_rows(name).collect():
            function = None
            if row.processor_type == "ai-inference":
                if row.fn is None:
                    raise ConfigError(f"job {name!r}: function {row.function_id!r} does not exist or is disabled")
                function = InferenceSpec.from_row(row.fn.asDict())
            steps.append(StepSpec(row.processor_type, row.processor_config, function))
        return JobSpec(
            name=name,
            schema=TableSchema.from_json(job["schema_config"]),
            kafka=KafkaSpec.from_json(job["kafka_config"]) if job["kafka_config"] else None,
            lake=LakeSpec.from_json(job["paimon_config"]) if job["paimon_config"] else None,
            parallelism=job["parallelism"] or 1,
            steps=tuple(steps),
        )


def _lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*(c.lower() for c in df.columns))
