"""The audit trail of runs and the summaries read from it."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidyspark.functions.numbers import round_even

AUDIT_SCHEMA = (
    "run_id string, dataset_id string, entry int, record_id string, kind string, agent string, action string, "
    "reason string, tool string, status string, output string, timestamp timestamp"
)


@dataclass
class AuditTrail:
    """Decisions and stages of one run, a few rows each."""

    dataset_id: str
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    rows: list[tuple] = field(default_factory=list)

    def _append(self, kind: str, agent: str, action: str, reason: str, tool: str, status: str, output: str) -> None:
        self.rows.append(
            (
                self.run_id, self.dataset_id, len(self.rows) + 1, uuid.uuid4().hex, kind, agent, action, reason,
                tool, status, output, datetime.now(timezone.utc),
            )
        )

    def log(self, agent: str, action: str, reason: str, tool: str, status: str = "SUCCESS", output: str = "") -> None:
        self._append("decision", agent, action, reason, tool, status, output)

    def stage(self, name: str, detail: str, status: str = "SUCCESS") -> None:
        self._append("stage", name, "", detail, "", status, "")

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, AUDIT_SCHEMA)

    def append_to(self, spark: SparkSession, path: str) -> None:
        self.frame(spark).write.mode("append").parquet(path)


def run_log(audit: DataFrame, run_id: str) -> DataFrame:
    """Decisions of one run in the order they were taken."""
    return audit.filter((F.col("run_id") == run_id) & (F.col("kind") == "decision")).orderBy("entry")


def newest_first(audit: DataFrame) -> DataFrame:
    """Decisions of all runs, newest first."""
    return audit.filter(F.col("kind") == "decision").orderBy(F.desc("timestamp"), F.desc("run_id"), F.desc("entry"))


def run_summary(runs: DataFrame, recent: int = 5) -> DataFrame:
    """One row over a run history ``run_id, dataset_id, status, rows, quality, finished_at``:
    datasets, records, successful and failed runs, mean quality of the successful
    ones and the most recent of them, newest first.

    The recent runs are picked per task before they meet, so the history may be
    of any length.
    """
    success = F.col("status") == "SUCCESS"
    totals = runs.groupBy().agg(
        F.count_if(success).alias("successful_runs"),
        F.count_if(F.col("status") == "FAILED").alias("failed_runs"),
        F.coalesce(round_even(F.avg(F.when(success, F.col("quality"))), 1), F.lit(0.0)).alias("average_quality"),
        F.sum("rows").alias("total_records"),
    )
    datasets = runs.select("dataset_id").distinct().agg(F.count("*").alias("total_datasets"))
    latest = (
        runs.filter(success)
        .orderBy(F.desc("finished_at"), F.desc("run_id"))
        .limit(recent)
        .agg(
            F.sort_array(F.collect_list(F.struct("finished_at", "run_id")), asc=False)
            .getField("run_id")
            .alias("recent_runs")
        )
    )
    rows = totals.unionByName(datasets, allowMissingColumns=True).unionByName(latest, allowMissingColumns=True)
    return rows.agg(*[F.first(c, ignorenulls=True).alias(c) for c in rows.columns])
