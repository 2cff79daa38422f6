"""What running queries report about themselves, kept in a table."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tickloom.config import OUTCOMES

PROGRESS_SCHEMA = (
    "query_id string, run_id string, query_name string, batch_id bigint, operator_index int, operator string, "
    "input_rows bigint, late_rows_dropped bigint, state_rows bigint, duration_ms bigint"
)
# What names one report of one stateful operator.
PROGRESS_KEYS = ["query_id", "run_id", "batch_id", "operator_index"]


def progress_rows(report: dict) -> list[tuple]:
    """One tuple per stateful operator of a micro-batch; one without operator for a stateless query."""
    return [
        (
            report["id"],
            report["runId"],
            report.get("name"),
            report["batchId"],
            index,
            operator.get("operatorName"),
            report.get("numInputRows", 0),
            operator.get("numRowsDroppedByWatermark", 0),
            operator.get("numRowsTotal", 0),
            report.get("durationMs", {}).get("triggerExecution"),
        )
        for index, operator in enumerate(report.get("stateOperators", []) or [{}])
    ]


OUTCOME_SCHEMA = "query_id string, run_id string, batch_id bigint, outcome string, trade_count bigint"


def outcome_rows(report: dict) -> list[tuple]:
    """One tuple per outcome that a micro-batch counted on its way (``observe_outcomes``)."""
    counts = report.get("observedMetrics", {}).get(OUTCOMES, {})
    return [(report["id"], report["runId"], report["batchId"], outcome, count) for outcome, count in counts.items()]


class ProgressLog(StreamingQueryListener):
    """Appends the progress of every micro-batch of the session's queries to a table.

    A query itself remembers its last hundred reports only. Reports are written
    ``every`` so many rows and when a query ends, so a driver that is lost loses
    fewer than ``every`` rows of the log, none of the data.
    """

    schema = PROGRESS_SCHEMA
    rows_of = staticmethod(progress_rows)

    def __init__(self, spark: SparkSession, path: str, every: int = 100):
        self.spark, self.path, self.every = spark, path, every
        self.held: list[tuple] = []
        self.ended: set[str] = set()
        self.change = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.held += self.rows_of(json.loads(event.progress.json))
        if len(self.held) >= self.every:
            self._write()

    def onQueryTerminated(self, event) -> None:
        self._write()
        with self.change:
            self.ended.add(str(event.runId))
            self.change.notify_all()

    def _write(self) -> None:
        rows, self.held = self.held, []
        if rows:
            self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(self.path)

    def wait_for(self, query: StreamingQuery, timeout: float = 60) -> None:
        """Until the reports of an ended query are in the table; they arrive after its end."""
        with self.change:
            if not self.change.wait_for(lambda: str(query.runId) in self.ended, timeout):
                raise TimeoutError(f"no report of the end of query {query.name}")


class OutcomeLog(ProgressLog):
    """Keeps the outcomes that queries count on their way; a stream's report of rejects without another pass."""

    schema = OUTCOME_SCHEMA
    rows_of = staticmethod(outcome_rows)


def outcome_report(spark: SparkSession, path: str) -> DataFrame:
    """Number of trades per outcome over all batches; a batch that was run again counts by its last run."""
    logged = spark.read.schema(OUTCOME_SCHEMA).parquet(path).dropDuplicates(["query_id", "batch_id", "outcome"])
    return logged.groupBy("outcome").agg(F.sum("trade_count").alias("trade_count")).where("trade_count > 0")


def progress_report(spark: SparkSession, path: str) -> DataFrame:
    """The logged reports, each once."""
    return spark.read.schema(PROGRESS_SCHEMA).parquet(path).dropDuplicates(PROGRESS_KEYS)


def late_rows_dropped(progress: DataFrame) -> DataFrame:
    """Rows that came after the watermark, over all logged batches."""
    return progress.agg(F.coalesce(F.sum("late_rows_dropped"), F.lit(0)).alias("late_rows_dropped"))


def query_totals(progress: DataFrame) -> DataFrame:
    """Per query: its batches, input and late rows, and the rows of state it holds after the last one."""
    batches = progress.groupBy("query_name", "run_id", "batch_id").agg(
        F.max("input_rows").alias("input_rows"),
        F.sum("late_rows_dropped").alias("late_rows_dropped"),
        F.sum("state_rows").alias("state_rows"),
    )
    return batches.groupBy("query_name").agg(
        F.sum("input_rows").alias("input_rows"),
        F.sum("late_rows_dropped").alias("late_rows_dropped"),
        F.max_by("state_rows", F.struct("batch_id", "run_id")).alias("state_rows"),
    )
