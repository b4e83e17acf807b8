"""Batch and step run log, watermarks and the step wrapper.

Log rows are never updated: starting and ending a batch or step each append
an event row, and the current state of a batch/step is its latest event
(``max_by`` on the event time). The tables stay tiny (a few rows per run).
Re-runs get a new ``attempt`` number, and batch totals add up the steps of
the latest attempt only, so a re-run does not double count.
"""

from __future__ import annotations

import datetime as dt
import uuid
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from vitrine.functions import lookups as L
from vitrine.plans import schemas
from vitrine.plans.warehouse import Warehouse

_STATUS_RANK = {"RUNNING": 0, "RERUN": 1, "SUCCESS": 2, "FAILED": 2}


def _now() -> dt.datetime:
    """The time now; aware, so a driver outside UTC writes the same instant."""
    return dt.datetime.now(dt.timezone.utc)


def latest_events(log: DataFrame, key: str) -> DataFrame:
    """Current state per ``key``: its latest event (ties: the later status)."""
    rank = F.when(F.col("status_col").isin("SUCCESS", "FAILED"), 2).when(F.col("status_col") == "RERUN", 1).otherwise(0)
    status = "status" if "status" in log.columns else "step_status"
    ordered = log.withColumn("status_col", F.col(status)).withColumn("_rank", rank)
    cols = [c for c in log.columns]
    picked = ordered.groupBy(key).agg(
        F.max_by(F.struct(*cols), F.struct(F.col("event_ts"), F.col("_rank"))).alias("_e")
    )
    return picked.select("_e.*")


def attempt_totals(steps: DataFrame) -> DataFrame:
    """Records read, written and rejected by the steps of each (batch, attempt)."""

    def total(c: str) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("long")

    return steps.groupBy("batch_id", "attempt").agg(
        total("records_in").alias("total_records"),
        total("records_out").alias("success_records"),
        total("records_rejected").alias("rejected_records"),
    )


@dataclass
class StepCounts:
    records_in: int = 0
    records_out: int = 0
    records_rejected: int = 0


class RunLog:
    def __init__(self, wh: Warehouse):
        self.wh = wh
        self.spark = wh.spark

    # ------------------------------------------------------------ reading

    def batch_events(self) -> DataFrame:
        return self.wh.read("etl_batch_log")

    def step_events(self) -> DataFrame:
        return self.wh.read("etl_step_log")

    def batches(self) -> DataFrame:
        """Current state of every batch."""
        return latest_events(self.batch_events(), "batch_id")

    def steps(self) -> DataFrame:
        """Current state of every step."""
        return latest_events(self.step_events(), "step_log_id")

    def _append(self, table: str, ddl: str, row: dict, partition_by: str | None = None) -> None:
        df = self.spark.createDataFrame([Row(**row)], ddl)
        self.wh.append(table, df.coalesce(1), partition_by)

    # ------------------------------------------------------------ batches

    def start_batch(
        self,
        batch_name: str | None = None,
        pipeline: str = L.PIPELINE_NAME,
        triggered_by: str = "SCHEDULER",
        batch_id: int | None = None,
        attempt: int = 1,
        status: str = "RUNNING",
    ) -> int:
        now = _now()
        if batch_id is None:
            batch_id = self.wh.claim_id("batch", self.wh.max_value(self.batch_events(), "batch_id"))
        name = batch_name or f"{L.BATCH_NAME_PREFIX}{now:%Y%m%d_%H%M%S}"
        self._append(
            "etl_batch_log",
            schemas.BATCH_LOG,
            dict(
                batch_id=batch_id, attempt=attempt, batch_name=name, pipeline_name=pipeline, start_dt=now,
                end_dt=None, status=status, total_records=0, success_records=0, rejected_records=0,
                error_message=None, triggered_by=triggered_by, event_ts=now,
            ),
        )
        return batch_id

    def batch(self, batch_id: int) -> Row | None:
        rows = self.batches().filter(F.col("batch_id") == batch_id).collect()
        return rows[0] if rows else None

    def end_batch(self, batch_id: int, status: str, err: str | None = None) -> Row:
        cur = self.batch(batch_id)
        if cur is None:
            raise KeyError(f"batch {batch_id} was never started")
        steps = self.steps().filter((F.col("batch_id") == batch_id) & (F.col("attempt") == cur["attempt"]))
        totals = attempt_totals(steps).first()
        totals = totals.asDict() if totals else dict(total_records=0, success_records=0, rejected_records=0)
        row = cur.asDict()
        row.update(
            end_dt=_now(), status=status, total_records=totals["total_records"],
            success_records=totals["success_records"], rejected_records=totals["rejected_records"],
            error_message=(err or None) and err[:4000], event_ts=_now(),
        )
        self._append("etl_batch_log", schemas.BATCH_LOG, row)
        return Row(**row)

    # -------------------------------------------------------------- steps

    def start_step(self, batch_id: int, step_name: str, attempt: int = 1) -> int:
        now = _now()
        step_id = self.wh.claim_id("step", self.wh.max_value(self.step_events(), "step_log_id"))
        self._append(
            "etl_step_log",
            schemas.STEP_LOG,
            dict(
                step_log_id=step_id, batch_id=batch_id, attempt=attempt, step_name=step_name, step_status="RUNNING",
                records_in=0, records_out=0, records_rejected=0, start_dt=now, end_dt=None, duration_secs=None,
                error_message=None, event_ts=now,
            ),
        )
        return step_id

    def end_step(self, step_id: int, status: str, counts: StepCounts | None = None, err: str | None = None) -> None:
        cur = self.steps().filter(F.col("step_log_id") == step_id).collect()[0].asDict()
        counts = counts or StepCounts()
        end = _now()
        cur.update(
            step_status=status, records_in=counts.records_in, records_out=counts.records_out,
            records_rejected=counts.records_rejected, end_dt=end,
            duration_secs=round((end - cur["start_dt"].astimezone()).total_seconds(), 1),  # collected as local time
            error_message=(err or None) and err[:4000], event_ts=end,
        )
        self._append("etl_step_log", schemas.STEP_LOG, cur)

    @contextmanager
    def step(self, batch_id: int, step_name: str, attempt: int = 1):
        """Log a step around a block: SUCCESS with its counts, or FAILED and re-raise."""
        step_id = self.start_step(batch_id, step_name, attempt)
        counts = StepCounts()
        try:
            yield counts
        except Exception as e:
            self.end_step(step_id, "FAILED", counts, err=f"{type(e).__name__}: {e}")
            raise
        self.end_step(step_id, "SUCCESS", counts)

    def log_reject(
        self, batch_id: int, table: str, key: str | None, reason: str, raw: str | None = None, attempt: int = 1
    ) -> None:
        """Append one reject row on its own, outside any step's write (reasons hold 1,000 characters, keys any length)."""
        self._append(
            "stg_rejected_records",
            schemas.REJECTS,
            dict(reject_id=str(uuid.uuid4()), source_table=table, source_key=key, reject_reason=reason[:1000],
                 raw_data=raw, attempt=attempt, reject_dt=_now(), etl_batch_id=batch_id),
            "etl_batch_id",
        )

    # --------------------------------------------------------- watermarks

    def watermarks(self) -> DataFrame:
        return self.wh.current("etl_watermark")

    def seed_watermarks(self) -> None:
        """Seed one row per feed with the default date, if none exist yet."""
        if self.wh.versions("etl_watermark"):
            return
        start = dt.datetime.fromisoformat(L.WATERMARK_DEFAULT_DATE)
        rows = [(L.WATERMARK_SOURCE, e, start, None, _now()) for e in L.WATERMARK_ENTITIES]
        self.wh.publish("etl_watermark", self.spark.createDataFrame(rows, schemas.WATERMARK).coalesce(1))

    def get_watermark(self, source: str, entity: str) -> dt.datetime:
        rows = (
            self.watermarks()
            .filter((F.col("source_name") == source) & (F.col("entity_name") == entity))
            .select("last_load_dt")
            .collect()
        )
        if rows and rows[0][0] is not None:
            return rows[0][0]
        return dt.datetime.fromisoformat(L.WATERMARK_DEFAULT_DATE)

    def set_watermarks(self, entities: list[str], batch_id: int, when: dt.datetime | None = None,
                       source: str = L.WATERMARK_SOURCE) -> None:
        """Upsert (source, entity) rows: matched rows get the new time and batch."""
        when = when or _now()
        new = self.spark.createDataFrame(
            [(source, e, when, batch_id, _now()) for e in entities], schemas.WATERMARK
        )
        self.wh.publish("etl_watermark", upsert_watermarks(self.watermarks(), new).coalesce(1))


def upsert_watermarks(current: DataFrame, new: DataFrame) -> DataFrame:
    """MERGE on (source_name, entity_name): new rows win, other rows are kept."""
    keys = ["source_name", "entity_name"]
    kept = current.join(new.select(*keys), keys, "left_anti")
    return kept.unionByName(new)
