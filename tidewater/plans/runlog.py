"""The library's own log: runs, datasets built, expectations counted, streams' progress; in the form that the dashboards read."""

from __future__ import annotations

import contextlib
import datetime as dt
import json
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

EVENTS = "event_time timestamp_ntz, event_type string, level string, message string, pipeline_id string, details string"
RUNS = "job_id string, run_id long, run_name string, result_state string, termination_code string, period_start_time timestamp_ntz, period_end_time timestamp_ntz"


def _now() -> dt.datetime:
    return dt.datetime.now(dt.UTC).replace(tzinfo=None)


class RunLog:
    """Events and runs of one pipeline, appended to two tables below ``path``.

    Events are held on the driver and written by ``flush``, at the latest when
    their run ends: a few rows for each dataset and batch.
    """

    def __init__(self, spark: SparkSession, path: str, pipeline_id: str):
        self.spark, self.path, self.pipeline_id = spark, path.rstrip("/"), pipeline_id
        self._events: list[tuple] = []

    def event(self, event_type: str, message: str, level: str = "INFO", details: dict | None = None) -> None:
        self._events.append((_now(), event_type, level, message, self.pipeline_id, json.dumps(details or {})))

    def built(self, dataset: str, seconds: float, rows: int, expectations: list[tuple[str, int, int]]) -> None:
        """A dataset was written: its rows, and of each expectation how many rows passed and failed."""
        counts = [{"name": n, "dataset": dataset, "passed_records": p, "failed_records": f} for n, p, f in expectations]
        progress = {"flow_progress": {"metrics": {"num_output_rows": rows, "seconds": round(seconds, 3)}, "data_quality": {"expectations": counts}}}
        self.event("flow_progress", f"{dataset}: {rows} rows", details=progress)

    def flush(self) -> None:
        events, self._events = self._events, []
        if events:
            self.spark.createDataFrame(events, EVENTS).coalesce(1).write.mode("append").parquet(f"{self.path}/events")

    @contextlib.contextmanager
    def run(self, name: str) -> Iterator[None]:
        """A run of the pipeline: its times and how it ended are noted, also if it fails."""
        began, state, code = _now(), "SUCCEEDED", "SUCCESS"
        self.event("create_update", f"{name} begins")
        try:
            yield
        except BaseException as e:
            state, code = "FAILED", "RUN_EXECUTION_ERROR"
            self.event("update_progress", f"{type(e).__name__}: {str(e)[:2000]}", "ERROR")
            raise
        finally:
            self.flush()
            row = (self.pipeline_id, uuid.uuid4().int >> 65, name, state, code, began, _now())
            self.spark.createDataFrame([row], RUNS).write.mode("append").parquet(f"{self.path}/runs")

    def _table(self, kind: str, schema: str) -> DataFrame:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}")
        there = at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{kind}") if there else self.spark.createDataFrame([], schema)

    def events(self) -> DataFrame:
        return self._table("events", EVENTS)

    def runs(self) -> DataFrame:
        return self._table("runs", RUNS)

    def source(self, rest: Callable[[str], DataFrame]) -> Callable[[str], DataFrame]:
        """Relations by name, in which the dashboards' event log and run timeline are this log."""
        return lambda name: self.events() if name == "pipeline_event_log" else self.runs() if name == "job_run_timeline" else rest(name)

    def listener(self) -> StreamingQueryListener:
        """A listener that notes every batch of every stream of the session, and streams that end with an error; add it with ``spark.streams.addListener``."""
        log = self

        class Progress(StreamingQueryListener):
            def onQueryStarted(self, event) -> None:
                log.event("stream_started", f"stream {event.name or event.id}")

            def onQueryProgress(self, event) -> None:
                p = event.progress
                details = {"stream_progress": {"id": str(p.id), "batch": p.batchId, "num_input_rows": p.numInputRows, "milliseconds": dict(p.durationMs or {}).get("triggerExecution")}}
                log.event("stream_progress", f"stream {p.name or p.id}, batch {p.batchId}: {p.numInputRows} rows", details=details)

            def onQueryIdle(self, event) -> None:
                pass

            def onQueryTerminated(self, event) -> None:
                log.event("stream_ended", f"stream {event.id}" + (f": {event.exception[:2000]}" if event.exception else ""), "ERROR" if event.exception else "INFO")

        return Progress()
