"""STR7: what became of a trigger stream, recorded by a query listener.

A :class:`Lifecycle` follows one stream, which it names. It keeps the stream's
state, its totals (batches, messages, accepted and rejected triggers), its last
``keep`` progress records, and the error that ended it with the batch it ended
in. Accepted and rejected triggers are counted by an observation inside the
stream's own plan, so they cost no job. Records reach the driver only as
aggregates per batch: their number is bounded by ``keep``, not by the stream.

The error's batch is the one that the stream's handler had begun; an error
outside the handler (a source that fails) has the batch after the last one that
was reported, or 0.
"""

from __future__ import annotations

import threading
import uuid
from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from linecast.schemas import TRIGGER
from linecast.sources.triggers import ANALYSIS_JOB

OBSERVED = "triggers"


def observed(messages: DataFrame, job_type: str = ANALYSIS_JOB) -> DataFrame:
    """``messages`` unchanged, with the accepted and rejected triggers counted
    as they pass."""
    job = F.from_json(F.col("value").cast("string"), TRIGGER)["job_type"]
    accepted = F.coalesce(job == job_type, F.lit(False))
    return messages.observe(OBSERVED, F.count_if(accepted).alias("accepted"), F.count_if(~accepted).alias("rejected"))


class Lifecycle(StreamingQueryListener):
    """Listener of one stream; give it to :func:`linecast.streaming.runner.start`."""

    def __init__(self, name: str | None = None, keep: int = 100):
        self.name = name or f"triggers-{uuid.uuid4().hex}"
        self.state = "new"
        self.error: str | None = None
        self.failed_batch: int | None = None
        self.totals = {"batches": 0, "messages": 0, "accepted": 0, "rejected": 0}
        self.progress: deque[dict] = deque(maxlen=keep)
        self._run = None
        self._begun: int | None = None
        self._ended = threading.Event()

    def attach(self, spark: SparkSession) -> None:
        spark.streams.addListener(self)

    def detach(self, spark: SparkSession) -> None:
        spark.streams.removeListener(self)

    def begin(self, batch_id: int) -> None:
        """Called by the stream's handler before it works on a batch."""
        self._begun = batch_id

    def wait(self, seconds: float) -> bool:
        """Wait until the end of the stream was reported; False after the time."""
        return self._ended.wait(seconds)

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self._run = str(event.runId)
            self.state, self.error, self.failed_batch, self._begun = "running", None, None, None
            self._ended.clear()

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if str(p.runId) != self._run:
            return
        seen = p.observedMetrics.get(OBSERVED)
        row = {
            "batch_id": p.batchId, "messages": p.numInputRows, "at": p.timestamp, "took_ms": p.batchDuration,
            "accepted": seen["accepted"] if seen else 0, "rejected": seen["rejected"] if seen else 0,
        }
        if row["messages"] or seen:
            self.progress.append(row)
            self.totals["batches"] += 1
            for k in ("messages", "accepted", "rejected"):
                self.totals[k] += row[k]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) != self._run:
            return
        self.error = event.exception
        self.state = "failed" if self.error else "ended"
        if self.error:
            after = self.progress[-1]["batch_id"] + 1 if self.progress else 0
            self.failed_batch = self._begun if self._begun is not None else after
        self._ended.set()
