"""Start, follow and stop streaming queries."""

from __future__ import annotations

import threading
from collections import defaultdict
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tallyforge.sources.states import write_state


def _trigger(every: str | None) -> dict:
    return {"processingTime": every} if every else {"availableNow": True}


def append_to_files(
    stream: DataFrame, path: str, checkpoint: str, every: str | None = None, name: str | None = None
) -> StreamingQuery:
    """Append finished rows to Parquet. Reads what is there and stops, or runs `every` interval."""
    writer = stream.writeStream.format("parquet").outputMode("append")
    if name:
        writer = writer.queryName(name)
    return writer.option("checkpointLocation", checkpoint).trigger(**_trigger(every)).start(path)


def replace_result(
    stream: DataFrame, path: str, checkpoint: str, every: str | None = None, name: str | None = None
) -> StreamingQuery:
    """Complete mode: each trigger writes the whole result as a state, numbered as the batch; a repeated one replaces itself."""

    def save(batch: DataFrame, batch_id: int) -> None:
        write_state(batch, path, batch_id, "replace")

    writer = stream.writeStream.outputMode("complete").foreachBatch(save)
    if name:
        writer = writer.queryName(name)
    return writer.option("checkpointLocation", checkpoint).trigger(**_trigger(every)).start()


def update_with(
    stream: DataFrame, save: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Update mode: `save` gets the changed rows of each trigger."""
    return (
        stream.writeStream.outputMode("update").foreachBatch(save)
        .option("checkpointLocation", checkpoint).trigger(**_trigger(every)).start()
    )


def finish(query: StreamingQuery) -> StreamingQuery:
    """Wait until the query has read what is available, then stop it. Raises if it failed."""
    try:
        query.awaitTermination()
    finally:
        query.stop()
    return query


def finish_all(start: Mapping[str, Callable[[], StreamingQuery]], at_once: bool = True) -> dict[str, StreamingQuery]:
    """Run several queries, side by side or one after the other. Each needs its own checkpoint."""
    if not at_once:
        return {name: finish(begin()) for name, begin in start.items()}
    running = {name: begin() for name, begin in start.items()}
    try:
        for query in running.values():
            query.awaitTermination()
    finally:
        for query in running.values():
            query.stop()
    return running


class Totals(StreamingQueryListener):
    """Adds up what the queries of a session report, trigger by trigger.

    A query itself remembers its last triggers only. Here each one is counted as it happens, and what is held does
    not grow with their number.
    """

    def __init__(self):
        self._found: dict[str, dict] = defaultdict(
            lambda: {"triggers": 0, "input_rows": 0, "late_rows": 0, "observed": defaultdict(lambda: defaultdict(int))}
        )
        self._ended: dict[str, threading.Event] = defaultdict(threading.Event)

    def onQueryStarted(self, event) -> None:
        self._ended[str(event.runId)].clear()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        entry, total = event.progress, self._found[str(event.progress.runId)]
        total["triggers"] += 1
        total["input_rows"] += entry.numInputRows
        total["late_rows"] += sum(op.numRowsDroppedByWatermark for op in entry.stateOperators)
        for name, row in (entry.observedMetrics or {}).items():
            for metric, value in row.asDict().items():
                total["observed"][name][metric] += value or 0

    def onQueryTerminated(self, event) -> None:
        self._ended[str(event.runId)].set()

    def of(self, query: StreamingQuery, wait: float = 60.0) -> dict:
        """Triggers, rows read, rows dropped as late and sums of observed metrics of a query that has ended."""
        if not self._ended[str(query.runId)].wait(wait):
            raise TimeoutError("the query has not reported its end")
        total = self._found[str(query.runId)]
        return {**total, "observed": {name: dict(metrics) for name, metrics in total["observed"].items()}}

    def observed(self, name: str, wait: float = 60.0) -> dict[str, int]:
        """Sums of one observation over all queries that have ended by now."""
        for ended in list(self._ended.values()):
            ended.wait(wait)
        sums: dict[str, int] = defaultdict(int)
        for total in list(self._found.values()):
            for metric, value in total["observed"].get(name, {}).items():
                sums[metric] += value
        return dict(sums)


@contextmanager
def counted(spark: SparkSession) -> Iterator[Totals]:
    """Count the triggers of all queries that start inside."""
    totals = Totals()
    spark.streams.addListener(totals)
    try:
        yield totals
    finally:
        spark.streams.removeListener(totals)


def active_names(spark: SparkSession) -> Sequence[str]:
    return [query.name or str(query.id) for query in spark.streams.active]


def stop_all(spark: SparkSession) -> None:
    for query in spark.streams.active:
        query.stop()
