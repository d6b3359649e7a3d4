"""Materialized views that are refreshed from new rows only.

A view keeps partial aggregates (`operators.mergeable`), one row per key, in a table of buckets (`streaming.upsert`). A refresh
aggregates the rows of each batch of new files, merges them with the stored rows of the same keys, and rewrites the
buckets that hold these; the rows seen before are not read again. What a view knows lies in its table, not in the state
of a streaming query, so it outlives the query's checkpoint, and sketches in it can be merged further.

Every stored row names the batch that last wrote it. A batch that is repeated after a crash finds its name and changes nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyforge.operators.mergeable import Measure, finished, merged, partials
from tallyforge.streaming.upsert import BUCKET_ROWS, TASK_ROWS, read_upserted, upsert_batch

#: Column of a stored row with the name of the batch that last wrote it.
WRITTEN_BY = "written_by"


def merge_rows(
    rows: DataFrame, name: str, number: int, path: str, keys: Sequence[str], measures: Mapping[str, Measure],
    bucket_rows: int = BUCKET_ROWS, task_rows: int = TASK_ROWS,
) -> None:
    """Merge new rows into the view at `path` as batch `number` of `name`. The same batch again changes nothing."""
    batch = F.lit(f"{name}:{number}")
    parts = partials(rows, keys, measures).withColumn(WRITTEN_BY, batch)

    def combine(stored_rows: DataFrame, new_rows: DataFrame) -> DataFrame:
        return merged(stored_rows.unionByName(new_rows), keys, measures).withColumn(WRITTEN_BY, batch)

    upsert_batch(
        parts, f"{name}-{number}", path, keys, [F.col(WRITTEN_BY)], bucket_rows, task_rows,
        combine=combine, applied=F.col(WRITTEN_BY) == batch,
    )


def refresh_view(
    stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], measures: Mapping[str, Measure], name: str = "refresh",
    bucket_rows: int = BUCKET_ROWS, task_rows: int = TASK_ROWS,
) -> StreamingQuery:
    """Take in what is new in a stream, then stop. A NULL key is a key.

    The checkpoint remembers which files were read. A query that starts with a new checkpoint goes on with the view as it
    is: give it a `name` of its own, and only files that no query before it has read.
    """

    def save(batch: DataFrame, number: int) -> None:
        merge_rows(batch, name, number, path, keys, measures, bucket_rows, task_rows)

    return stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_partials(spark: SparkSession, path: str) -> DataFrame:
    """The stored form of a view: its keys and measures, to merge to coarser keys or with other views."""
    return read_upserted(spark, path).drop(WRITTEN_BY)


def read_view(spark: SparkSession, path: str, measures: Mapping[str, Measure], keys: Sequence[str] | None = None) -> DataFrame:
    """The view's results, for its own keys or for some of them."""
    parts = read_partials(spark, path)
    return finished(parts if keys is None else merged(parts, keys, measures), measures)
