"""Merge every micro-batch of a stream into a table, rewriting only the part that the batch touches.

The table is plain Parquet, partitioned by the low bits of a hash of the keys:

    <path>/table/bits=B/bucket=N     the rows whose low B bits are N
    <path>/staged/batch=K/           the touched buckets as batch K leaves them, and `done` once they are complete

A bucket that outgrows its bound is written back with more bits: each further bit splits it in two, and the rest of the table
stays as it is. So the number of buckets follows the table, bucket by bucket, and a batch of few keys rewrites few
rows however large the table is. What a task writes is bounded by rows: a bucket has as many writers as it needs.

A batch writes its buckets once, to the staging folder; complete files are then moved into place, and the folder goes. A batch that
is repeated after a crash finds what was staged and moves what is left, so it can end at any point. One writer at a time.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tallyforge.operators.dedup import keep_first
from tallyforge.operators.layout import kept
from tallyforge.session import file_system, remove

#: Rows of a bucket from which it is split, and rows that one task writes at most.
BUCKET_ROWS, TASK_ROWS = 4_000_000, 1_000_000
_BITS, _BUCKET = "bits", "bucket"
_MOST_BITS = 40


def _folders(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """Bits and number of each bucket below `path`, from the names of folders."""
    fs, root = file_system(spark, f"{path}/{_BITS}=*/{_BUCKET}=*")
    found = fs.globStatus(root) or []
    names = (re.search(rf"{_BITS}=(\d+)/{_BUCKET}=(\d+)$", str(status.getPath())) for status in found)
    return sorted((int(m[1]), int(m[2])) for m in names if m)


def _folder(path: str, bits: int, bucket: int) -> str:
    return f"{path}/{_BITS}={bits}/{_BUCKET}={bucket}"


def _exists(spark: SparkSession, path: str) -> bool:
    fs, root = file_system(spark, path)
    return fs.exists(root)


def read_upserted(spark: SparkSession, path: str) -> DataFrame:
    """The table as it is."""
    return spark.read.parquet(f"{path}/table").drop(_BITS, _BUCKET)


def _low(bits: Column) -> Column:
    """The low bits of the hash."""
    return F.col("_hash").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1)


def _located(rows: DataFrame, buckets: list[tuple[int, int]]) -> DataFrame:
    """The rows (with `_hash`) with the bucket that holds their key, or a new one where none does."""
    spark, most = rows.sparkSession, max((b for b, _ in buckets), default=0)
    depths = sorted({b for b, _ in buckets})
    known = spark.createDataFrame(buckets, f"{_BITS} int, {_BUCKET} long")
    # As many rows as the table has buckets: bounded by the rows of the table over those of a bucket.
    tried = rows.withColumn(_BITS, F.explode(F.array(*[F.lit(b) for b in depths or [0]]))).withColumn(_BUCKET, _low(F.col(_BITS)))
    held = tried.join(F.broadcast(known), [_BITS, _BUCKET])
    new = rows.withColumn(_BITS, F.lit(most)).withColumn(_BUCKET, _low(F.lit(most)))
    parents = [F.struct(F.lit(b).alias(_BITS), _low(F.lit(b)).alias(_BUCKET)) for b in depths]
    if not parents:
        return new
    listed = F.broadcast(known.select(F.struct(_BITS, _BUCKET).alias("_held")))
    for place in parents:  # a few depths at most, as hashes fill buckets evenly
        new = new.join(listed, place == F.col("_held"), "left_anti")
    return held.select(*new.columns).unionByName(new)


def _plan(new_rows: dict, old_rows: dict, bucket_rows: int, task_rows: int) -> list[tuple[int, int, int, int, int]]:
    """For each touched bucket its bits and number, its bits from now on, its first writer and how many it has."""
    plan, writer = [], 0
    for bits, bucket in sorted(new_rows):
        rows = new_rows[bits, bucket] + old_rows.get((bits, bucket), 0)
        after = bits
        while rows > bucket_rows << (after - bits) and after < _MOST_BITS:
            after += 1
        # Twice as many as the mean asks for: rows are dealt out by a hash.
        writers = max(1, -(-2 * rows // task_rows)) if rows > task_rows else 1
        plan.append((bits, bucket, after, writer, writers))
        writer += writers
    return plan


def _place(spark: SparkSession, path: str, staged: str) -> None:
    """Move the staged buckets into the table. What was moved before is not there any more, so this can be repeated."""
    fs, _ = file_system(spark, path)
    todo = _folders(spark, f"{staged}/rows")
    held = set(_folders(spark, f"{path}/table"))
    for bits, bucket in todo:
        for b in range(bits):  # the bucket that this one was split from
            parent = (b, bucket & ((1 << b) - 1))
            if parent in held:
                remove(spark, _folder(f"{path}/table", *parent))
                held.discard(parent)
    for bits, bucket in todo:
        target = _folder(f"{path}/table", bits, bucket)
        remove(spark, target)
        _, parent = file_system(spark, f"{path}/table/{_BITS}={bits}")
        fs.mkdirs(parent)
        if not fs.rename(file_system(spark, _folder(f"{staged}/rows", bits, bucket))[1], file_system(spark, target)[1]):
            raise OSError(f"could not move bucket {bucket} of {bits} bits to {target}")
    remove(spark, staged)


def upsert_batch(
    batch: DataFrame, batch_id: int | str, path: str, keys: Sequence[str], newest_first: Sequence[Column],
    bucket_rows: int = BUCKET_ROWS, task_rows: int = TASK_ROWS,
    combine: Callable[[DataFrame, DataFrame], DataFrame] | None = None, applied: Column | None = None,
) -> None:
    """Put the newest row of each key of a batch into the table, in place of the row that has the key.

    A NULL key matches nothing: the newest row of such a key is added by every batch. `bucket_rows` may change between
    batches; a bucket follows when it is next written. Columns named `bits`, `bucket` or with a leading underscore are reserved.

    `combine` makes the rows that follow from those of the touched buckets and those of the batch, by default the replacement
    described above. If repeating it would change more, give `applied`: it holds for rows that this batch has written.
    """
    spark = batch.sparkSession
    staged = f"{path}/staged/batch={batch_id}"
    if not _exists(spark, f"{staged}/done"):
        remove(spark, staged)
        newest = keep_first(batch, keys, *newest_first).withColumn("_hash", F.xxhash64(*keys))
        with kept(newest) as changes:  # recomputable: read for its places, its counts and its rows
            held = set(_folders(spark, f"{path}/table"))
            placed = _located(changes, sorted(held))
            new_rows = {(r[_BITS], r[_BUCKET]): r["n"] for r in placed.groupBy(_BITS, _BUCKET).agg(F.count("*").alias("n")).collect()}
            if not new_rows:
                return
            state, old_rows = placed, {}
            touched = [_folder(f"{path}/table", *place) for place in sorted(held.intersection(new_rows))]
            if touched:
                current = spark.read.option("basePath", f"{path}/table").parquet(*touched).withColumn(_BUCKET, F.col(_BUCKET).cast("long"))
                if applied is not None and current.where(applied).head(1):
                    return
                old_rows = {(r[_BITS], r[_BUCKET]): r["n"] for r in current.groupBy(_BITS, _BUCKET).agg(F.count("*").alias("n")).collect()}
                if combine is None:
                    left = current.join(changes.select(*keys), list(keys), "left_anti").withColumn("_hash", F.xxhash64(*keys))
                    state = left.select(*placed.columns).unionByName(placed)
                else:
                    made = combine(current.select(*batch.columns), changes.select(*batch.columns)).withColumn("_hash", F.xxhash64(*keys))
                    state = _located(made, sorted(held))
            plan = _plan(new_rows, old_rows, bucket_rows, task_rows)
            writers = plan[-1][3] + plan[-1][4]
            known = spark.createDataFrame(plan, f"{_BITS} int, {_BUCKET} long, _after int, _first int, _writers int")
            columns = batch.columns
            # Rows without a key are told apart by their other columns. Maps and variants have no hash.
            hashed = [f.name for f in batch.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
            laid = (
                state.join(F.broadcast(known), [_BITS, _BUCKET])
                .withColumn("_writer", F.col("_first") + F.pmod(F.xxhash64(F.lit("writer"), *hashed), "_writers").cast("int"))
                .select(*columns, F.col("_after").alias(_BITS), _low(F.col("_after")).alias(_BUCKET), "_writer")
            )
            laid = laid.repartitionById(writers, "_writer").drop("_writer")
            laid.write.mode("overwrite").partitionBy(_BITS, _BUCKET).parquet(f"{staged}/rows")
        spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{staged}/done")
    _place(spark, path, staged)


def upsert_stream(
    stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], newest_first: Sequence[Column],
    bucket_rows: int = BUCKET_ROWS, task_rows: int = TASK_ROWS,
) -> StreamingQuery:
    """Keep one row per key in the table at `path`, the newest of each batch."""

    def save(batch: DataFrame, batch_id: int) -> None:
        upsert_batch(batch, batch_id, path, keys, newest_first, bucket_rows, task_rows)

    return (
        stream.writeStream.foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
