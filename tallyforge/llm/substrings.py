"""Removal of word sequences that occur more than once, found by difference-cover anchors.

A difference cover modulo a period holds, for every shift, two places that far apart. Anchors, shorter
windows of words, are hashed only at places of a text that are in the cover. Two equal windows of `window` words
then have an equal anchor at the same distance from their starts, wherever they lie, so a window none of whose
anchors is shared can't be repeated. The others are extended to the whole window and compared as such.

Texts are held in pieces of a few MB. A piece sends its distinct hashes to shards; a shard answers with one bit
for each. However often a sequence occurs, each piece sends it once, and pairs of places never meet.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tallyforge.llm.grouped import by_key
from tallyforge.llm.words import UNSPACED, Words, bounded_batches, joined, mixed, pieces, run_hashes, run_in_text, split, word_hashes
from tallyforge.session import stored

WINDOW_WORDS, PERIOD = 35, 21
PIECE_BYTES = 1 << 22
WORDS_PER_SHARD = 1 << 21


def difference_cover(period: int) -> list[int]:
    """Places modulo `period` such that every shift is a difference of two of them; few, by adding what covers most new shifts."""
    cover, shifts = [0], {0}
    while len(shifts) < period:
        gain = {x: {(x - c) % period for c in cover} | {(c - x) % period for c in cover} for x in range(period) if x not in cover}
        best = max(gain, key=lambda x: (len(gain[x] - shifts), -x))
        cover.append(best)
        shifts |= gain[best]
    return sorted(cover)


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(blob: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(blob).read_all().combine_chunks().to_batches(max_chunksize=None)[0]


def _pieces(docs: DataFrame, key: str, text: str) -> DataFrame:
    """`piece`, a number, `rows`, keys and texts packed together, and `n_words`. Written once, so that every later step sees the same pieces."""

    def run(batches):
        for batch in batches:
            blobs, words = [], []
            for first, last, data, offsets in pieces(batch.column(1), PIECE_BYTES):
                part = pa.Table.from_batches([batch.slice(first, last - first)]).rename_columns(["key", "text"])
                blobs.append(_packed(part.set_column(1, "text", part["text"].cast(pa.large_string()))))
                words.append(len(split(data, offsets, UNSPACED)))
                if len(blobs) == 8:
                    yield pa.RecordBatch.from_arrays([pa.array(blobs, pa.binary()), pa.array(words, pa.int64())], ["rows", "n_words"])
                    blobs, words = [], []
            if blobs:
                yield pa.RecordBatch.from_arrays([pa.array(blobs, pa.binary()), pa.array(words, pa.int64())], ["rows", "n_words"])

    made = bounded_batches(docs).select(key, text).mapInArrow(run, "rows binary, n_words long")
    return stored(made.withColumn("piece", F.monotonically_increasing_id()), "text-pieces")


class _Hashes:
    """Distinct hashes of a piece, sorted by shard. `at` finds the place of each original in the sorted list."""

    def __init__(self, high: np.ndarray, low: np.ndarray, shards: int):
        shard = (high % np.uint64(shards)).astype(np.int64)
        order = np.lexsort((low, high, shard))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(high[order]) != 0) | (np.diff(low[order]) != 0)
        self.at = np.empty(len(order), np.int64)
        self.at[order] = np.cumsum(new) - 1
        self.high, self.low, self.shard = high[order][new], low[order][new], shard[order][new]
        self.repeated = np.bincount(self.at, minlength=int(new.sum())) > 1

    def messages(self, piece: int) -> list[tuple[int, int, bytes]]:
        """Shard, piece and hashes, 12 bytes each."""
        out = []
        cuts = np.flatnonzero(np.diff(self.shard, prepend=-1, append=-1))
        for a, b in zip(cuts[:-1], cuts[1:]):
            body = np.empty(b - a, _HASH)
            body["high"], body["low"] = self.high[a:b], self.low[a:b]
            out.append((int(self.shard[a]), piece, body.tobytes()))
        return out

    def shared(self, answers: list) -> np.ndarray:
        """For each original whether its hash occurs elsewhere, given the shards' answers (shard, bits)."""
        found = self.repeated.copy()
        for answer in answers:
            a, b = np.searchsorted(self.shard, [answer["shard"], answer["shard"] + 1])
            found[a:b] |= np.unpackbits(np.frombuffer(answer["bits"], np.uint8), count=b - a).astype(bool)
        return found[self.at]


_HASH = np.dtype([("high", "<u8"), ("low", "<u4")])


class _Piece:
    """The words of a piece, its anchors, and the windows that may be repeated."""

    def __init__(self, blob: bytes, window: int, period: int):
        self.batch = _unpacked(blob)
        ((_, _, data, offsets),) = pieces(self.batch.column(1), 1 << 62)
        self.words: Words = split(data, offsets, UNSPACED)
        self.hashes = word_hashes(self.words)
        self.window, self.period = window, period
        owner = self.words.text_of()
        place = np.arange(len(self.words)) - self.words.first[:-1][owner]
        length = window - period + 1
        in_cover = np.zeros(period, bool)
        in_cover[difference_cover(period)] = True
        long_enough = self.words.counts()[owner] >= window
        count = max(0, len(self.words) - length + 1)
        self.anchors = np.flatnonzero(run_in_text(self.words, length) & in_cover[place[:count] % period] & long_enough[:count])
        self.anchor_hashes = run_hashes(self.hashes, length)[self.anchors]

    def anchor_set(self, shards: int) -> _Hashes:
        # Six bytes are enough to find candidates.
        short = self.anchor_hashes >> np.uint64(16)
        return _Hashes(short, np.zeros(len(short), np.uint64), shards)

    def candidates(self, shared: np.ndarray) -> np.ndarray:
        """Starts of windows that hold a shared anchor."""
        if len(self.words) < self.window:
            return np.empty(0, np.int64)
        marks = np.zeros(len(self.words) + 1, np.int64)
        marks[self.anchors[shared] + 1] = 1
        before = np.cumsum(marks)
        starts = np.flatnonzero(run_in_text(self.words, self.window))
        return starts[before[starts + self.period] > before[starts]]

    def window_set(self, starts: np.ndarray, shards: int) -> _Hashes:
        high = run_hashes(self.hashes, self.window)[starts]
        low = run_hashes(mixed(self.hashes + np.uint64(77)), self.window)[starts] >> np.uint64(32)
        return _Hashes(high, low, shards)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[i]) for i in range(3)], names)


def _answers(messages: DataFrame, kind: str) -> DataFrame:
    """For each message (shard, piece, hashes) one bit per hash: whether another message holds it too."""

    def run(batches):
        for shard, group in by_key(batches):
            bodies = [np.frombuffer(b, _HASH) for b in group.column("hashes").to_pylist()]
            high, low = np.concatenate([b["high"] for b in bodies]), np.concatenate([b["low"] for b in bodies])
            order = np.lexsort((low, high))
            same = (np.diff(high[order]) == 0) & (np.diff(low[order]) == 0)
            shared = np.zeros(len(order), bool)
            shared[order[1:]] |= same
            shared[order[:-1]] |= same
            ends = np.cumsum([0] + [len(b) for b in bodies])
            rows = [(int(shard), p, np.packbits(shared[a:b]).tobytes()) for p, a, b in zip(group.column("piece").to_pylist(), ends[:-1], ends[1:])]
            yield _batch(rows, ["shard", "piece", "bits"])

    parts = int(messages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = messages.repartition(parts, "shard").sortWithinPartitions("shard").mapInArrow(run, "shard int, piece long, bits binary")
    return stored(found.withColumn("kind", F.lit(kind)), f"{kind}-answers")


def _with_answers(parts: DataFrame, answers: DataFrame) -> DataFrame:
    lists = [
        F.collect_list(F.when(F.col("kind") == kind, F.struct("shard", "bits"))).alias(kind) for kind in ("anchors", "windows")
    ]
    return parts.select("piece", "rows").join(answers.groupBy("piece").agg(*lists), "piece", "left")


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW_WORDS, period: int = PERIOD) -> DataFrame:
    """`key`, `n_words`, `n_removed` and `kept`, the words that stay, one space between them, for every row of `docs`.

    Words end at white space and are taken as they are. A window is `window` consecutive words of one text;
    every word of a window that also starts anywhere else, in the same text too, is removed; windows are judged on
    the input. So a repeated row of `window` words or more loses all of them. Null and empty texts have no words
    and keep ''. Null keys are allowed; other columns are ignored. Whole texts are compared.
    """
    if not 1 <= period <= window:
        raise ValueError("the period must be between 1 and the window")
    parts = _pieces(docs, key, text)
    total = parts.agg(F.sum("n_words")).first()[0] or 0
    shards = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // WORDS_PER_SHARD + 1)

    def anchors(batches):
        for batch in batches:
            for piece, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                yield _batch(_Piece(blob.as_py(), window, period).anchor_set(shards).messages(piece), ["shard", "piece", "hashes"])

    schema = "shard int, piece long, hashes binary"
    shared_anchors = _answers(parts.select("piece", "rows").mapInArrow(anchors, schema), "anchors")

    def windows(batches):
        for batch in batches:
            for piece, blob, found in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                own = _Piece(blob.as_py(), window, period)
                starts = own.candidates(own.anchor_set(shards).shared(found.as_py() or []))
                yield _batch(own.window_set(starts, shards).messages(piece), ["shard", "piece", "hashes"])

    candidates = _with_answers(parts, shared_anchors).select("piece", "rows", "anchors").mapInArrow(windows, schema)
    shared_windows = _answers(candidates, "windows")
    names = [key, "n_words", "n_removed", "kept"]

    def cut(batches):
        for batch in batches:
            for blob, found, more in zip(batch.column(1), batch.column(2), batch.column(3)):
                own = _Piece(blob.as_py(), window, period)
                starts = own.candidates(own.anchor_set(shards).shared(found.as_py() or []))
                starts = starts[own.window_set(starts, shards).shared(more.as_py() or [])]
                change = np.zeros(len(own.words) + 1, np.int64)
                change[starts] += 1
                change[starts + window] -= 1
                gone = np.cumsum(change[:-1]) > 0
                line, begin, end = joined(own.words, UNSPACED)
                first = own.words.first
                removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[first])
                kept = []
                for a, b, n in zip(first[:-1], first[1:], removed):
                    if not n:
                        kept.append(line[begin[a] : end[b - 1]] if b > a else b"")
                    else:
                        stay = np.flatnonzero(~gone[a:b]) + a
                        kept.append(b" ".join([line[s:e] for s, e in zip(begin[stay].tolist(), end[stay].tolist())]))
                columns = [own.batch.column(0), pa.array(own.words.counts()), pa.array(removed), pa.array(kept, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names)

    kind = T.StructType([docs.schema[key], *(T.StructField(n, T.LongType()) for n in names[1:3]), T.StructField("kept", T.StringType())])
    both = shared_anchors.unionByName(shared_windows)
    return _with_answers(parts, both).select("piece", "rows", "anchors", "windows").mapInArrow(cut, kind)


def op2_difference_cover_substring_dedup(spark, folder: str) -> DataFrame:
    """Every document without the sequences of 35 words that occur more than once."""
    return without_repeats(spark.read.parquet(f"{folder}/documents.parquet")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )
