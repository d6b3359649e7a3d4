"""Distinct items of pieces of text, exchanged with shards that know them from all pieces.

A piece (some MB of texts) sends each distinct item, a short byte string, once to the shard that its hash names. A
shard merges what it gets and, later, answers each piece with values for its items, in the order they were sent. So an
item that stands in every text costs one entry for each piece, and nothing is broadcast.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, functions as F

from tallyforge.llm.grouped import by_key
from tallyforge.llm.words import Words, mixed, word_hashes
from tallyforge.session import stored

ITEMS_PER_SHARD = 1 << 21


def packed(*arrays: np.ndarray) -> bytes:
    return zstandard.compress(b"".join([np.array([a.size * a.itemsize for a in arrays], "<i8").tobytes(), *(a.tobytes() for a in arrays)]), 3)


def unpacked(blob: bytes, *kinds) -> list[np.ndarray]:
    data = zstandard.decompress(blob)
    ends = 8 * len(kinds) + np.cumsum([0, *np.frombuffer(data, "<i8", len(kinds))])
    return [np.frombuffer(data, kind, offset=a, count=(b - a) // np.dtype(kind).itemsize) for kind, a, b in zip(kinds, ends[:-1], ends[1:])]


def spelled_words(words: Words, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of some words, one after the other, and their lengths."""
    lengths = words.ends[at] - words.starts[at]
    within = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return words.data[np.repeat(words.starts[at], lengths) + within], lengths


def as_words(data: np.ndarray, lengths: np.ndarray) -> Words:
    ends = np.cumsum(lengths)
    return Words(data, ends - lengths, ends, np.array([0, len(lengths)]))


def shard_of(words: Words, shards: int) -> np.ndarray:
    return (mixed(word_hashes(words, seed=5)) % np.uint64(shards)).astype(np.int64)


def shards_for(parts: DataFrame, count: str) -> int:
    """How many shards keep each of them small; `count` has the items that a piece sends."""
    total = parts.agg(F.sum(count)).first()[0] or 0
    return max(int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // ITEMS_PER_SHARD + 1)


def vocabulary_of(parts: DataFrame, shards: int) -> DataFrame:
    """A row for each shard: `shard`, `words` (distinct items, with the sums of their counts), `members` (for each piece the places of its items), `tokens`, `types`.

    `parts` has `piece` and `words`: distinct items packed as bytes, lengths and counts. `tokens` adds up the counts, `types` counts the items that have one.
    """

    def send(batches):
        for batch in batches:
            for piece, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                data, lengths, train = unpacked(blob.as_py(), "u1", "<i4", "<i8")
                words = as_words(data, lengths.astype(np.int64))
                shard = shard_of(words, shards)
                order = np.argsort(shard, kind="stable")
                cuts = np.flatnonzero(np.diff(shard[order], prepend=-1, append=-1))
                out = []
                for a, b in zip(cuts[:-1], cuts[1:]):
                    spelled, long = spelled_words(words, order[a:b])
                    out.append((int(shard[order[a]]), piece, packed(spelled, long.astype("<i4"), train[order[a:b]])))
                kinds = (pa.int32(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kinds[i]) for i in range(3)], ["shard", "piece", "words"])

    member = pa.struct([("piece", pa.int64()), ("at", pa.binary())])

    def merge(batches):
        for shard, group in by_key(batches):
            sent = [unpacked(b, "u1", "<i4", "<i8") for b in group.column("words").to_pylist()]
            data, lengths, train = (np.concatenate([s[i] for s in sent]) for i in range(3))
            ends = np.cumsum(lengths, dtype=np.int64)
            offsets = pa.py_buffer(np.concatenate([[0], ends]))
            spelled = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, offsets, pa.py_buffer(data)])
            coded = spelled.dictionary_encode()  # equal words get equal numbers, by their bytes
            at, words = coded.indices.to_numpy(), coded.dictionary
            total = np.zeros(len(words), np.int64)
            np.add.at(total, at, train)
            long = np.array(pc.binary_length(words).to_numpy())
            blob = packed(np.frombuffer(b"".join(words.to_pylist()), np.uint8), long.astype("<i4"), total)
            cuts = np.cumsum([0, *(len(s[1]) for s in sent)])
            members = [{"piece": p, "at": packed(at[a:b].astype("<i4"))} for p, a, b in zip(group.column("piece").to_pylist(), cuts[:-1], cuts[1:])]
            columns = [pa.array([x], k) for x, k in ((shard, pa.int32()), (blob, pa.binary()), (members, pa.list_(member)), (total.sum(), pa.int64()), ((total > 0).sum(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "words", "members", "tokens", "types"])

    count = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sent = parts.select("piece", "words").mapInArrow(send, "shard int, piece long, words binary")
    merged = sent.repartition(count, "shard").sortWithinPartitions("shard").mapInArrow(
        merge, "shard int, words binary, members array<struct<piece:long,at:binary>>, tokens long, types long"
    )
    return stored(merged, "vocabulary")


def answers_by_piece(vocabulary: DataFrame, values: DataFrame, kinds: tuple[str, ...], steps: bool = False) -> DataFrame:
    """`piece` and `answers`: for each shard the values of the piece's items. `values` has, for each shard, `found`: arrays of `kinds`, one entry per item.

    With `steps` members hold the steps from place to place.
    """

    def run(batches):
        for batch in batches:
            for shard, members, found in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                arrays = unpacked(found.as_py(), *kinds)
                for member in members:
                    (at,) = unpacked(member["at"].as_py(), "<i4")
                    at = np.cumsum(at) if steps else at
                    mine = packed(*(a[at] for a in arrays))
                    yield pa.RecordBatch.from_arrays([pa.array([member["piece"].as_py()]), pa.array([shard], pa.int32()), pa.array([mine], pa.binary())], ["piece", "shard", "found"])

    each = vocabulary.select("shard", "members").join(values, "shard").select("shard", "members", "found").mapInArrow(run, "piece long, shard int, found binary")
    # Pieces of equal content have one name; then a shard answers twice with the same values.
    return each.groupBy("piece").agg(F.collect_list(F.struct("shard", "found")).alias("answers"))


def found_for(items: Words, shards: int, answers, kinds: tuple[str, ...]) -> list[np.ndarray]:
    """The values of a piece's items, in the piece's order, from its row of `answers_by_piece`."""
    return found_in(shard_of(items, shards), answers, kinds)


def found_in(shard: np.ndarray, answers, kinds: tuple[str, ...]) -> list[np.ndarray]:
    """As `found_for`, for items in these shards."""
    order = np.argsort(shard, kind="stable")
    out = [np.zeros(len(shard), kind) for kind in kinds]
    for part in answers:
        a, b = np.searchsorted(shard[order], [part["shard"].as_py(), part["shard"].as_py() + 1])
        for whole, mine in zip(out, unpacked(part["found"].as_py(), *kinds)):
            whole[order[a:b]] = mine
    return out
