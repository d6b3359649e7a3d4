"""Words of whole texts as numpy arrays, for use inside Arrow tasks.

A task gets texts as Arrow batches. The helpers here look at the UTF-8 bytes of many texts
at once, in pieces of a few MB, so that a task's memory doesn't follow the size of a batch;
a single text is never cut. Null texts are empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

PIECE_BYTES = 1 << 21
BATCH_BYTES = 1 << 22
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

_BYTES = np.arange(256)
#: Upper-case A-Z to lower case; all other bytes stay.
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)
#: Bytes of words that end at white space: all but space and 09-0D.
UNSPACED = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))
#: Bytes of words of lower-case letters, digits and everything beyond ASCII.
ALPHANUMERIC = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def bounded_batches(df: DataFrame) -> DataFrame:
    """Have the session hand texts to Python in batches of a few MB, whatever the number of rows, unless it sets a size of its own."""
    conf = df.sparkSession.conf
    if conf.get(_BATCH_SETTING, None) is None:
        conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    return df


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and where each row starts; the last entry is the end."""
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    if not len(offsets):
        return whole[:0], np.zeros(1, np.int64)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole rows of about `limit` bytes: first row, row after the last, bytes, offsets."""
    data, offsets = text_bytes(column)
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


@dataclass
class Words:
    """Words of some texts: byte positions, and `first[i]`, the first word of text i (one entry more than texts)."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """The text that each word is in."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def split(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> Words:
    """The words of texts that lie one after the other; `inside[b]` says that byte b is part of a word."""
    mask = inside[data]
    n = len(data)
    starts, ends = mask.copy(), mask.copy()
    if n:
        starts[1:] &= ~mask[:-1]
        ends[:-1] &= ~mask[1:]
        heads = offsets[:-1][offsets[:-1] < n]
        starts[heads] = mask[heads]
        tails = offsets[1:][offsets[1:] > 0] - 1
        ends[tails] = mask[tails]
    at = np.flatnonzero(starts)
    return Words(data, at, np.flatnonzero(ends) + 1, np.searchsorted(at, offsets))


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of x."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def word_hashes(words: Words, seed: int = 0) -> np.ndarray:
    """A 64-bit hash for each word, from its bytes alone."""
    padded = np.concatenate([words.data, np.zeros(8, np.uint8)])
    lanes = np.ndarray((len(words.data) + 1,), np.dtype("<u8"), padded, strides=(1,))
    length = words.ends - words.starts
    out = mixed(length.astype(np.uint64) * _ODD + np.uint64(seed))
    todo, done = np.arange(len(words)), 0
    while len(todo):
        left = length[todo] - done
        lane = lanes[words.starts[todo] + done]
        short = left < 8
        lane[short] &= (np.uint64(1) << (left[short] * 8).astype(np.uint64)) - np.uint64(1)
        out[todo] = mixed(out[todo] * _ODD + lane)
        todo, done = todo[left > 8], done + 8
    return out


def run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash for every run of `length` consecutive hashes, in order; empty if there are fewer."""
    count = len(hashes) - length + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    out, have, power, width = None, 0, hashes, 1
    while True:  # runs of 1, 2, 4, ... put together as the bits of `length` say
        if length & width:
            part = power[have : have + count]
            out = part if out is None else mixed(out * _ODD + part)
            have += width
        if 2 * width > length:
            return out if length > 1 else out.copy()
        power = mixed(power[:-width] * _ODD + power[width:])
        width *= 2


def run_in_text(words: Words, length: int) -> np.ndarray:
    """Whether the run of `length` words from each start (as `run_hashes` counts them) stays in one text."""
    owner = words.text_of()
    count = len(owner) - length + 1
    return owner[:count] == owner[length - 1 :] if count > 0 else np.empty(0, bool)


def joined(words: Words, inside: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words with one space between those of a text; new starts and ends."""
    mask = inside[words.data]
    keep = mask.copy()
    after = words.ends[words.ends < len(mask)]
    keep[after] = True  # the separator after a word, or the next text's first letter, kept anyway
    data = np.where(mask, words.data, np.uint8(0x20))
    place = np.cumsum(keep) - 1
    return data[keep].tobytes(), place[words.starts], place[words.ends - 1] + 1


def membership(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes may be in the filter made by `filters.build`; no false negatives."""
    size = np.uint64(len(bits) * 64)
    out = np.ones(len(hashes), bool)
    for value in (hashes, mixed(hashes + _ODD)):
        at = value % size
        out &= (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
    return out


def filter_places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The places a hash sets in a filter of `bits` bits."""
    return np.unique(np.concatenate([hashes, mixed(hashes + _ODD)]) % np.uint64(bits)).astype(np.int64)
