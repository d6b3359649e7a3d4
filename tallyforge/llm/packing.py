"""Vector bin packing of token sequences under limits on tokens, segments and loss-bearing tokens.

A bin (a training sequence) takes, one after the other, the example whose demand has the largest dot product
with what is left of the bin, each dimension as a share of its limit, among those that fit. Where none fits, or
the last segment is to be placed, an example is cut to fill the bin. Each task packs its own rows from a pool of
bounded size, so nothing is shuffled; what is left at its end goes to sequences whose lengths are powers of two.
"""

from __future__ import annotations

import base64
import zlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tallyforge.llm.words import bounded_batches

END_ID = 0
POOL = 512
TOKENIZER = "byte_bpe_50k"
_SEQUENCE_BITS = 33


@dataclass(frozen=True)
class Limits:
    """What one sequence can hold."""

    tokens: int = 1024
    segments: int = 64
    loss: int = 1024


@lru_cache(maxsize=2)
def _encoder(folder: str | None, name: str):
    """Text to ids, by the files of `folder`, or where their package has them on this machine.

    Both libraries give the same ids for ordinary text. The first is faster; the second takes the texts that it gives up on,
    and those that spell a special token, which is one id.
    """
    folder = folder or tokenizer_folder()
    with open(f"{folder}/{name}.tiktoken", "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    fast = tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sure = tokenizers.Tokenizer.from_file(f"{folder}/{name}.json")
    special = [token.content for token in sure.get_added_tokens_decoder().values()]

    def encode(text: str) -> list[int]:
        if not any(token in text for token in special):
            try:
                return fast.encode_ordinary(text)
            except BaseException as error:  # the library's panics aren't Exceptions
                if isinstance(error, (KeyboardInterrupt, SystemExit, MemoryError)):
                    raise
        return sure.encode(text, add_special_tokens=False).ids

    return encode


def tokenizer_folder() -> str:
    """Where the public tokenizers' files are on this machine."""
    return public_tokenizers.path("").rstrip("/")


class Packer:
    """Packs the examples of one task. `out` gets a tuple for each piece: example, start, length, loss tokens, sequence, offset."""

    def __init__(self, limits: Limits, first_sequence: int = 0, pool: int = POOL):
        self.limits, self.sequence, self.size = limits, first_sequence, pool
        self.scale = np.array([1 / limits.tokens, 1 / limits.segments, 1 / limits.loss])
        self.examples: list = [None] * (2 * pool)  # example, start, running count of its loss tokens
        self.demand = np.zeros((2 * pool, 3), np.int64)
        self.count = 0
        self.out: list[tuple] = []

    def add(self, example, loss: np.ndarray) -> None:
        """An example as the running count of its loss-bearing tokens, one entry per token."""
        start, running = 0, np.concatenate([[0], loss])
        while len(running) - 1 - start >= self.limits.tokens or running[-1] - running[start] > self.limits.loss:
            length = self._fitting(running, start, self.limits.tokens, self.limits.loss)
            self._place(example, start, length, running, 0)
            self.sequence += 1
            start += length
        if len(running) - 1 > start:
            self._hold(example, start, running)
        while self.count >= self.size:
            self._fill()

    def finish(self) -> None:
        """Pack what is held."""
        while self.count:
            if self.demand[: self.count, 0].sum() >= self.limits.tokens:
                self._fill()
            else:
                self._fill(1 << (int(self.demand[: self.count, 0].sum()).bit_length() - 1))

    @staticmethod
    def _fitting(running, start: int, tokens: int, loss: int) -> int:
        """How many tokens from `start` keep both limits."""
        return min(tokens, int(np.searchsorted(running, running[start] + loss, side="right")) - 1 - start)

    def _hold(self, example, start: int, running) -> None:
        self.examples[self.count] = (example, start, running)
        self.demand[self.count] = len(running) - 1 - start, 1, running[-1] - running[start]
        self.count += 1

    def _take(self, at: int):
        found = self.examples[at]
        self.count -= 1
        self.examples[at], self.demand[at] = self.examples[self.count], self.demand[self.count]
        self.examples[self.count] = None
        return found

    def _place(self, example, start: int, length: int, running, offset: int) -> None:
        self.out.append((example, start, length, int(running[start + length] - running[start]), self.sequence, offset))

    def _fill(self, tokens: int | None = None) -> None:
        """One sequence of at most `tokens` tokens."""
        left = np.array([tokens or self.limits.tokens, self.limits.segments, self.limits.loss])
        offset = 0
        while self.count and left[0] and left[1]:
            demand = self.demand[: self.count]
            likeness = (demand * self.scale) @ (left * self.scale)
            fits = (demand <= left).all(axis=1)
            if left[1] == 1 or not fits.any():
                # The last segment, or none fits: cut the example that suits best, if it can fill what is left.
                longer = demand[:, 0] >= left[0]
                at = int(np.where(longer, likeness, likeness - 1e9).argmax())
            else:
                at = int(np.where(fits, likeness, -1.0).argmax())
            example, start, running = self._take(at)
            length = self._fitting(running, start, min(int(left[0]), len(running) - 1 - start), int(left[2]))
            if length <= 0:  # no room for its loss-bearing tokens
                self._hold(example, start, running)
                break
            self._place(example, start, length, running, offset)
            left -= [length, 1, int(running[start + length] - running[start])]
            offset += length
            if start + length < len(running) - 1:
                self._hold(example, start + length, running)
        self.sequence += 1


def pack(examples: DataFrame, key: str, parts: str, limits: Limits = Limits(), name: str = TOKENIZER, folder: str | None = None) -> DataFrame:
    """Pieces of all examples: `key`, `start`, `length`, `ids_crc32`, `doc_tokens`, `loss_tokens`, `sequence_id`, `offset`.

    `parts` is an array of (text, loss): the texts of an example in order, and whether their tokens bear loss,
    such as the answers in instruction data. The tokens of an example end with the id 0, which bears loss if its
    last part does. Null texts are empty, a null or empty array is one empty text without loss. Each token lies in exactly one piece.
    Limits must be positive. Null keys and repeated rows are examples like any other; an empty table gives no pieces; other columns are ignored.
    Very long texts are encoded whole; a special token that a text spells is one id. `folder` holds the tokenizer's files on each
    machine. Sequence ids hold the task in their upper bits: give rows that have
    been read from files, so that a repeated task packs the same rows.
    """
    if min(limits.tokens, limits.segments, limits.loss) < 1:
        raise ValueError("limits must be positive")
    kind = examples.schema[key].dataType.simpleString()
    names = [key, "start", "length", "ids_crc32", "doc_tokens", "loss_tokens", "sequence_id", "offset"]

    def run(batches):
        encode = _encoder(folder, name)
        packer = Packer(limits, TaskContext.get().partitionId() << _SEQUENCE_BITS)

        def pieces():
            columns: list[list] = [[] for _ in range(7)]
            keys = []
            for (value, ids), start, length, loss, sequence, offset in packer.out:
                keys.append(value)
                crc = zlib.crc32(ids[start : start + length].tobytes())
                for column, x in zip(columns, (start, length, crc, len(ids), loss, sequence, offset)):
                    column.append(x)
            packer.out.clear()
            return pa.RecordBatch.from_arrays([pa.array(keys, key_type), *(pa.array(c, pa.int64()) for c in columns)], names)

        key_type = None
        for batch in batches:
            key_type = batch.schema.field(0).type
            for value, row in zip(batch.column(0), batch.column(1)):
                ids, loss = [], []
                for part in row.as_py() or [{"text": None, "loss": False}]:
                    found = encode((part or {}).get("text") or "")
                    ids += found
                    loss.append((len(found), bool((part or {}).get("loss"))))
                ids = np.array([*ids, END_ID], "<u4")
                bears = np.repeat([flag for _, flag in loss] + [loss[-1][1]], [n for n, _ in loss] + [1])
                packer.add((value.as_py(), ids), np.cumsum(bears))
                if len(packer.out) >= 1 << 14:
                    yield pieces()
        packer.finish()
        if packer.out:
            yield pieces()

    longs = ", ".join(f"`{c}` long" for c in names[1:])
    return bounded_batches(examples).select(key, parts).mapInArrow(run, f"`{key}` {kind}, {longs}")


def pack_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """Pieces of plain texts, whose tokens all bear loss. See `pack`."""
    return pack(docs.select(key, F.array(F.struct(F.col(text).alias("text"), F.lit(True).alias("loss"))).alias("parts")), key, "parts", limits)


def op5_vector_bin_packing(spark, folder: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    return pack_documents(spark.read.parquet(f"{folder}/documents.parquet"))
