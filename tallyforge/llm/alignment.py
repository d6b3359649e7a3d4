"""Alignment of two tokenizers over the same text, by galloping intersection of the ends of their tokens.

Both lists of token ends are byte offsets in one text. The shorter drives: each of its ends is found in the longer by
an exponential search from where its left neighbour was found, then a binary search. Ends that both have cut the
text into groups; the ranks of two neighbouring ends give the range of tokens that a token overlaps. Texts of a piece are
laid end to end, as the end of a text is an end in both.

How many documents hold a pair of ids linked is counted by Spark: a piece of texts reports each distinct pair once, with
its number of documents, and gets back one number for each, so a pair that stands in every text is one row for
each piece. The best count of an id of the first tokenizer is broadcast: one number for each id of its vocabulary.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
import tokenizers
from pyspark.sql import DataFrame, functions as F

from tallyforge.llm.exchange import packed, unpacked
from tallyforge.llm.words import bounded_batches, pieces
from tallyforge.session import stored

BYTE_BPE, PIECE_BPE = "byte_bpe_50k", "piece_bpe_32k"
#: Beyond so many characters without white space the library that is slow on long words is left out.
LONG_WORD = 2_000


class ByteTokens:
    """Ids of a text by a byte-level vocabulary; special tokens' names in a text are plain text."""

    def __init__(self, folder: str, name: str = BYTE_BPE):
        with open(f"{folder}/{name}.tiktoken", "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        # Two libraries with the same ids; the first is faster but for long words, and gives up on some texts.
        self.fast = tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.sure = tokenizers.Tokenizer.from_file(f"{folder}/{name}.json")
        self.sure.encode_special_tokens = True
        self.spelled = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.spelled[rank] = token

    def ids(self, text: str) -> list[int]:
        if not max(map(len, text.split()), default=0) > LONG_WORD:
            try:
                return self.fast.encode_ordinary(text)
            except BaseException as error:  # the library's panics aren't Exceptions
                if isinstance(error, (KeyboardInterrupt, SystemExit, MemoryError)):
                    raise
        return self.sure.encode(text, add_special_tokens=False).ids


class PieceTokens:
    """Ids of a text by pieces with byte fallback; the library puts a space in front."""

    def __init__(self, folder: str, name: str = PIECE_BPE):
        self.model = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/{name}.model")
        self.spelled = [self._spelling(i) for i in range(self.model.get_piece_size())]

    def _spelling(self, token: int) -> bytes:
        piece = self.model.id_to_piece(token)
        return bytes([int(piece[1:-1], 16)]) if self.model.is_byte(token) else piece.replace("▁", " ").encode()

    def ids(self, text: str) -> list[int]:
        return self.model.encode(text)


@lru_cache(maxsize=2)
def both(folder: str | None = None) -> tuple[ByteTokens, PieceTokens]:
    """The two tokenizers, from `folder` on this machine, or from where the package of their files lies."""
    folder = folder or public_tokenizers.path("").rstrip("/")
    return ByteTokens(folder), PieceTokens(folder)


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For each of the ascending `short` the place of the first of the ascending `long` that isn't smaller, len(long) if none.

    All entries of a level search at once, from where their left neighbour of the levels before was found.
    """
    n, size = len(short), len(long)
    at = np.zeros(n, np.int64)
    guarded = np.append(long, np.iinfo(np.int64).max)
    stride = 1 << max(0, n - 1).bit_length()
    mine = np.zeros(min(n, 1), np.int64)
    while len(mine):
        x = short[mine]
        low = at[mine - stride] if mine[0] else np.zeros(1, np.int64)
        # Exponential steps: all before `low` is smaller than x; `high` isn't.
        high, step = low.copy(), 1
        open_ = np.flatnonzero(guarded[high] < x)
        while len(open_):
            low[open_] = high[open_] + 1
            high[open_] = np.minimum(high[open_] + step, size)
            step *= 2
            open_ = open_[guarded[high[open_]] < x[open_]]
        open_ = np.flatnonzero(low < high)
        while len(open_):
            middle = (low[open_] + high[open_]) >> 1
            less = guarded[middle] < x[open_]
            low[open_] = np.where(less, middle + 1, low[open_])
            high[open_] = np.where(less, high[open_], middle)
            open_ = open_[low[open_] < high[open_]]
        at[mine] = low
        stride >>= 1
        mine = np.arange(stride, n, 2 * stride) if stride else mine[:0]
    return at


@dataclass
class Aligned:
    """Texts of a piece, laid end to end. `first_a[i]` is the first token of text i, with one entry more than texts; so is `first_b`.

    `until_a[g]` is the number of tokens up to the end of group g, and `first_group[i]` the first group of text i.
    `link_a` and `link_b` are the tokens that overlap.
    """

    a: np.ndarray
    b: np.ndarray
    first_a: np.ndarray
    first_b: np.ndarray
    until_a: np.ndarray
    until_b: np.ndarray
    first_group: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray


def _overlaps(short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places of the common ends in both lists, and all pairs of tokens that overlap."""
    rank = gallop(short, long)
    common = long[rank] == short
    low = np.zeros(len(short), np.int64)
    low[1:] = rank[:-1] + common[:-1]
    number = rank - low + 1
    one = np.repeat(np.arange(len(short)), number)
    two = np.repeat(low - np.cumsum(number) + number, number) + np.arange(number.sum())
    return np.flatnonzero(common), rank[common], one, two


def align_texts(texts: list[bytes], folder: str | None = None) -> Aligned:
    """The alignment of some texts. One without bytes, or that a tokenizer doesn't spell as space and text, has no tokens."""
    byte_tokens, piece_tokens = both(folder)
    a, b = [], []
    for raw in texts:
        one, two = [], []
        if raw:
            text, want = raw.decode(), b" " + raw
            one, two = byte_tokens.ids(" " + text), piece_tokens.ids(text)
            if b"".join(map(byte_tokens.spelled.__getitem__, one)) != want or b"".join(map(piece_tokens.spelled.__getitem__, two)) != want:
                one, two = [], []
        a.append(np.array(one, np.int64))
        b.append(np.array(two, np.int64))
    first_a, first_b = (np.concatenate([[0], np.cumsum([len(x) for x in side])]).astype(np.int64) for side in (a, b))
    a, b = (np.concatenate([np.empty(0, np.int64), *side]) for side in (a, b))
    ends_a, ends_b = np.cumsum(_lengths(0, folder)[a]), np.cumsum(_lengths(1, folder)[b])
    if len(a) <= len(b):
        at_a, at_b, link_a, link_b = _overlaps(ends_a, ends_b)
    else:
        at_b, at_a, link_b, link_a = _overlaps(ends_b, ends_a)
    return Aligned(a, b, first_a, first_b, at_a + 1, at_b + 1, np.searchsorted(at_a + 1, first_a, side="right"), link_a, link_b)


@lru_cache(maxsize=4)
def _lengths(which: int, folder: str | None) -> np.ndarray:
    return np.array([len(s) for s in both(folder)[which].spelled], np.int64)


@lru_cache(maxsize=2)
def _decimals(size: int) -> np.ndarray:
    """Each id as decimal digits, followed by nothing, `,`, `|` or `;`."""
    return np.array([f"{i}{mark}" for mark in ("", ",", "|", ";") for i in range(size)], np.bytes_)


def spelled_groups(found: Aligned, size: int) -> tuple[np.ndarray, np.ndarray]:
    """All groups as `a1,a2|b1;a3|b2,b3`, and where the text of each document starts; ids are below `size`."""
    groups = len(found.until_a)
    last_a, last_b = np.zeros(len(found.a), bool), np.zeros(len(found.b), bool)
    last_a[found.until_a - 1] = True
    last_b[found.until_b - 1] = True
    in_a, in_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    codes = np.empty(len(found.a) + len(found.b), np.int64)
    before_b = np.concatenate([[0], found.until_b])
    codes[np.arange(len(found.a)) + before_b[in_a]] = found.a + size * np.where(last_a, 2, 1)
    mark = np.where(last_b, 3, 1)
    mark[found.first_b[1:][np.diff(found.first_b) > 0] - 1] = 0
    codes[np.arange(len(found.b)) + found.until_a[in_b] if groups else np.empty(0, np.int64)] = found.b + size * mark
    table = _decimals(size)
    flat = table[codes].view(np.uint8)
    width = table.dtype.itemsize
    lengths = np.char.str_len(table)[codes]
    return flat[flat != 0] if width else flat, np.concatenate([[0], np.cumsum(lengths)])[found.first_a + found.first_b]


def _binary(column: pa.Array) -> Iterator[tuple[int, int, list[bytes]]]:
    """Runs of rows with their texts as bytes."""
    for first, last, data, offsets in pieces(column):
        raw = data.tobytes()
        yield first, last, [raw[x:y] for x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist())]


def align(docs: DataFrame, key: str = "doc_id", text: str = "text", folder: str | None = None) -> DataFrame:
    """`key`, `a` and `b` (ids of both tokenizers), `until_a` and `until_b` (tokens up to the end of each group), for every row.

    Texts that are null or empty, or that one tokenizer doesn't give back byte for byte, have empty lists. Texts are taken whole;
    repeated rows give equal rows; other columns are ignored. `folder` holds the tokenizers' files on each machine.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for first, last, texts in _binary(batch.column(1)):
                found = align_texts(texts, folder)
                sides = ((found.a, found.first_a, 0), (found.b, found.first_b, 0), (found.until_a, found.first_group, found.first_a), (found.until_b, found.first_group, found.first_b))
                lists = []
                for values, starts, base in sides:
                    if np.ndim(base):
                        values = values - np.repeat(base[:-1], np.diff(starts))
                    lists.append(pa.ListArray.from_arrays(starts.astype(np.int32), pa.array(values.astype(np.int32))))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), *lists], ["key", "a", "b", "until_a", "until_b"])

    out = bounded_batches(docs).select(F.col(key).alias("key"), text).mapInArrow(run, f"key {kind}, a array<int>, b array<int>, until_a array<int>, until_b array<int>")
    return out.withColumnRenamed("key", key)


def _distinct_pairs(found: Aligned, size: int, sizes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct linked pairs of ids, and how many documents hold each; for each document the places of its pairs, how often each, and the start."""
    docs = len(found.first_a) - 1
    links = np.diff(np.searchsorted(found.link_a, found.first_a)) if len(found.link_a) else np.zeros(docs, np.int64)
    pair = found.a[found.link_a] * size + found.b[found.link_b]
    each = np.sort(np.repeat(np.arange(docs), links) * sizes + pair)
    heads = np.flatnonzero(np.diff(each, prepend=-1))
    times = np.diff(np.append(heads, len(each)))
    doc, mine = each[heads] // sizes, each[heads] % sizes
    pairs, at, count = np.unique(mine, return_inverse=True, return_counts=True)
    return pairs, count, at, times, np.searchsorted(doc, np.arange(docs + 1))


def linked_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", folder: str | None = None) -> DataFrame:
    """`key`, `n_a`, `n_b`, `n_groups`, `n_links`, `n_best`, `count_sum` and `groups_sha256` for every row of `docs`.

    A link is a pair of tokens whose bytes overlap; the count of a pair of ids is the number of rows that hold it linked. `n_best`
    counts the links whose count is the highest of their first id, ties included, `count_sum` adds the counts of all links. The
    hash is over the groups as `a1,a2|b1;a3|b2,b3`, '' for a text without tokens (null, empty, or not given back byte for byte),
    which has zeros. Repeated rows count each. Texts are taken whole, other columns are ignored, an empty table gives no rows.
    """
    kind = docs.schema[key].dataType.simpleString()
    size_a, size_b = (len(side.spelled) for side in both(folder))
    figures = ["n_a", "n_b", "n_groups", "n_links"]

    def run(batches):
        for batch in batches:
            for first, last, texts in _binary(batch.column(1)):
                found = align_texts(texts, folder)
                pairs, count, at, times, starts = _distinct_pairs(found, size_b, size_a * size_b)
                flat, cuts = spelled_groups(found, max(size_a, size_b))
                names = [hashlib.sha256(flat[x:y]).hexdigest() if y > x else "" for x, y in zip(cuts[:-1], cuts[1:])]
                links = np.add.reduceat(np.append(times, 0), starts[:-1]) * (np.diff(starts) > 0)
                numbers = [np.diff(found.first_a), np.diff(found.first_b), np.diff(found.first_group), links]
                # Differences of the places, which are ascending in a document, need few bits.
                blob = packed(np.diff(at, prepend=0).astype("<i4"), times.astype("<i4"), starts.astype("<i8"))
                row = [batch.column(0).slice(first, last - first), *(pa.array(n) for n in numbers), pa.array(names), pa.array(pairs), pa.array(count)]
                lists = [pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values) for values in row]
                yield pa.RecordBatch.from_arrays([*lists, pa.array([blob], pa.binary())], schema_names)

    schema_names = ["keys", *figures, "names", "pairs", "documents", "places"]
    schema = f"keys array<{kind}>, " + ", ".join(f"{f} array<long>" for f in figures) + ", names array<string>, pairs array<long>, documents array<long>, places binary"
    rows = bounded_batches(docs).select(F.col(key).alias("key"), text).mapInArrow(run, schema)
    # Stored, so that a piece keeps its number and its texts.
    held = stored(rows.withColumn("piece", F.monotonically_increasing_id()), "aligned-pieces")

    each = held.select(F.explode(F.arrays_zip("pairs", "documents")).alias("x")).select(F.col("x.pairs").alias("pair"), F.col("x.documents").alias("documents"))
    counts = stored(each.groupBy("pair").agg(F.sum("documents").alias("count")), "pair-counts")
    best = np.zeros(size_a, np.int64)
    for a, most in counts.groupBy(F.expr(f"cast(pair div {size_b} as int)").alias("a")).agg(F.max("count")).collect():  # an id of the vocabulary each
        best[a] = most
    shared = docs.sparkSession.sparkContext.broadcast(best)

    asked = held.select("piece", F.posexplode("pairs").alias("at", "pair")).join(counts, "pair")
    answers = asked.groupBy("piece").agg(F.array_sort(F.collect_list(F.struct("at", "count"))).alias("answers")).select("piece", F.col("answers.count").alias("counts"))

    def finish(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name).slice(i, 1).flatten() for name in ("keys", *figures, "names", "pairs", "counts")}
                at, times, starts = unpacked(batch.column("places")[i].as_py(), "<i4", "<i4", "<i8")
                at = np.cumsum(at, dtype=np.int64)
                pairs, counts = (row[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("pairs", "counts"))
                full = np.diff(starts) > 0
                sums = []
                for values in (times * (counts == shared.value[pairs // size_b])[at], times * counts[at]) if len(at) else ():
                    sums.append(np.add.reduceat(np.append(values, 0), starts[:-1]) * full)
                sums = sums or [np.zeros(len(full), np.int64)] * 2
                yield pa.RecordBatch.from_arrays([row["keys"], *(row[f] for f in figures), *(pa.array(s.astype(np.int64)) for s in sums), row["names"]], out_names)

    out_names = ["key", *figures, "n_best", "count_sum", "groups_sha256"]
    out = held.drop("documents").join(answers, "piece", "left").mapInArrow(finish, f"key {kind}, " + ", ".join(f"{c} long" for c in out_names[1:-1]) + ", groups_sha256 string")
    return out.withColumnRenamed("key", key)


def op11_galloping_token_alignment(spark, folder: str) -> DataFrame:
    """Every document with how its tokens by two tokenizers line up, and how usual its linked pairs are."""
    return linked_documents(spark.read.parquet(f"{folder}/documents.parquet"))
