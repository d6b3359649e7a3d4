"""Language-model scores by logistic context mixing.

A text is modelled bit by bit. Several predictors each look at another context (the last 1 to 6 bytes of the text,
or all of the word so far), hashed with the bits of the byte so far to a slot that counts zeros and ones. Their predictions
are mixed in the logistic domain with weights that a gate selects; weights are learned online, one small batch of items
after the other. The mix is refined by a table that maps it to what it turned out to be (an adaptive probability map).

Contexts run on from one word to the next, up to six bytes back. What they say of the first six bytes of a word (its head,
and the space after a shorter word) hangs on the six bytes before, what they say of the rest (its tail) on the word alone. So Spark
counts two kinds of items of the corpus, distinct heads (six bytes, the place in the word and the next byte) and distinct words;
bits are counted and predicted once for each, in shards, and the costs go back to the pieces of text that hold them. A piece
sends each of its items once. Only tables of a fixed size reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallyforge.llm.exchange import answers_by_piece, as_words, found_for, found_in, packed, shards_for, spelled_words, unpacked, vocabulary_of
from tallyforge.llm.grouped import by_key
from tallyforge.llm.language import remainder
from tallyforge.llm.words import LOWER, UNSPACED, Words, bounded_batches, mixed, pieces, split, word_hashes
from tallyforge.session import stored

PIECE_BYTES = 1 << 23
SHARDS_PER_COUNT = 8
#: Bytes of context of each predictor (0: the whole word so far), and the slots of its table, as powers of two.
ORDERS = ((1, 16), (2, 18), (3, 18), (4, 20), (6, 20), (0, 20))
CHUNK = 1 << 14
BUCKETS = 33
RATE, BATCH_WORDS = 0.05, 64
_ODD = np.uint64(0x9E3779B97F4A7C15)
HEAD = 6  # bytes of a word, from its start, of which contexts reach back over the start
SPACE = 0x20
END = b"\n"  # the token at the end of a text; no word holds it
#: What each slot has seen of both bits before the first word; little, as most contexts know the next bit.
_DELTA = 0.02
_WORDS_AT_ONCE, _BATCHES_AT_ONCE = 1 << 13, 16
#: A gate for how often the word so far was seen (by powers of two), and its last four bytes: never, up to 8 times, more often.
_LEVELS = 16
_GATES = 3 * _LEVELS
_LEAST = 1 / 4096
#: Costs of heads go back to the pieces in steps of 1/512 bit; no byte costs more than 96 bits.
_STEPS = 512 / np.log10(2)


def _lines(words: Words, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of each text as they are modelled, words with a space after each and an end token, and the lengths of these lines."""
    long, counts = words.ends - words.starts, words.counts()
    at = np.arange(len(words)) + words.text_of()  # every text before has an end token
    room = np.ones(len(words) + len(counts), np.int64)
    room[at] += long
    ends = np.cumsum(room)
    line = np.full(ends[-1] if len(ends) else 0, SPACE, np.uint8)
    inside = np.ones(len(line), bool)
    inside[ends - 1] = False
    line[inside] = data[UNSPACED[data]]
    stop = ends[np.cumsum(counts + 1) - 1]
    line[stop - 1] = END[0]
    return line, np.diff(stop, prepend=0)


def _openings(line: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each word, in order, with the space after it: the six bytes before in the text and its first six (zeros beyond the start and the end), how many these are, its text."""
    starts = np.cumsum(lengths) - lengths
    new = np.zeros(len(line), bool)
    new[1:] = line[:-1] == SPACE
    new[starts] = True
    at = np.flatnonzero(new)
    text_of = np.repeat(np.arange(len(lengths), dtype=np.int32), np.diff(np.searchsorted(at, np.append(starts, len(line)))))
    padded = np.concatenate([np.zeros(8, np.uint8), line, np.zeros(8, np.uint8)])
    lanes = np.ndarray((len(line) + 9,), np.dtype(">u8"), padded, strides=(1,))
    six, byte = np.uint64(8 * HEAD), np.uint64(8)
    passed = np.minimum(at - starts[text_of], HEAD).astype(np.uint64)
    before = lanes[at].astype(np.uint64) & ((np.uint64(1) << byte * passed) - np.uint64(1))
    size = np.minimum(np.diff(at, append=len(line)), HEAD)
    beyond = six - byte * size.astype(np.uint64)
    return before, lanes[at + 8].astype(np.uint64) >> np.uint64(64) - six >> beyond << beyond, size, text_of


def _items_at(place: int, before: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The items of some openings at one place in the word: place, six bytes before, byte."""
    item = before << np.uint64(8 * (place + 1)) | first >> np.uint64(8 * (HEAD - 1 - place))
    return item & np.uint64((1 << 8 * (HEAD + 1)) - 1) | np.uint64(place << 56)


def _heads(line: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The items of the heads of all words, in order: place in the word, six bytes before in the text (zeros before its start), byte; and their texts."""
    before, first, size, text_of = _openings(line, lengths)
    items = np.stack([_items_at(place, before, first) for place in range(HEAD)], axis=1)
    return items[np.arange(HEAD) < size[:, None]], np.repeat(text_of, size)


def _examples(values: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """For each value the place of one example of it, the same for equal values. `hashes` spread the values over a table; those that lose their slot to others try the next bits."""
    out = np.empty(len(values), np.int32)
    table = np.empty(1 << max(4, len(values).bit_length() + 1), np.int32)
    todo, size = np.arange(len(values), dtype=np.int32), len(table)
    while len(todo):
        slot = (hashes & np.uint64(size - 1)).view(np.int64)
        table[slot] = todo
        example = table[slot]
        same = values[example] == values[todo]
        out[todo[same]] = example[same]
        lost = ~same
        todo, hashes = todo[lost], mixed(hashes[lost] + _ODD)
    return out


def _distinct(values: np.ndarray, ordered: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The place of one example of each distinct value, in the order of the values if `ordered`, and the number of every value in it. Only distinct values are sorted."""
    of = _examples(values, mixed(values))
    place = np.flatnonzero(of == np.arange(len(values), dtype=np.int32))
    if ordered:
        place = place[np.argsort(values[place])]
    number = np.empty(len(values), np.int32)
    number[place] = np.arange(len(place), dtype=np.int32)
    return place, number[of]


def _distinct_heads(line: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The items of `_heads`, formed once for words that open alike: distinct items, sorted; for each item of each opening its place there and the opening; for each word its opening and its text."""
    before, first, size, text_of = _openings(line, lengths)
    example, opening = _distinct(mixed(mixed(before) * _ODD + first), ordered=False)
    before, first, size = before[example], first[example], size[example]
    items, number, owner, known = [], [], [], 0
    for place in range(HEAD):
        here = np.flatnonzero(size > place)
        item = _items_at(place, before[here], first[here])
        one, which = _distinct(item)
        items.append(item[one])
        number.append((which + known).astype(np.int32))
        owner.append(here.astype(np.int32))
        known += len(one)
    return np.concatenate(items), np.concatenate(number), np.concatenate(owner), opening, text_of


def _head_shard(items: np.ndarray, shards: int) -> np.ndarray:
    # By the place and the three bytes furthest back, so that items close to each other stay together.
    return (mixed(items >> np.uint64(32)) % np.uint64(shards)).astype(np.int32)


def _united(batches):
    """Batches put together until they hold about a piece of text, as a larger piece repeats fewer items of others."""
    held, size = [], 0
    for batch in batches:
        if held and size + batch.nbytes > PIECE_BYTES:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
        if batch.num_rows:
            held.append(batch)
            size += batch.nbytes
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _tokens(words: Words, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct tokens of a piece, sorted by hash, as bytes and lengths; the place there of each token, the ends of texts last; the text of each."""
    hashes = np.concatenate([word_hashes(words), word_hashes(as_words(np.frombuffer(END, np.uint8), np.ones(1, np.int64)))])
    first, place = _distinct(hashes)
    # Every text gets a token for its end.
    whole = Words(np.concatenate([words.data, np.frombuffer(END, np.uint8)]), np.append(words.starts, len(words.data)), np.append(words.ends, len(words.data) + 1), words.first)
    spelled, lengths = spelled_words(whole, first)
    place = np.concatenate([place[:-1], np.full(texts, place[-1])])
    return spelled, lengths, place, np.concatenate([words.text_of(), np.arange(texts)])


def _pieces(docs: DataFrame, key: str, text: str, held: Column, learn: Column) -> DataFrame:
    """A row for each piece of a few MB of text: `piece`, `docs` (keys and lines of each text, whether to learn from it), `words` (the distinct words, with their
    counts in the texts to learn from), `n_words`, and `n_heads`, about how many distinct heads it has."""

    def run(batches):
        for batch in _united(batches):
            for a, b, data, offsets in pieces(batch.column(1), PIECE_BYTES):
                lower = LOWER[data]
                words = split(lower, offsets, UNSPACED)
                spelled, lengths, place, owner = _tokens(words, b - a)
                teaches = batch.column(3).slice(a, b - a).to_numpy(zero_copy_only=False)
                train = np.bincount(place[teaches[owner]], minlength=len(lengths))
                line, long = _lines(words, lower)
                sink = pa.BufferOutputStream()
                keys = pa.record_batch([batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a)], ["key", "held"])
                with pa.ipc.new_stream(sink, keys.schema) as writer:
                    writer.write_batch(keys)
                rows = packed(np.frombuffer(sink.getvalue(), np.uint8), line, long.astype("<i8"), teaches.astype("u1"))
                spell = packed(spelled, lengths.astype("<i4"), train.astype("<i8"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([rows], pa.binary()), pa.array([spell], pa.binary()), pa.array([len(lengths)], pa.int64()), pa.array([len(line) // 8], pa.int64())],
                    ["docs", "words", "n_words", "n_heads"],
                )

    source = bounded_batches(docs).select(F.col(key), F.col(text), F.coalesce(held, F.lit(False)), F.coalesce(learn, F.lit(False)))
    made = source.mapInArrow(run, "docs binary, words binary, n_words long, n_heads long")
    return stored(made.withColumn("piece", F.monotonically_increasing_id()), "mixing-pieces")


def _by_byte(values: np.ndarray) -> np.ndarray:
    """The lowest bytes of all values, then the next; so they pack better."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8).T.reshape(-1)


def _from_bytes(data: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(data.reshape(8, -1).T).view("<u8").reshape(-1)


def _heads_of(parts: DataFrame, shards: int) -> DataFrame:
    """As `vocabulary_of`, for heads: `shard`, `words` (distinct items and the sums of their counts), `members`."""

    def send(batches):
        for batch in batches:
            for piece, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                _, line, long, teaches = unpacked(blob.as_py(), "u1", "u1", "<i8", "u1")
                items, number, owner, opening, text_of = _distinct_heads(line, long)
                taught = np.bincount(opening, teaches[text_of])
                train = np.bincount(number, taught[owner]).astype("<i4")
                shard = _head_shard(items, shards)
                order = np.argsort(shard, kind="stable")
                cuts = np.flatnonzero(np.diff(shard[order], prepend=-1, append=-1))
                for a, b in zip(cuts[:-1], cuts[1:]):
                    mine = order[a:b]
                    blob = packed(_by_byte(np.diff(items[mine], prepend=np.uint64(0))), train[mine])
                    yield pa.RecordBatch.from_arrays([pa.array([shard[mine[0]]], pa.int32()), pa.array([piece]), pa.array([blob], pa.binary())], ["shard", "piece", "words"])

    def merge(batches):
        for shard, group in by_key(batches):
            sent = [unpacked(b, "u1", "<i4") for b in group.column("words").to_pylist()]
            items, at = np.unique(np.concatenate([np.cumsum(_from_bytes(s[0])) for s in sent]), return_inverse=True)
            total = np.zeros(len(items), np.int64)
            np.add.at(total, at, np.concatenate([s[1] for s in sent]).astype(np.int64))
            cuts = np.cumsum([0, *(len(s[1]) for s in sent)])
            members = [{"piece": p, "at": packed(np.diff(at[a:b], prepend=0).astype("<i4"))} for p, a, b in zip(group.column("piece").to_pylist(), cuts[:-1], cuts[1:])]
            member = pa.struct([("piece", pa.int64()), ("at", pa.binary())])
            columns = [pa.array([shard], pa.int32()), pa.array([packed(items.astype("<u8"), total)], pa.binary()), pa.array([members], pa.list_(member))]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "words", "members"])

    count = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sent = parts.select("piece", "docs").mapInArrow(send, "shard int, piece long, words binary")
    merged = sent.repartition(count, "shard").sortWithinPartitions("shard").mapInArrow(merge, "shard int, words binary, members array<struct<piece:long,at:binary>>")
    return stored(merged, "heads")


def _mix_here(x: np.ndarray) -> np.ndarray:
    """What `mixed` returns, in the place of x."""
    for shift, factor in ((30, np.uint64(0xBF58476D1CE4E5B9)), (27, np.uint64(0x94D049BB133111EB)), (31, None)):
        x ^= x >> np.uint64(shift)
        if factor is not None:
            x *= factor
    return x


class _Bits:
    """The bits of some words, each followed by a space (the end token stands alone): slots of all predictors, values, and the word of each bit.

    With `skip` only what comes after the words' first `skip` bytes.
    """

    def __init__(self, data: np.ndarray, lengths: np.ndarray, skip: int = 0):
        ended = np.repeat(np.cumsum(lengths), 1)
        is_end = (lengths == 1) & (data[ended - lengths] == END[0])
        room = lengths + ~is_end
        starts = np.cumsum(room) - room
        word = np.repeat(np.arange(len(room)), room)
        place = np.arange(len(word)) - starts[word]
        line = np.full(len(word), 0x20, np.uint8)
        line[place < lengths[word]] = data
        last = np.zeros(len(word), np.uint64)  # the six bytes before, in this word
        for back in range(6, 0, -1):
            before = np.zeros(len(word), np.uint64)
            has = place >= back
            before[has] = line[np.flatnonzero(has) - back]
            last = (last << np.uint64(8)) | before
        steps = mixed((place.astype(np.uint64) << np.uint64(8)) | line)
        sums = np.cumsum(steps) - steps
        prefix = sums - sums[starts][word]
        if skip:
            tail = place >= skip
            line, word, last, prefix = line[tail], word[tail], last[tail], prefix[tail]
        self._place(line, word, last, prefix)

    @classmethod
    def of_heads(cls, items: np.ndarray) -> _Bits:
        """The bits of the last bytes of some heads; `word` is the number of the item."""
        line, last = (items & np.uint64(255)).astype(np.uint8), items >> np.uint64(8) & np.uint64((1 << 48) - 1)
        place = (items >> np.uint64(56)).astype(np.int64)
        prefix = np.zeros(len(items), np.uint64)
        for back in range(1, HEAD):  # the word so far
            has = np.flatnonzero(place >= back)
            byte = last[has] >> np.uint64(8 * (back - 1)) & np.uint64(255)
            prefix[has] += mixed((place[has] - back).astype(np.uint64) << np.uint64(8) | byte)
        self = cls.__new__(cls)
        self._place(line, np.arange(len(items)), last, prefix)
        return self

    def _place(self, line: np.ndarray, word: np.ndarray, last: np.ndarray, prefix: np.ndarray):
        node = np.stack([(1 << k) | (line.astype(np.uint64) >> np.uint64(8 - k)) for k in range(8)], axis=1).astype(np.uint64)
        self.value = np.unpackbits(line).astype(np.int64)
        self.word = np.repeat(word, 8)
        self.slots = []
        for which, (order, size) in enumerate(ORDERS):
            context = last & np.uint64((1 << 8 * order) - 1) if order else mixed(prefix + np.uint64(1))
            slot = _mix_here(mixed(context + np.uint64(which << 56))[:, None] + node) >> np.uint64(64 - size)
            self.slots.append(slot.reshape(-1).view(np.int64))


def _spans(ends: np.ndarray, lengths: np.ndarray, size: int):
    """First word and the one after the last of `size` words at a time, fewer where they are long."""
    first = 0
    while first < len(lengths):
        start = int(ends[first] - lengths[first])
        last = min(first + size, max(first + 1, int(np.searchsorted(ends, start + 16 * size, side="right"))))
        yield first, last
        first = last


def _batches(data: np.ndarray, lengths: np.ndarray, size: int, skip: int = 0):
    """The bits of `size` words at a time (fewer where they are long), with the words' numbers."""
    ends = np.cumsum(lengths, dtype=np.int64)
    for first, last in _spans(ends, lengths, size):
        yield first, last, _Bits(data[ends[first] - lengths[first] : ends[last - 1]], lengths[first:last].astype(np.int64), skip)


def _items(is_head: bool, blob: bytes, size: int):
    """The items of a shard, some at a time: their places, their bits, and for each bit how often its item was seen in training. Words without tails are left out."""
    if is_head:
        items, train = unpacked(blob, "<u8", "<i8")
        for first in range(0, len(items), HEAD * size):
            bits = _Bits.of_heads(items[first : first + HEAD * size])
            yield np.arange(first, min(first + HEAD * size, len(items))), bits, train[first : first + HEAD * size][bits.word]
        return
    data, lengths, train = unpacked(blob, "u1", "<i4", "<i8")
    order = np.flatnonzero(lengths >= HEAD)
    data, lengths = spelled_words(as_words(data, lengths.astype(np.int64)), order)
    for first, last, bits in _batches(data, lengths, size, HEAD):
        yield order[first:last], bits, train[order[first:last]][bits.word]


def _lessons(is_head: bool, blob: bytes):
    """As `_items`, for items seen in training, in an order of their own, so that a batch isn't one stretch of the alphabet: bits, counts, and where batches of them start and end.

    Bits are formed for some batches at once, which is less work than for each.
    """
    if is_head:
        items, train = unpacked(blob, "<u8", "<i8")
        order = np.argsort(mixed(items + np.uint64(9)))
        order = order[train[order] > 0]
        step = HEAD * BATCH_WORDS
        for first in range(0, len(order), _BATCHES_AT_ONCE * step):
            at = order[first : first + _BATCHES_AT_ONCE * step]
            bits = _Bits.of_heads(items[at])
            yield bits, train[at][bits.word], np.append(np.arange(0, len(at), step), len(at)) * 8
        return
    data, lengths, train = unpacked(blob, "u1", "<i4", "<i8")
    words = as_words(data, lengths.astype(np.int64))
    order = np.flatnonzero(lengths >= HEAD)
    order = order[np.argsort(word_hashes(words, seed=9)[order], kind="stable")]
    order = order[train[order] > 0]
    data, lengths = spelled_words(words, order)
    ends = np.cumsum(lengths, dtype=np.int64)
    spans = list(_spans(ends, lengths, BATCH_WORDS))
    group = 0
    while group < len(spans):
        first, stop = spans[group][0], group + 1
        start = ends[first] - lengths[first]
        while stop < len(spans) and ends[spans[stop][1] - 1] - start <= 16 * BATCH_WORDS * _BATCHES_AT_ONCE:
            stop += 1
        last = spans[stop - 1][1]
        bits = _Bits(data[start : ends[last - 1]], lengths[first:last].astype(np.int64), HEAD)
        cuts = np.searchsorted(bits.word, [a - first for a, _ in spans[group:stop]] + [last - first])
        yield bits, train[order[first:last]][bits.word], cuts
        group = stop


def _slot_counts(vocabulary: DataFrame) -> list[np.ndarray]:
    """For each predictor a table of zeros and ones counted in the heads and tails of the training texts. `vocabulary` has `is_head`, `shard` and `words`."""
    sizes = [1 << size for _, size in ORDERS]

    def count(batches):
        tables = None
        for batch in batches:
            for is_head, blob in zip(batch.column(0).to_pylist(), batch.column(2)):
                tables = tables or [np.zeros(2 * s) for s in sizes]
                for _, bits, weight in _items(is_head, blob.as_py(), _WORDS_AT_ONCE):
                    for table, slot in zip(tables, bits.slots):
                        np.add.at(table, 2 * slot + bits.value, weight.astype(np.float64))  # in place: tables are larger than a batch
        for which, table in enumerate(tables or []):
            for chunk in range(0, len(table), CHUNK):
                part = table[chunk : chunk + CHUNK].astype("<i8")
                if part.any():
                    yield pa.RecordBatch.from_arrays([pa.array([which << 32 | chunk]), pa.array([packed(part)], pa.binary())], ["chunk", "counts"])

    def add(batches):
        for chunk, group in by_key(batches):
            total = sum(unpacked(b, "<i8")[0] for b in group.column("counts").to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([int(chunk)]), pa.array([packed(total)], pa.binary())], ["chunk", "counts"])

    parts = int(vocabulary.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    number = vocabulary.agg(F.max("shard")).first()[0]
    tasks = max(1, ((number or 0) + 1) // SHARDS_PER_COUNT)
    counted = vocabulary.repartition(tasks, "shard").mapInArrow(count, "chunk long, counts binary")
    out = [np.zeros(2 * s, np.float32) for s in sizes]
    for row in counted.repartition(parts, "chunk").sortWithinPartitions("chunk").mapInArrow(add, "chunk long, counts binary").toLocalIterator():
        which, at = row.chunk >> 32, row.chunk & (1 << 32) - 1
        part = unpacked(bytes(row.counts), "<i8")[0]
        out[which][at : at + len(part)] = part
    return [t.reshape(-1, 2) for t in out]


@dataclass
class Model:
    """Tables, mixing weights by gate, and the map that refines the mix."""

    tables: list[np.ndarray]
    weights: np.ndarray
    refined: np.ndarray

    def inputs(self, bits: _Bits, without: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """What the predictors say, in the logistic domain, and the gate. `without[i]` leaves out what bit i itself has added."""
        out = np.empty((len(bits.value), len(self.tables) + 1))
        seen = []
        for i, (table, slot) in enumerate(zip(self.tables, bits.slots)):
            pair = np.take(table, slot, axis=0).astype(np.float64)
            zeros, ones = pair[:, 0], pair[:, 1]
            if without is not None:
                zeros = np.maximum(0, zeros - without * (bits.value == 0))
                ones = np.maximum(0, ones - without * (bits.value == 1))
            seen.append(zeros + ones)
            out[:, i] = np.log((ones + _DELTA) / (zeros + _DELTA))
        out[:, -1] = 0.3
        level = np.minimum(np.ceil(np.log2(1 + seen[-1])).astype(np.int64), _LEVELS - 1)
        return out, 3 * level + (seen[3] > 0) + (seen[3] > 8)

    def mix(self, inputs: np.ndarray, gate: np.ndarray) -> np.ndarray:
        return np.clip((inputs * self.weights[gate]).sum(axis=1), -8, 8)

    def probability(self, inputs: np.ndarray, gate: np.ndarray) -> np.ndarray:
        """That the bit is one."""
        mixed_ = self.mix(inputs, gate)
        spot = (mixed_ + 8) * (BUCKETS - 1) / 16
        low = np.minimum(spot.astype(np.int64), BUCKETS - 2)
        part = spot - low
        refined = self.refined[gate, low] * (1 - part) + self.refined[gate, low + 1] * part
        return np.clip((1 / (1 + np.exp(-mixed_)) + refined) / 2, _LEAST, 1 - _LEAST)

    def word_scores(self, data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """log10 of the probability of each word, with the space after it."""
        out = np.zeros(len(lengths))
        for first, last, bits in _batches(data, lengths, _WORDS_AT_ONCE):
            out[first:last] = self.scores(bits, last - first)
        return out

    def scores(self, bits: _Bits, count: int) -> np.ndarray:
        """log10 of the probability of each of `count` words or heads."""
        p = self.probability(*self.inputs(bits))
        return np.bincount(bits.word, np.log10(np.where(bits.value == 1, p, 1 - p)), minlength=count)

    def item_scores(self, is_head: bool, blob: bytes, count: int) -> np.ndarray:
        """log10 of the probability of each head, or of each word's tail, of a shard."""
        out = np.zeros(count)
        for at, bits, _ in _items(is_head, blob, _WORDS_AT_ONCE):
            out[at] = self.scores(bits, len(at))
        return out


def _untrained(tables: list[np.ndarray]) -> Model:
    centres = np.linspace(-8, 8, BUCKETS)
    return Model(tables, np.full((_GATES, len(ORDERS) + 1), 0.3), np.tile(1 / (1 + np.exp(-centres)), (_GATES, 1)))


def _learned(vocabulary: DataFrame, tables) -> Model:
    """Weights learned online in each shard and averaged, each gate by the bits it has seen there; the map's counts added up.

    While learning, an item's last occurrence is left out of the counts, so that contexts it alone has made aren't trusted.
    """

    def learn(batches):
        """Sums over the shards of a task: of the gates' bits, of the weights times these, and of the map's counts."""
        seen, weighted = np.zeros(_GATES), np.zeros((_GATES, len(ORDERS) + 1))
        hits, sums = np.zeros((_GATES, BUCKETS)), np.zeros((_GATES, BUCKETS))
        for batch in batches:
            for is_head, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                model, here = _untrained(tables.value), np.zeros(_GATES)
                squares = np.full_like(model.weights, 1e-2)
                for bits, counted, cuts in _lessons(is_head, blob.as_py()):
                    said, gates = model.inputs(bits, np.ones(len(bits.value)))
                    counted, mixes = counted.astype(np.float64), np.empty(len(gates))
                    for a, b in zip(cuts[:-1], cuts[1:]):
                        inputs, gate = said[a:b], gates[a:b]
                        mix = mixes[a:b] = model.mix(inputs, gate)
                        error = (bits.value[a:b] - 1 / (1 + np.exp(-mix))) * counted[a:b]
                        slope = np.stack([np.bincount(gate, error * column, minlength=_GATES) for column in inputs.T], axis=1)
                        squares += slope**2
                        model.weights = model.weights + RATE * slope / np.sqrt(squares)
                    here += np.bincount(gates, counted, minlength=_GATES)
                    spot = gates * BUCKETS + np.rint((mixes + 8) * (BUCKETS - 1) / 16).astype(np.int64)
                    sums += np.bincount(spot, counted, minlength=sums.size).reshape(sums.shape)
                    hits += np.bincount(spot, counted * bits.value, minlength=hits.size).reshape(hits.shape)
                seen += here
                weighted += model.weights * here[:, None]
        whole = np.concatenate([seen, weighted.reshape(-1), sums.reshape(-1), hits.reshape(-1)])
        yield pa.RecordBatch.from_arrays([pa.array([whole.tolist()], pa.list_(pa.float64()))], ["sums"])

    # Added up by Spark, place by place; a fixed number of places reaches the driver.
    each = vocabulary.select("is_head", "words").mapInArrow(learn, "sums array<double>").select(F.posexplode("sums").alias("place", "x"))
    total = np.zeros(_GATES * (2 + len(ORDERS) + 2 * BUCKETS))
    for r in each.groupBy("place").agg(F.sum("x").alias("x")).collect():
        total[r.place] = r.x
    seen, weighted, sums, hits = np.split(total, np.cumsum([_GATES, _GATES * (len(ORDERS) + 1), _GATES * BUCKETS]))
    model, known = _untrained(tables.value), seen > 0
    model.weights[known] = weighted.reshape(_GATES, -1)[known] / seen[known, None]
    model.refined[:] = (hits.reshape(_GATES, -1) + 4 * model.refined) / (sums.reshape(_GATES, -1) + 4)
    return model


def score_texts(docs: DataFrame, key: str, text: str, held: Column, learn: Column) -> DataFrame:
    """For each row of `docs`: `key`, `held_out`, `n_tokens`, `n_known`, `train_tokens`, `base_score`, `score`, `bits_per_byte`.

    Lower-cases A-Z; tokens are words that end at white space, and one end per text. Learns from the rows where `learn` is
    true; null counts as false for both conditions. `base_score` is the log10 probability under smoothed word counts,
    `score` under the mixing model, which takes the words with one space after each and an end, and adds up heads in steps of 1/512 bit. Null and empty texts have one token. Null
    keys and repeated rows get a row each; other columns are ignored. Whole texts are counted and scored. Without texts to
    learn from, nothing is known and the model is untrained.
    """
    parts = _pieces(docs, key, text, held, learn)
    spark = docs.sparkSession
    shards = shards_for(parts, "n_words")
    vocabulary = vocabulary_of(parts, shards)
    known = vocabulary.agg(F.sum("tokens").alias("tokens"), F.sum("types").alias("types")).first()
    tokens, types = known.tokens or 0, known.types or 0
    head_shards = shards_for(parts, "n_heads")
    heads = _heads_of(parts, head_shards)
    columns = ("shard", "words")
    both = vocabulary.select(F.lit(False).alias("is_head"), *columns).unionByName(heads.select(F.lit(True).alias("is_head"), *columns))
    tables = spark.sparkContext.broadcast(_slot_counts(both))
    trained = _learned(both, tables)
    weights, refined = trained.weights, trained.refined

    def values(is_head: bool):
        def run(batches):
            """For each shard: the scores of its heads, or the training counts of its words and the scores of their tails."""
            model = Model(tables.value, weights, refined)
            for batch in batches:
                for shard, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                    train = unpacked(blob.as_py(), "<u8", "<i8")[1] if is_head else unpacked(blob.as_py(), "u1", "<i4", "<i8")[2]
                    score = model.item_scores(is_head, blob.as_py(), len(train))
                    found = packed(np.rint(-_STEPS * score).astype("<u2")) if is_head else packed(train, score.astype("<f4"))
                    yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([found], pa.binary())], ["shard", "found"])

        return run

    scored, head_scored = (v.select(*columns).mapInArrow(values(is_head), "shard int, found binary") for v, is_head in ((vocabulary, False), (heads, True)))
    answers = answers_by_piece(vocabulary, scored, ("<i8", "<f4"))
    head_answers = answers_by_piece(heads, head_scored, ("<u2",), steps=True).withColumnRenamed("answers", "head_answers")
    floor = np.log10(tokens + 0.5 * (types + 1))
    names = [key, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"]

    def finish(batches):
        for batch in batches:
            for rows, found, head_found in zip(*(batch.column(i) for i in range(3))):
                keys, line, long, _ = unpacked(rows.as_py(), "u1", "u1", "<i8", "u1")
                keys = pa.ipc.open_stream(keys.tobytes()).read_all().combine_chunks().to_batches()[0]
                words = split(line, np.concatenate([[0], np.cumsum(long)]), UNSPACED)
                n_words = words.counts()
                data, lengths, place, owner = _tokens(words, len(long))
                count, score = found_for(as_words(data, lengths.astype(np.int64)), shards, found, ("<i8", "<f4"))
                add = lambda values: np.bincount(owner, values[place], minlength=len(n_words))
                items, number, opened, opening, text_of = _distinct_heads(line, long)
                (cost,) = found_in(_head_shard(items, head_shards), head_found, ("<u2",))
                cost = np.bincount(opened, cost[number])  # of each opening
                result = add(score) - np.bincount(text_of, cost[opening], minlength=len(n_words)) / _STEPS
                columns = [
                    keys.column(0), keys.column(1), pa.array(n_words + 1), pa.array(add(1.0 * (count > 0)).astype(np.int64)), pa.array(np.full(len(n_words), tokens)),
                    pa.array(add(np.log10(count + 0.5)) - (n_words + 1) * floor), pa.array(result), pa.array(-result / np.log10(2) / long),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    kinds = (T.BooleanType(), T.LongType(), T.LongType(), T.LongType(), T.DoubleType(), T.DoubleType(), T.DoubleType())
    schema = T.StructType([docs.schema[key], *(T.StructField(n, k) for n, k in zip(names[1:], kinds))])
    joined = parts.select("piece", "docs").join(answers, "piece").join(head_answers, "piece")
    return joined.select("docs", "answers", "head_answers").mapInArrow(finish, schema)


def op7_context_mixing_scores(spark, folder: str) -> DataFrame:
    """The log10 probability of every whole document; a fifth of the ids is held out."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    part = remainder("doc_id", 5)
    return score_texts(docs, "doc_id", "text", part == 1, part != 1)
