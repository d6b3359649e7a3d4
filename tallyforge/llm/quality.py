"""Quality by perplexity: an interpolated modified Kneser-Ney n-gram model of characters, trained on trusted text.

Pieces of text send their distinct n-grams to shards. The n-grams of the trusted text are counted there, and joins of
count tables, order by order, give the probability of every n-gram that occurs anywhere, seen in training or not. The
shards answer the pieces, which add up the perplexity of each text. A text is kept if its perplexity lies between
bounds set from the quantiles of its language.

Units of several pieces are formed twice by the same scan, and a unit is named by a hash of its content. Should a second scan
form others, which a table in files doesn't, the run fails instead of scoring texts with the wrong counts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tallyforge.llm.exchange import answers_by_piece, as_words, found_for, packed, shards_for, unpacked, vocabulary_of
from tallyforge.llm.words import bounded_batches, pieces
from tallyforge.session import remove, scratch, shared_dir, stored

ORDER = 5
PIECE_BYTES, UNIT_BYTES = 1 << 21, 1 << 23
#: The bounds lie this many times the distance between two quantiles of the log perplexity beyond them. Both are in the
#: lower half, as bad texts have high perplexities: up to half of the texts can be bad without moving the bounds much.
QUANTILES = (0.1, 0.5)
REACH = 4.0
#: The mean of few characters strays further: the bounds of a text are widened by this over the root of its length, on the logarithmic scale.
SHORT_TEXTS = 4.5
#: Log perplexities are counted in steps of this size to find the quantiles.
STEP = 1e-3
_START, _END = 0x110000, 0x110001
_WIDTH = 3  # bytes for a character
_ROOM = 1 << 24  # up to so many possible numbers a table of them is used, beyond that a sort


def _lines(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The characters of some texts, each after `order - 1` start marks and before an end mark; the first character of each text."""
    codes = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), "<u4")
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    marks = np.concatenate([[_END], np.full(order - 1, _START)])
    line = np.insert(codes.astype(np.int64), np.repeat(chars[1:], order), np.tile(marks, len(chars) - 1))
    line = np.concatenate([np.full(order - 1, _START), line[: len(line) - (order - 1)]])
    return line, chars + np.arange(len(chars)) * order


def _numbered(key: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """The place of one example of each distinct key below `room`, in the order of the keys, and the number of every key in it."""
    if room > _ROOM:
        _, example, number = np.unique(key, return_index=True, return_inverse=True)
        return example.astype(np.int32), number.astype(np.int32)
    example = np.full(room, -1, np.int32)
    example[key] = np.arange(len(key), dtype=np.int32)
    there = example >= 0
    return example[there], (np.cumsum(there, dtype=np.int32) - np.int32(1))[key]


def _grams(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct n-grams, one row of characters each; the n-gram that ends at each character or end mark; the first of each text."""
    line, first = _lines(data, offsets, order)
    if not len(line):
        return np.empty((0, order), np.int64), np.empty(0, np.int64), first
    used, codes = _numbered(line, _END + 1)
    example, number = used, codes
    for k in range(1, order):
        # Runs of k characters, numbered already, and the character after each.
        key = number[: len(codes) - k].astype(np.int64) * len(used) + codes[k:]
        example, number = _numbered(key, len(example) * len(used))
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    here = np.flatnonzero(owner[: len(number)] == owner[order - 1 :])
    seen = np.zeros(len(example), bool)
    seen[number[here]] = True
    distinct = np.flatnonzero(seen)
    place = (np.cumsum(seen) - 1)[number[here]]
    return line[example[distinct][:, None] + np.arange(order)], place, np.searchsorted(here, first)


def _as_bytes(grams: np.ndarray) -> np.ndarray:
    return np.stack([grams >> 16, grams >> 8 & 255, grams & 255], axis=2).astype(np.uint8).reshape(-1)


def _piece_name(digest) -> int:
    return int.from_bytes(digest.digest()[:8], "little", signed=True)


class _Units:
    """Cuts the rows of a task into units: runs of pieces of up to `UNIT_BYTES` of text. The same rows make the same units."""

    def __init__(self, batches):
        self.batches = batches

    def __iter__(self):
        """For each unit its name, and its pieces: rows of a batch, bytes and offsets."""
        held, size, digest = [], 0, hashlib.blake2b()
        for batch in self.batches:
            for a, b, data, offsets in pieces(batch.column(1), PIECE_BYTES):
                if held and size + len(data) > UNIT_BYTES:
                    yield _piece_name(digest), held
                    held, size, digest = [], 0, hashlib.blake2b()
                part = batch.slice(a, b - a)
                digest.update(repr(part.column(0).to_pylist()).encode())
                digest.update(data.tobytes())
                held.append((part, data, offsets))
                size += len(data)
        if held:
            yield _piece_name(digest), held


def _gram_array(grams: np.ndarray, order: int) -> pa.Array:
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(_WIDTH * order), len(grams), [None, pa.py_buffer(_as_bytes(grams))])


def _united(found: list[pa.Table]) -> pa.Table:
    """The distinct n-grams of all pieces of a unit, sorted, with the sums of their counts."""
    return pa.concat_tables(found).group_by("gram", use_threads=False).aggregate([("n", "sum")]).sort_by("gram").combine_chunks()


def _bytes_of(grams: pa.Array) -> np.ndarray:
    return np.frombuffer(grams.buffers()[1], np.uint8)[grams.offset * grams.type.byte_width :][: len(grams) * grams.type.byte_width]


def _chunk(column: pa.ChunkedArray) -> pa.Array:
    return column.chunk(0) if column.num_chunks else pa.array([], column.type)


def _sent(docs: DataFrame, order: int) -> DataFrame:
    """`piece`, `words` (distinct n-grams, with counts in trusted texts) and `n_words`, from `key`, `text` and `trusted`."""

    def run(batches):
        for name, held in _Units(batches):
            found = []
            for part, data, offsets in held:
                rows, place, start = _grams(data, offsets, order)
                trusted = np.repeat(part.column(2).to_numpy(zero_copy_only=False), np.diff(start))
                count = np.bincount(place[trusted], minlength=len(rows))
                found.append(pa.table([_gram_array(rows, order), pa.array(count.astype(np.int64))], ["gram", "n"]))
            unit = _united(found)
            grams, counts = _chunk(unit["gram"]), _chunk(unit["n_sum"])
            blob = packed(_bytes_of(grams), np.full(len(grams), _WIDTH * order, "<i4"), counts.to_numpy().astype("<i8"))
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([blob], pa.binary()), pa.array([len(grams)])], ["piece", "words", "n_words"])

    return docs.mapInArrow(run, "piece long, words binary, n_words long")


def _formed_once(blobs, order: int) -> tuple[list[tuple], pa.Array]:
    """The packed pieces of a unit as keys, distinct n-grams, the n-gram at each character and each text's first; all n-grams of the unit, sorted.

    A piece's n-grams are formed once and kept, four bytes a character, until the unit's values are at hand.
    """
    seen, held = [], []
    for blob in blobs:
        data, lengths, keys = unpacked(blob.as_py(), "u1", "<i8", "u1")
        rows, place, start = _grams(data, np.concatenate([[0], np.cumsum(lengths)]), order)
        listed = _gram_array(rows, order)
        held.append((keys, listed, place.astype(np.int32), start))
        seen.append(pa.table([listed, pa.array(np.zeros(len(rows), np.int64))], ["gram", "n"]))
    return held, _chunk(_united(seen)["gram"])


def _exploded(vocabulary: DataFrame) -> DataFrame:
    """`shard`, `place`, `gram` and `n`, a row for each distinct n-gram of the corpus."""

    def run(batches):
        for batch in batches:
            for shard, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                data, lengths, count = unpacked(blob.as_py(), "u1", "<i4", "<i8")
                offsets = pa.py_buffer(np.concatenate([[0], np.cumsum(lengths)]).astype("<i4"))
                grams = pa.Array.from_buffers(pa.binary(), len(lengths), [None, offsets, pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(lengths), shard, np.int32)), pa.array(np.arange(len(lengths), dtype=np.int32)), grams, pa.array(count)], ["shard", "place", "gram", "n"])

    return vocabulary.select("shard", "words").mapInArrow(run, "shard int, place int, gram binary, n long")


def _last(column: str, characters: int, of: int) -> Column:
    return F.substring(column, 1 + _WIDTH * (of - characters), _WIDTH * characters)


def _discounts(counts: DataFrame) -> list[float]:
    """The three modified Kneser-Ney discounts, from how many n-grams have the counts 1 to 4."""
    of = counts.agg(*(F.sum((F.col("c") == i).cast("long")).alias(f"n{i}") for i in range(1, 5))).first()
    n = [of[i] or 0 for i in range(4)]
    ratio = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
    found = [i + 1 - (i + 2) * ratio * n[i + 1] / n[i] if n[i] else 0.5 for i in range(3)]
    return [min(max(d, 0.05), i + 0.95) for i, d in enumerate(found)]


def gram_probabilities(grams: DataFrame, order: int = ORDER) -> DataFrame:
    """`gram` and `p`, the probability of its last character after the others, for each distinct `gram` (of `_WIDTH` bytes a character).

    `n` is the count in the trusted text. Full n-grams count by occurrence; shorter ones, cut off at the left, by how many
    different characters stand before them. Each order gives what its discounts spare to the one below; the lowest
    is interpolated with equal shares for all characters that occur and one more.
    """
    counts = stored(grams.where("n > 0").select("gram", F.col("n").alias("c")), "gram-counts")
    levels = {order: counts}
    for k in range(order - 1, 0, -1):
        shorter = levels[k + 1].select(_last("gram", k, k + 1).alias("gram"))
        levels[k] = stored(shorter.groupBy("gram").agg(F.count("*").alias("c")), "gram-counts")
    characters = grams.select(_last("gram", 1, order).alias("gram")).distinct()
    p = characters.withColumn("p", F.lit(1.0 / (characters.count() + 1)))
    for k in range(1, order + 1):
        d = _discounts(levels[k])
        spared = F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
        context = F.substring("gram", 1, _WIDTH * (k - 1)) if k > 1 else F.lit(b"")
        level = levels[k].withColumn("context", context)
        contexts = level.groupBy("context").agg(F.sum("c").alias("total"), F.sum(spared).alias("spared"))
        wanted = grams.select(_last("gram", k, order).alias("gram")).distinct() if k < order else grams.select("gram")
        joined = (
            wanted.join(levels[k], "gram", "left").withColumns({"context": context, "rest": _last("gram", k - 1, k) if k > 1 else F.col("gram")})
            .join(contexts, "context", "left").join(p.select(F.col("gram").alias("rest"), F.col("p").alias("lower")), "rest")
        )
        own = F.greatest(F.lit(0.0), F.coalesce("c", F.lit(0)) - F.when(F.col("c").isNull(), 0.0).otherwise(spared))
        p = joined.select("gram", F.when(F.col("total").isNull(), F.col("lower")).otherwise((own + F.col("spared") * F.col("lower")) / F.col("total")).alias("p"))
        p = stored(p, "gram-probabilities")
    return p


def perplexities(docs: DataFrame, trusted: Column, key: str = "doc_id", text: str = "text", lang: str = "lang", order: int = ORDER) -> DataFrame:
    """`key`, `lang`, `n_chars` and `perplexity` (per character and end of text) for every row of `docs`, under the model of the rows where `trusted` holds.

    Null texts are empty and consist of their end. Null keys and repeated rows get a row each; other columns are ignored. Whole
    texts are counted and scored. Without trusted text all characters are equally likely. `docs` has to be read from files.
    """
    source = bounded_batches(docs).select(F.col(key).alias("key"), F.col(text).alias("text"), F.coalesce(trusted, F.lit(False)).alias("trusted"), F.col(lang).alias("lang"))
    spark = docs.sparkSession
    pieces_folder, values_folder = shared_dir(spark, "gram-pieces"), shared_dir(spark, "gram-values")
    # The same columns as in the second scan, as the size of a batch is one of bytes.
    made = _sent(source, order)
    made.write.parquet(pieces_folder)
    sent = spark.read.schema(made.schema).parquet(pieces_folder)
    shards = shards_for(sent, "n_words")
    vocabulary = vocabulary_of(sent, shards)
    remove(spark, pieces_folder)  # the vocabulary is stored and has all of it

    def pack_values(batches):
        for batch in batches:
            for shard, found in zip(batch.column(0).to_pylist(), batch.column(1)):
                values = np.log(found.values.field("p").to_numpy()).astype("<f4")
                yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([packed(values)], pa.binary())], ["shard", "found"])

    with scratch(spark):  # n-grams and their probabilities, a row each, go before the texts are sent
        grams = stored(_exploded(vocabulary), "grams")
        known = grams.join(gram_probabilities(grams.select("gram", "n"), order), "gram").select("shard", "place", "p")
        listed = known.groupBy("shard").agg(F.array_sort(F.collect_list(F.struct("place", "p"))).alias("found"))
        found = listed.select("shard", "found.p").select("shard", F.transform("p", lambda x: F.struct(x.alias("p"))).alias("found"))
        found.mapInArrow(pack_values, "shard int, found binary").write.parquet(values_folder)
    values = spark.read.schema("shard int, found binary").parquet(values_folder)
    answers = answers_by_piece(vocabulary, values, ("<f4",))

    def form(batches):
        """The same units as were sent, packed piece by piece."""
        for name, held in _Units(batches):
            blobs = []
            for part, data, offsets in held:
                table = pa.Table.from_arrays([part.column(0), part.column(3)], ["key", "lang"])
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, table.schema) as writer:
                    writer.write_table(table)
                blobs.append(packed(data, np.diff(offsets).astype("<i8"), np.frombuffer(sink.getvalue(), np.uint8)))
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([blobs], pa.list_(pa.binary()))], ["piece", "rows"])

    def finish(batches):
        for batch in batches:
            for blobs, found in zip(batch.column(0), batch.column(1)):
                if not found.is_valid:
                    raise ValueError("the texts were read in other pieces than before; store them first")
                held, grams = _formed_once(blobs, order)
                (logs,) = found_for(as_words(_bytes_of(grams), np.full(len(grams), _WIDTH * order, np.int64)), shards, found, ("<f4",))
                for keys, listed, place, start in held:
                    keys = pa.ipc.open_stream(keys.tobytes()).read_all().combine_chunks().to_batches()[0]
                    own = logs[pc.index_in(listed, value_set=grams).to_numpy()]
                    each = np.diff(start)  # characters and the end of the text
                    total = np.add.reduceat(own[place].astype(np.float64), start[:-1])
                    yield pa.RecordBatch.from_arrays([keys.column(0), keys.column(1), pa.array(each - 1), pa.array(np.exp(-total / each))], ["key", "lang", "n_chars", "perplexity"])

    formed = source.mapInArrow(form, "piece long, rows array<binary>")
    fields = [T.StructField(n, k) for n, k in (("key", docs.schema[key].dataType), ("lang", docs.schema[lang].dataType), ("n_chars", T.LongType()), ("perplexity", T.DoubleType()))]
    return formed.join(answers, "piece", "left").select("rows", "answers").mapInArrow(finish, T.StructType(fields)).withColumnRenamed("key", key)


def language_bounds(scored: DataFrame, quantiles: tuple[float, float] = QUANTILES, reach: float = REACH) -> DataFrame:
    """`lang`, `low` and `high`: perplexities beyond two quantiles of each language by `reach` times their distance, on a logarithmic scale.

    Quantiles come from counts in steps of 0.1 % over all rows; a null language is one of its own.
    """
    steps = scored.groupBy("lang", F.round(F.log("perplexity") / STEP).cast("long").alias("step")).agg(F.count("*").alias("n"))
    up_to = Window.partitionBy("lang").orderBy("step")
    share = steps.withColumn("upto", F.sum("n").over(up_to) / F.sum("n").over(Window.partitionBy("lang")))
    at = [F.min(F.when(F.col("upto") >= q, F.col("step"))).alias(name) for q, name in zip(quantiles, ("first", "second"))]
    wide = share.groupBy("lang").agg(*at).withColumn("room", reach * (F.col("second") - F.col("first") + 1))
    return wide.select("lang", F.exp((F.col("first") - F.col("room")) * STEP).alias("low"), F.exp((F.col("second") + F.col("room")) * STEP).alias("high"))


def judge(docs: DataFrame, trusted: Column, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of `perplexities` with the bounds of their language and `kept`. An empty text is kept out."""
    scored = stored(perplexities(docs, trusted, key, text, lang), "perplexities")
    bounds = language_bounds(scored).withColumnRenamed("lang", "of")
    wider = F.exp(SHORT_TEXTS / F.sqrt(F.col("n_chars") + 1))
    return scored.join(bounds, F.col("lang").eqNullSafe(F.col("of"))).select(
        key, "lang", "n_chars", "perplexity", (F.col("low") / wider).alias("low"), (F.col("high") * wider).alias("high"),
    ).withColumn(
        "kept", F.col("perplexity").between(F.col("low"), F.col("high")) & (F.col("n_chars") > 0)
    )


def training_ids(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """The ids of all documents labelled as good, once each."""
    return labels.where("quality = 1").select(key).where(F.col(key).isNotNull()).distinct()


def op10_kneser_ney_quality(spark, folder: str) -> DataFrame:
    """Every document with its perplexity under a model of all documents labelled as good, and whether it is kept.

    Ids of good documents are broadcast, a number each: a join by shuffle would send the texts.
    """
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang")
    ids = training_ids(spark.read.parquet(f"{folder}/labels.parquet")).withColumn("trusted", F.lit(True))
    return judge(docs.join(F.broadcast(ids), "doc_id", "left"), F.col("trusted"))
