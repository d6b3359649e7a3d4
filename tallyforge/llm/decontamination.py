"""Benchmark leaks: a prefix-filtered set join of item windows with whole documents.

A window is `window` consecutive words of an item (the whole item if it has fewer). Its tokens are the
shingles of up to three words it holds. Shingles are ordered by how many places of the corpus hold them,
rarest first. A stretch of text that holds a share `containment` of the window's shingles must hold one of the
first `n - ceil(containment * n) + 1` of them: only these prefixes are joined with the documents. The place
of the shingle in window and text bounds where the window may lie (it must fit into the text), and the words
found there are compared with the window's.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallyforge.llm import filters
from tallyforge.llm.words import ALPHANUMERIC, LOWER, Words, bounded_batches, membership, pieces, run_hashes, run_in_text, split, word_hashes
from tallyforge.session import stored

WINDOW_WORDS, SHINGLE_WORDS = 10, 3


def _words(data: np.ndarray, offsets: np.ndarray) -> Words:
    return split(LOWER[data], offsets, ALPHANUMERIC)


def _shingles(words: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of every shingle; shingles of different lengths have different hashes."""
    hashes = run_hashes(word_hashes(words, seed=length), length)
    here = np.flatnonzero(run_in_text(words, length))
    return here, hashes[here]


def item_windows(items: DataFrame, key: str, text: str, window: int, shingle: int) -> DataFrame:
    """`item`, `window` (its words, joined), `size`, and for each shingle of it `h`, `length` and `place` (the first word in the window)."""

    def run(batches):
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for a, _, data, offsets in pieces(batch.column(1)):
                words = _words(data, offsets)
                for i, (first, last) in enumerate(zip(words.first[:-1], words.first[1:])):
                    size = int(min(window, last - first))
                    if not size:
                        continue
                    length = min(shingle, size)
                    own = Words(words.data, words.starts[first:last], words.ends[first:last], np.array([0, last - first]))
                    _, hashes = _shingles(own, length)
                    spelled = [own.data[s:e].tobytes().decode("utf-8", "replace") for s, e in zip(own.starts, own.ends)]
                    item = batch.column(0)[a + i].as_py()
                    for start in range(len(own) - size + 1):
                        for place in range(size - length + 1):
                            row = (item, " ".join(spelled[start : start + size]), size, int(hashes[start + place].view(np.int64)), length, place)
                            for column, value in zip(out, row):
                                column.append(value)
            kinds = (pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)], ["item", "window", "size", "h", "length", "place"])

    return items.select(F.col(key).cast("string"), text).mapInArrow(run, "item string, window string, size int, h long, length int, place int")


def _shingle_counts(docs: DataFrame, text: str, lengths: list[int], bits) -> DataFrame:
    """How often the shingles of the filter stand in all whole texts: `h`, `n`. Counted in each task before they are shuffled."""

    def run(batches):
        for batch in batches:
            for _, _, data, offsets in pieces(batch.column(0)):
                words = _words(data, offsets)
                hashes = np.concatenate([_shingles(words, length)[1] for length in lengths])
                h, n = np.unique(hashes[membership(bits.value, hashes)], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], ["h", "n"])

    return docs.select(text).mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def _prefixes(windows: DataFrame, counts: DataFrame, containment: float) -> DataFrame:
    """The rows of `windows` that are in the prefix of their window."""
    rarity = Window.partitionBy("window").orderBy("n", "h", "place")
    shingles = F.col("size") - F.col("length") + 1
    return (
        windows.dropDuplicates(["window", "place"]).drop("item")
        .join(counts, "h", "left").fillna(0, ["n"])
        .withColumn("rank", F.row_number().over(rarity))
        .where(F.col("rank") <= shingles - F.ceil(shingles * F.lit(containment)) + 1)
        .select("window", "size", "h", "length", "place")
    )


def _candidates(docs: DataFrame, key: str, text: str, lengths: list[int], bits, window: int, shingle: int) -> DataFrame:
    """`key`, `n_words` and `found`: where a text may hold a prefix shingle, with the words around it."""
    kind = docs.schema[key].dataType.simpleString()
    place = pa.struct([("h", pa.int64()), ("length", pa.int32()), ("at", pa.int64()), ("first", pa.int64()), ("around", pa.string())])

    def run(batches):
        for batch in batches:
            number, found = [], []
            for _, _, data, offsets in pieces(batch.column(1)):
                words = _words(data, offsets)
                owner = words.text_of()
                here: list[list] = [[] for _ in range(len(offsets) - 1)]
                for length in lengths:
                    reach = window - length if length == shingle else 0  # shorter shingles are whole items
                    start, hashes = _shingles(words, length)
                    hit = membership(bits.value, hashes)
                    for at, h in zip(start[hit].tolist(), hashes[hit].view(np.int64).tolist()):
                        text_no = owner[at]
                        head = int(words.first[text_no])
                        first, last = max(head, at - reach), min(int(words.first[text_no + 1]), at + length + reach)
                        around = " ".join(words.data[s:e].tobytes().decode("utf-8", "replace") for s, e in zip(words.starts[first:last], words.ends[first:last]))
                        here[text_no].append({"h": h, "length": length, "at": at - head, "first": first - head, "around": around})
                found += here
                number += words.counts().tolist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(number, pa.int64()), pa.array(found, pa.list_(place))], [key, "n_words", "found"])

    shape = "array<struct<h:long,length:int,at:long,first:long,around:string>>"
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_words long, found {shape}")


def _matches(found: DataFrame, prefixes: DataFrame, containment: float) -> DataFrame:
    """`row`, `window`, `start` and `size` of the stretches that hold enough of a window's shingles, at their places."""
    start = F.col("at") - F.col("place")
    ours = F.slice(F.split("around", " "), (F.col("start") - F.col("first") + 1).cast("int"), F.col("size"))
    theirs = F.split("window", " ")
    shingles = F.col("size") - F.col("length") + 1
    same = F.filter(
        F.sequence(F.lit(1), shingles),
        lambda i: F.slice(F.col("ours"), i, F.col("length")) == F.slice(F.col("theirs"), i, F.col("length")),
    )
    return (
        found.join(prefixes, ["h", "length"]).withColumn("start", start)
        # Position and length: the window has to lie inside the text.
        .where((F.col("start") >= 0) & (F.col("start") + F.col("size") <= F.col("n_words")))
        .withColumns({"ours": ours, "theirs": theirs})
        .where(F.size(same) >= F.ceil(shingles * F.lit(containment)))
        .select("row", "window", "start", "size").distinct()
    )


def contaminated(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
    window: int = WINDOW_WORDS, shingle: int = SHINGLE_WORDS, containment: float = 1.0,
) -> DataFrame:
    """For each row of `docs`: `key`, `n_words`, `n_hit` (words inside a window of an item) and `items`, the sorted ids as text.

    With `containment` 1 a window occurs where its words stand consecutively. Lower-cases A-Z; words are
    runs of letters, digits and everything beyond ASCII. Null and empty texts have no words. An item without
    words has no windows; one with a null id marks words but isn't listed; repeated items count once. Repeated
    rows of `docs` and rows with a null key get a row each. Other columns are ignored. Whole texts are searched.
    Only filters of a fixed size are broadcast; windows and documents meet in a shuffled join.
    """
    broadcast = bounded_batches(docs).sparkSession.sparkContext.broadcast
    windows = stored(item_windows(items, item_key, item_text, window, shingle), "item-windows")
    lengths = sorted(r.length for r in windows.select("length").distinct().collect()) or [shingle]  # at most `shingle` values
    counts = _shingle_counts(docs, text, lengths, broadcast(filters.build(windows, "h")))
    prefixes = stored(_prefixes(windows, counts, containment), "prefixes")
    rows = _candidates(docs, key, text, lengths, broadcast(filters.build(prefixes, "h")), window, shingle)
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "candidates")
    found = rows.select("row", "n_words", F.explode("found").alias("f")).select("row", "n_words", "f.*")
    matches = stored(_matches(found, prefixes, containment), "matches")
    covered = (
        matches.groupBy("row").agg(F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("size")).alias("stop")))).alias("spans"))
        .select("row", F.expr(
            "aggregate(spans, struct(0L as n, 0L as upto), (a, s) -> struct("
            "a.n + greatest(0L, s.stop - greatest(a.upto, s.start)) as n, greatest(a.upto, s.stop) as upto), a -> a.n)"
        ).alias("n_hit"))
    )
    named = (
        matches.select("row", "window").distinct().join(windows.select("window", "item").distinct(), "window")
        .groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    hits = covered.join(named, "row")
    return rows.select("row", key, "n_words").join(hits, "row", "left").select(
        key, "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items")
    )


def op3_prefix_filtered_decontamination(spark, folder: str) -> DataFrame:
    """Which words of every document stand in windows of benchmark items."""
    found = contaminated(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )
