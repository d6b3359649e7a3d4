"""Ranked lexical search by dense multiplication: tiles of document impacts times tiles of item weights.

Items are taken in blocks of a bounded number of terms. For a block the documents are read once: what is kept of
each is its length and the block's terms that it holds, with their counts. Document frequencies come from these by
Spark. A tile of items has a compact vocabulary, the terms of its own items; a tile of documents against it is a dense
matrix of whole-number impacts in float64, multiplied by the weights in one BLAS call. Columns are cut so that no
sum reaches 2^53, hence every product is exact; cuts are added up as 64-bit integers. A task keeps the best of each item
over all its tiles, ordered by score and key, so ties are cut where the result cuts them.
"""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import from_arrow_type

from tallyforge.llm.exchange import spelled_words
from tallyforge.llm.words import ALPHANUMERIC, LOWER, bounded_batches, pieces, split
from tallyforge.operators.numbering import number_rows
from tallyforge.session import stored

TOP = 50
#: Terms of a block of items: what is broadcast has at most these, and those of one item more.
BLOCK_TERMS = 1 << 17
ITEM_TILE, DOC_TILE = 64, 1024
#: Impacts are below this, as 1000*tf is less than the divisor.
_IMPACT = 1_000_000
_EXACT = 1 << 53
# What separates terms.
SEPARATORS = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"


def item_terms(items: DataFrame, item: str, text: str) -> DataFrame:
    """`item` and `term`, each distinct term of each item once; rows of one item are taken together. A null item id is an id."""
    lower = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    found = F.regexp_extract_all(lower, F.lit(f"[^{SEPARATORS}]+"), F.lit(0))
    return items.select(F.col(item).alias("item"), F.explode(found).alias("term")).distinct()


def _blocks(terms: DataFrame, limit: int) -> tuple[DataFrame, int]:
    """The terms with `block`, in which an item lies whole, and the number of blocks."""
    numbered = number_rows(terms, F.col("item").asc_nulls_first(), F.col("term"), name="place")
    first = numbered.groupBy("item").agg(F.floor((F.min("place") - 1) / F.lit(limit)).cast("int").alias("block"))
    laid = stored(numbered.join(first.withColumnRenamed("item", "id"), F.col("item").eqNullSafe(F.col("id"))).select("item", "term", "block"), "item-terms")
    last = laid.agg(F.max("block")).first()[0]
    return laid, 0 if last is None else last + 1


def postings(docs: DataFrame, key: str, text: str, vocabulary: pa.Array) -> DataFrame:
    """`key`, `n` (terms with repeats), `terms` (places in the vocabulary, ascending) and `tf`, for every row of `docs`."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary.cast(pa.large_binary()))
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        size = len(known.value)
        for batch in batches:
            for first, last, data, offsets in pieces(batch.column(1)):
                words = split(LOWER[data], offsets, ALPHANUMERIC)
                spelled, lengths = spelled_words(words, np.arange(len(words)))
                ends = pa.py_buffer(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64))
                array = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words), [None, ends, pa.py_buffer(spelled)])
                at = pc.fill_null(pc.index_in(array, value_set=known.value), -1).to_numpy(zero_copy_only=False).astype(np.int64)
                mine = np.flatnonzero(at >= 0)
                pairs, tf = np.unique(words.text_of()[mine] * size + at[mine], return_counts=True)
                text_of = pairs // max(1, size)
                cuts = np.searchsorted(text_of, np.arange(last - first + 1)).astype(np.int32)
                columns = [pa.array((pairs - text_of * size).astype(np.int32)), pa.array(tf.astype(np.int32))]
                lists = [pa.ListArray.from_arrays(cuts, c) for c in columns]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), pa.array(words.counts()), *lists], ["key", "n", "terms", "tf"])

    rows = bounded_batches(docs).select(F.col(key).alias("key"), text)
    return rows.mapInArrow(run, f"key {kind}, n long, terms array<int>, tf array<int>")


def weights_of(frequencies: np.ndarray, documents: int) -> np.ndarray:
    """The weight of each term, from how many documents hold it."""
    return np.floor(1000 * np.log((2 * documents + 2) / (2 * frequencies + 1))).astype(np.int64)


class ItemTiles:
    """The weights of a block of items, as dense matrices over the terms of a few items each.

    `item_at` and `term_at` are the pairs of the block. For each tile: its items, its terms, and the
    column ranges in which no sum of impact times weight reaches 2^53.
    """

    def __init__(self, item_at: np.ndarray, term_at: np.ndarray, weight: np.ndarray, tile: int = ITEM_TILE):
        self.tiles = []
        self.terms = len(weight)
        cut = max(1, (_EXACT - 1) // (_IMPACT * max(1, int(weight.max(initial=0)))))
        for first in range(0, int(item_at.max(initial=-1)) + 1, tile):
            mine = (item_at >= first) & (item_at < first + tile)
            terms, column = np.unique(term_at[mine], return_inverse=True)
            matrix = np.zeros((len(terms), tile))
            matrix[column, item_at[mine] - first] = weight[term_at[mine]]
            spans = [(a, min(len(terms), a + cut)) for a in range(0, len(terms), cut)]
            self.tiles.append((first, terms, matrix, spans))

    def scores(self, doc: np.ndarray, terms: np.ndarray, impacts: np.ndarray, docs: int):
        """For each tile of items: its first item, and the scores of `docs` documents as whole numbers."""
        for first, mine, matrix, spans in self.tiles:
            column = np.full(self.terms, -1)
            column[mine] = np.arange(len(mine))
            at = column[terms]
            has = at >= 0
            dense = np.zeros((docs, len(mine)))
            dense[doc[has], at[has]] = impacts[has]
            total = np.zeros((docs, matrix.shape[1]), np.int64)
            for a, b in spans:
                total += (dense[:, a:b] @ matrix[a:b]).astype(np.int64)
            yield first, total


class Best:
    """The `top` best of each item so far: highest score first, then by key, nulls last."""

    def __init__(self, items: int, top: int):
        self.top, self.least = top, np.ones(items, np.int64)
        self.held: list[pa.Table] = []
        self.rows = 0

    def add(self, item: np.ndarray, score: np.ndarray, keys: pa.Array) -> None:
        """Candidates, which should have at least the score `least` of their item."""
        if len(item):
            self.held.append(pa.table({"item": item, "score": score, "key": keys}))
            self.rows += len(item)
            if self.rows > 4 * self.top * len(self.least) + DOC_TILE:
                self.cut()

    def cut(self) -> pa.Table | None:
        """Drop what is surely not among the best; the rest, in order."""
        if not self.held:
            return None
        rows = pa.concat_tables(self.held).combine_chunks()
        rows = rows.take(pc.sort_indices(rows, [("item", "ascending"), ("score", "descending"), ("key", "ascending")], null_placement="at_end"))
        item = rows.column("item").to_numpy()
        place = np.arange(len(item)) - np.searchsorted(item, item)
        rows = rows.filter(pa.array(place < self.top))
        full = np.flatnonzero(place == self.top - 1)
        self.least[item[full]] = np.maximum(self.least[item[full]], rows.column("score").to_numpy()[np.flatnonzero(place[place < self.top] == self.top - 1)])
        self.held, self.rows = [rows], len(rows)
        return rows


def _best_of_block(found: DataFrame, names: pa.Array, tiles: ItemTiles, documents: int, total: int, top: int) -> DataFrame:
    """`item`, `key` and `score`: the best documents of each task for each item of a block."""
    spark = found.sparkSession
    shared = spark.sparkContext.broadcast((names, tiles))
    kinds = found.schema["key"].dataType.simpleString()

    def run(batches):
        names, tiles = shared.value
        best = Best(len(names), top)
        for whole in batches:
            for first in range(0, whole.num_rows, DOC_TILE):
                batch = whole.slice(first, DOC_TILE)
                n = batch.column(1).to_numpy()
                terms, tf = (batch.column(i).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for i in (2, 3))
                doc = np.repeat(np.arange(len(n)), pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False))
                # In Python's whole numbers, as a product may pass 64 bits.
                share = np.array([50 * int(x) * documents // total for x in n], np.int64) if total else n
                m = 100 - 50 + share
                impacts = 1_000_000_000 * tf // (1000 * tf + 20 * m[doc])
                for start, scores in tiles.scores(doc, terms, impacts, len(n)):
                    scores = scores[:, : len(names) - start]
                    row, item = np.nonzero(scores >= best.least[start : start + scores.shape[1]])
                    best.add(item + start, scores[row, item], batch.column(0).take(pa.array(row)))
        rows = best.cut()
        if rows is not None:
            rows = rows.combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [names.take(rows.column("item").combine_chunks()), rows.column("key").combine_chunks(), rows.column("score").combine_chunks()], ["item", "key", "score"]
            )

    return found.mapInArrow(run, f"item {from_arrow_type(names.type).simpleString()}, key {kinds}, score long")


def _first(rows: DataFrame, by: list, top: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.col("key").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def rank(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
    top: int = TOP, block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """`item`, `rank` (from 1), `key` and `score`: the `top` documents with the highest scores above 0 for each item.

    Terms are runs of letters, digits and everything beyond ASCII; only A-Z is lower-cased. Texts that are null or empty have
    none: such a document is in no result, such an item has no rows. Equal scores go by ascending key, a null key last;
    repeated rows of documents are ranked each, rows of one item id are one item with the terms of all. Texts are taken
    whole, other columns are ignored. An empty table on either side gives no rows. `key` and `item` may have the same name
    as any other column; the result names them `key` and `item` as given. `block_terms` changes no result.
    """
    spark = docs.sparkSession
    laid, blocks = _blocks(item_terms(items, item, item_text), block_terms)
    out = None
    for block in range(blocks):
        rows = laid.where(F.col("block") == block).select("item", "term").toArrow().combine_chunks()
        coded = [rows.column(c).combine_chunks().dictionary_encode(null_encoding="encode") for c in ("item", "term")]
        (names, item_at), (vocabulary, term_at) = ((c.dictionary, c.indices.to_numpy().astype(np.int64)) for c in coded)
        found = stored(postings(docs, key, text, vocabulary), "postings")
        n = found.where("n > 0").agg(F.count("*"), F.sum("n")).first()
        documents, total = n[0], n[1] or 0
        held = found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).toPandas()
        frequencies = np.zeros(len(vocabulary), np.int64)
        frequencies[held["term"].to_numpy(np.int64)] = held["df"].to_numpy(np.int64)
        tiles = ItemTiles(item_at, term_at, weights_of(frequencies, documents))
        best = _best_of_block(found, names, tiles, documents, total, top)
        salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        best = _first(best.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts))), ["item", "salt"], top)
        out = best.select("item", "key", "score") if out is None else out.unionByName(best.select("item", "key", "score"))
    if out is None:
        kinds = {n: t for n, t in docs.dtypes}, {n: t for n, t in items.dtypes}
        out = spark.createDataFrame([], f"item {kinds[1][item]}, key {kinds[0][key]}, score long")
    return _first(out, ["item"], top).select(F.col("item").alias(item), F.col("rank").cast("int"), F.col("key").alias(key), "score")


def op12_dense_ranked_search(spark, folder: str) -> DataFrame:
    """The 50 best documents for each benchmark item."""
    return rank(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet"))


_TERMS = f"regexp_extract_all(translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[^{SEPARATORS}]+')"

OP12_SQL = f"""
WITH found AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
counted AS (SELECT doc_id, term, count(*) AS tf FROM found GROUP BY doc_id, term),
lengths AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM counted GROUP BY doc_id),
totals AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM lengths),
wanted AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark)),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * max(nn) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM counted CROSS JOIN totals GROUP BY term
),
scored AS (
    SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * nn) // ll)))) AS BIGINT) AS score
    FROM wanted JOIN counted USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id) CROSS JOIN totals
    GROUP BY item_id, doc_id
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
    SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
    FROM scored WHERE score > 0
) WHERE rank <= 50
"""
