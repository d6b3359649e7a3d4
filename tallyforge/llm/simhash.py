"""SimHash near-duplicates: 64-bit fingerprints, compared exactly, tile against tile.

Fingerprints within the radius differ in their population count by at most the radius, and so do the
population counts of their four quarters added up. Distinct fingerprints are laid out in cells by these
four counts, cells are cut into tiles of bounded size, and only tiles of cells within the radius are
compared, by exclusive-or and bit counts. A tile pair reports one link per fingerprint to the smallest one
it reaches inside the pair, never all pairs.
"""

from __future__ import annotations

from itertools import product
from math import ceil, log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tallyforge.llm.graph import components
from tallyforge.llm.grouped import by_key, local_roots
from tallyforge.llm.words import LOWER, UNSPACED, bounded_batches, joined, mixed, pieces, split
from tallyforge.session import stored

SHINGLE_WORDS, SEED, RADIUS = 3, 42, 2
TILE_ROWS = 1 << 13
_HASHES_AT_ONCE = 1 << 17
#: Wide fingerprints: 64-bit words of one. Blocks of them: bits in which the members of a block agree, and kinds of blocks, for
#: up to `BLOCK_ROWS` members a block in the mean; with these, at a cosine of 8/9, a pair misses all blocks with a chance of 1 in 115.
FP_WORDS = 4
BLOCK_BITS, BLOCK_KINDS, BLOCK_ROWS, KINDS_GROWTH = 14, 64, 256, 1.22
GROUP_ROWS, LAGS = 1 << 16, 1 << 10
_KINDS_AT_ONCE = 8  # in one batch from a task
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _shingle_spans(words, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last word of each shingle, and the text it is of."""
    counts = words.counts()
    of_text = np.where(counts == 0, 0, np.maximum(counts - length + 1, 1))
    text = np.repeat(np.arange(len(counts)), of_text)
    within = np.arange(len(text)) - np.repeat(np.cumsum(of_text) - of_text, of_text)
    first = words.first[text] + within
    return first, np.minimum(first + length, words.first[text + 1]) - 1, text


def fingerprints_of(data: np.ndarray, offsets: np.ndarray, length: int = SHINGLE_WORDS) -> np.ndarray:
    """The fingerprint of each text; 0 for a text without words."""
    words = split(LOWER[data], offsets, UNSPACED)
    text_data, starts, ends = joined(words, UNSPACED)
    first, last, text = _shingle_spans(words, length)
    texts = len(offsets) - 1
    set_bits = np.zeros((texts, 64), np.int64)
    for at in range(0, len(first), _HASHES_AT_ONCE):
        part = slice(at, at + _HASHES_AT_ONCE)
        spans = zip(starts[first[part]].tolist(), ends[last[part]].tolist())
        hashes = np.array([xxhash.xxh64_intdigest(text_data[s:e], SEED) for s, e in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        owner = text[part]
        heads = np.flatnonzero(np.diff(owner, prepend=-1))
        set_bits[owner[heads]] += np.add.reduceat(bits, heads, axis=0, dtype=np.int32)
    shingles = np.bincount(text, minlength=texts)
    majority = (2 * set_bits > shingles[:, None]).astype(np.uint8)
    return np.packbits(majority, axis=1, bitorder="little").reshape(-1).view("<u8")


def fingerprints(docs: DataFrame, key: str, text: str, length: int = SHINGLE_WORDS) -> DataFrame:
    """`key` and `fp`, the fingerprint as a signed long, for every row."""

    def run(batches):
        for batch in batches:
            found = [fingerprints_of(data, offsets, length) for _, _, data, offsets in pieces(batch.column(1))]
            values = np.concatenate(found).view(np.int64) if found else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], [key, "fp"])

    kind = docs.schema[key].dataType.simpleString()
    return bounded_batches(docs).select(key, text).mapInArrow(run, f"`{key}` {kind}, fp long")


def _steps(radius: int) -> list[tuple[int, ...]]:
    """Differences of four counts within the radius; of each and its negative only one."""
    span = range(-radius, radius + 1)
    return [s for s in product(span, repeat=4) if sum(map(abs, s)) <= radius and s >= (0, 0, 0, 0)]


def _cell(counts: np.ndarray) -> np.ndarray:
    return counts @ np.array([17**3, 17**2, 17, 1])


def _quarter_counts(fps: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fps.view(np.uint16).reshape(-1, 4)).astype(np.int64)


def _near_in_tiles(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between fingerprints of two tiles (or of one tile, given twice): each with the smallest it reaches."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    at_a, at_b = place[: len(a)], place[len(a) :]
    root = np.arange(len(nodes))
    rows = max(1, (1 << 21) // max(1, len(b)))
    for first in range(0, len(a), rows):
        i, j = np.nonzero(np.bitwise_count(a[first : first + rows, None] ^ b[None, :]) <= radius)
        # Links of this strip, on top of those already known.
        known = np.flatnonzero(root != np.arange(len(nodes)))
        root = local_roots(len(nodes), np.concatenate([at_a[first + i], known]), np.concatenate([at_b[j], root[known]]))
    linked = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[linked], nodes[root[linked]]


def near_links(fps: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Links `a`, `b` that join distinct fingerprints (column `fp`) into the components of 'differs in at most `radius` bits'."""
    steps = np.array(_steps(radius))

    def cells(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(_cell(_quarter_counts(fp))), batch.column(0)], ["cell", "fp"])

    homes = stored(fps.select("fp").mapInArrow(cells, "cell long, fp long"), "cells")
    tiles = homes.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(tile_rows)).cast("int").alias("tiles"))
    homes = homes.join(tiles, "cell").withColumn("tile", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int"))

    def reach(batches):
        """Every cell within the radius, once for each pair of cells, as the other side of the pair."""
        for batch in batches:
            counts = _quarter_counts(batch.column(1).to_numpy(zero_copy_only=False))
            for step in steps:
                other = counts + step
                here = np.flatnonzero(((other >= 0) & (other <= 16)).all(axis=1))
                part = batch.take(pa.array(here))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(_cell(other[here]))], ["cell", "fp", "tile", "to"])

    # A tile is compared with each tile of the cells it reaches. Both sides name the pair the same way.
    schema = "cell long, fp long, tile int, to long"
    sent = homes.select("cell", "fp", "tile").mapInArrow(reach, schema)
    others = tiles.select(F.col("cell").alias("to"), F.col("tiles").alias("to_tiles"))
    pair = F.xxhash64("cell", "tile", "to", "to_tile")
    left = (
        sent.join(others, "to")
        .withColumn("to_tile", F.explode(F.sequence(F.lit(0), F.col("to_tiles") - 1)))
        .where("cell != to or tile <= to_tile")
        .select(pair.alias("pair"), F.lit(0).cast("byte").alias("side"), "fp")
    )
    back = -steps

    def reached(batches):
        """The same pairs, seen from the cell that is reached."""
        for batch in batches:
            counts = _quarter_counts(batch.column(1).to_numpy(zero_copy_only=False))
            for step in back:
                other = counts + step
                here = np.flatnonzero(((other >= 0) & (other <= 16)).all(axis=1))
                part = batch.take(pa.array(here))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), pa.array(_cell(other[here]))], ["to", "fp", "to_tile", "cell"])

    right = (
        homes.select("cell", "fp", "tile").mapInArrow(reached, "to long, fp long, to_tile int, cell long")
        .join(tiles, "cell")
        .withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .where("cell != to or tile <= to_tile")
        .select(pair.alias("pair"), F.lit(1).cast("byte").alias("side"), "fp")
    )

    def compare(batches):
        for _, group in by_key(batches):
            side = group.column("side").to_numpy()
            fp = group.column("fp").to_numpy().view(np.uint64)
            a, b = fp[side == 0], fp[side == 1]
            if len(a) and len(b):
                found = _near_in_tiles(a, b, radius)
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in found], ["a", "b"])

    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return left.unionByName(right).repartition(parts, "pair").sortWithinPartitions("pair").mapInArrow(compare, "a long, b long")


def wide_fingerprints(found: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The fingerprint of each set of shingle hashes, `FP_WORDS` words of 64 bits; 0 for an empty set.

    A bit is the sign of a sum of weights, one for each shingle: on which side of a random plane the set lies, so two sets differ in a bit
    with a chance of the angle between them over pi. A weight is one of 256 values, which a byte of the shingle's hash picks.
    """
    texts, sizes = len(starts) - 1, np.diff(starts)
    full = np.flatnonzero(sizes)
    bits = np.zeros((FP_WORDS * 64, texts), bool)
    if len(full):
        weights = np.random.default_rng(SEED).permuted(np.tile(np.arange(256, dtype=np.uint64), (8, 1)), axis=1)
        # Four sums of 16 bits side by side in a word; a run of 256 weights below 256 fits.
        four = [sum(weights[4 * half + lane] << np.uint64(16 * lane) for lane in range(4)) for half in range(2)]
        runs = -(-sizes[full] // 256)
        head = np.cumsum(runs) - runs
        heads = np.repeat(starts[full], runs) + 256 * (np.arange(runs.sum()) - np.repeat(head, runs))
        for word in range(FP_WORDS * 4):
            if word % 4 == 0:
                hashes = mixed((found ^ np.uint64(SEED)) * _ODD + np.uint64(word // 4 + 1))
            for byte in (2 * (word % 4), 2 * (word % 4) + 1):
                picked = ((hashes >> np.uint64(8 * byte)) & np.uint64(255)).astype(np.uint8)
                for half in range(2):
                    sums = np.add.reduceat(four[half][picked], heads)
                    for lane in range(4):
                        total = np.add.reduceat(((sums >> np.uint64(16 * lane)) & np.uint64(0xFFFF)).astype(np.int64), head)
                        bits[(word // 4) * 64 + 8 * byte + 4 * half + lane, full] = 2 * total > 255 * sizes[full]
    return np.ascontiguousarray(np.packbits(bits, axis=0, bitorder="little").T).view(np.uint64).reshape(texts, FP_WORDS)


def words_of(column: pa.Array) -> np.ndarray:
    """Wide fingerprints in a binary column, as words by rows."""
    whole = column.cast(pa.binary(FP_WORDS * 8))
    data = np.frombuffer(whole.buffers()[1], np.uint64).reshape(-1, FP_WORDS)[whole.offset : whole.offset + len(whole)]
    return np.ascontiguousarray(data.T)


def blocks_for(rows: int) -> tuple[int, int]:
    """Bits of a block and kinds of blocks. More rows get more bits, and as many more kinds as it takes to find as much."""
    bits = max(BLOCK_BITS, ceil(log2(max(1, rows) / BLOCK_ROWS)))
    return bits, ceil(BLOCK_KINDS * KINDS_GROWTH ** (bits - BLOCK_BITS))


def links_in_blocks(block: np.ndarray, close) -> tuple[np.ndarray, np.ndarray]:
    """Links between places that are in the same block and `close`: not all, but all that hangs together. `close` takes two arrays of places, or one place and an array."""
    order = np.argsort(block, kind="stable")
    cuts = np.flatnonzero(np.diff(block[order])) + 1
    sizes = np.diff(np.concatenate([[0], cuts, [len(order)]]))
    small = np.repeat(sizes, sizes) <= LAGS
    a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    at = order[small]
    blocks = block[at]
    for lag in range(1, LAGS):
        i = np.flatnonzero(blocks[lag:] == blocks[:-lag])
        if not len(i):
            break
        i = i[close(at[i], at[i + lag])]
        a.append(at[i])
        b.append(at[i + lag])
    for at in np.split(order, cuts):
        if len(at) <= LAGS:
            continue
        # A large block: each member meets those that it does not hang together with yet.
        root, others = np.arange(len(at)), None
        for i in range(len(at)):
            if others is None or root[i] != of:
                of, others = root[i], np.flatnonzero(root != root[i])
            if not len(others):
                break
            j = others[np.searchsorted(others, i) :]
            j = j[close(at[i], at[j])]
            if len(j):
                joined = np.isin(root, np.append(root[j], root[i]))
                root[joined], others = root[joined].min(), None
        a.append(at)
        b.append(at[root])
    return np.concatenate(a), np.concatenate(b)


def _close_in_blocks(block: np.ndarray, one: np.ndarray, two: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """`links_in_blocks` of what differs in at most `radius` bits of two words."""
    order = np.argsort(block, kind="stable")
    x, y = one[order], two[order]
    a, b = links_in_blocks(block[order], lambda i, j: np.bitwise_count(x[i] ^ x[j]) + np.bitwise_count(y[i] ^ y[j]) <= radius)
    return order[a], order[b]


def close_links(rows: DataFrame, radius: int) -> DataFrame:
    """Links `a`, `b` of rows (`cid`, a number for each, and `fp`, a wide fingerprint) that share a block and differ in at most `radius` of the first 128 bits.

    Members of a block agree in some of the bits, for each kind of block in others. Not all links are given, but as many as it
    takes for all that hang together in a block. A task sends what it has for some blocks of a kind as one row.
    """
    spark, count = rows.sparkSession, rows.count()
    bits, kinds = blocks_for(count)
    random = np.random.default_rng(SEED)
    chosen = [random.permutation(FP_WORDS * 64)[:bits] for _ in range(kinds)]
    group_bits = min(bits, max(0, ceil(log2(max(1, count) / GROUP_ROWS))))

    def sent(cids, fps):
        """For each kind of block and each value of the first `group_bits` bits, one row."""
        words = np.ascontiguousarray(fps.T)
        flags = np.unpackbits(words.view(np.uint8), axis=1, bitorder="little")
        columns = [np.ascontiguousarray(flags.T[spot]) for spot in range(FP_WORDS * 64)]
        keys, packed = [], ([], [], [])
        for kind, spots in enumerate(chosen):
            if kind and kind % _KINDS_AT_ONCE == 0:
                yield as_batch(keys, packed)
                keys, packed = [], ([], [], [])
            block = np.zeros(len(cids), np.uint32)
            for spot in spots:
                block = (block << np.uint32(1)) | columns[spot]
            order = np.argsort(block, kind="stable")
            group = block[order] >> np.uint32(bits - group_bits)
            heads = np.flatnonzero(np.diff(group, prepend=-1))
            for part, value in zip(np.split(order, heads[1:]), group[heads].tolist()):
                keys.append((kind << 32) + value)
                for out, array in zip(packed, (block, cids, words[:, :2])):
                    out.append(array[part].tobytes())
        yield as_batch(keys, packed)

    def as_batch(keys, packed):
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), *(pa.array(x, pa.binary()) for x in packed)], ["kind", "block", "cids", "fps"])

    def send(batches):
        held, rows = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, GROUP_ROWS):
                part = batch.slice(at, GROUP_ROWS)
                if rows + part.num_rows > GROUP_ROWS:
                    yield from sent(*_both(held))
                    held, rows = [], 0
                held.append(part)
                rows += part.num_rows
        if rows:
            yield from sent(*_both(held))

    def _both(held):
        return np.concatenate([x.column(0).to_numpy() for x in held]), np.concatenate([words_of(x.column(1)) for x in held], axis=1)

    def compare(batches):
        for _, group in by_key(batches):
            block, cids, fps = (np.frombuffer(b"".join(group.column(c).to_pylist()), t) for c, t in (("block", np.uint32), ("cids", np.int64), ("fps", np.uint64)))
            if len(cids) < 2:
                continue
            places = np.argsort(cids)
            block, cids, fps = block[places], cids[places], fps.reshape(-1, 2)[places]
            root = local_roots(len(cids), *_close_in_blocks(block, np.ascontiguousarray(fps[:, 0]), np.ascontiguousarray(fps[:, 1]), radius))
            linked = np.flatnonzero(root != np.arange(len(cids)))
            if len(linked):
                yield pa.RecordBatch.from_arrays([pa.array(cids[linked]), pa.array(cids[root[linked]])], ["a", "b"])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = rows.select("cid", "fp").mapInArrow(send, "kind long, block binary, cids binary, fps binary")
    return groups.repartition(parts, "kind").sortWithinPartitions("kind").mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS, length: int = SHINGLE_WORDS) -> DataFrame:
    """`key`, `fingerprint` (16 hex digits) and `component_id`, one row for each row of `docs`.

    Lower-cases A-Z; words end at white space; shingles of `length` words, repeats included. Rows whose
    fingerprints differ in at most `radius` bits are linked; the component is the smallest key that can be
    reached. Null and empty texts have the fingerprint 0 and are linked like any other. Equal rows give
    equal rows. A null key is never the smallest; a component of nulls alone has a null id. Copies are
    one fingerprint before anything is compared. Other columns are ignored. An empty table gives no rows.
    """
    rows = stored(fingerprints(docs, key, text, length), "fingerprints")
    least = rows.groupBy("fp").agg(F.min(key).alias("least"))
    roots = components(near_links(least.select("fp"), radius))
    named = least.join(roots, least["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = stored(named, "fingerprint-roots")
    answer = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return (
        rows.join(named.join(answer, "root").select("fp", "component_id"), "fp")
        .select(key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
    )


def op6_simhash_near_dedup(spark, folder: str) -> DataFrame:
    """Every document with its fingerprint and the component it is in."""
    return near_duplicates(spark.read.parquet(f"{folder}/documents.parquet"))
