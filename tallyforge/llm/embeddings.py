"""Near-duplicate vectors by sorted projection passes.

In each pass, vectors are put in the order of 64 concatenated random hashes (the sides of random hyperplanes through
the mean of the unit vectors) and every vector is compared, exactly, with its neighbours in a window of bounded
size. How many passes it takes is measured: by how many leading hashes a vector shares with the one a window away. The links of all passes are
united. A pair is counted in the first pass that has it in a window, which the ranks tell, so pairs are never
gathered. Equal vectors are one class before anything is compared.

Groups larger than a window have an exact way of their own: vectors within half the angle of the threshold
around their group's mean are all linked to each other, by the triangle inequality for angles. They are
counted as one core, whatever its size; all other pairs of such a group are compared block by block, exactly.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyforge.llm.graph import components
from tallyforge.llm.grouped import by_key, local_roots
from tallyforge.llm.words import bounded_batches
from tallyforge.operators.numbering import number_rows
from tallyforge.session import stored

THRESHOLD, WINDOW, SEED = 0.95, 256, 8
#: The share of links, of pairs just at the threshold, that all passes together may miss in expectation.
MISSED = 0.02
LEAST_PASSES = 8
#: With so many passes a pair may be missed more often, where nearly all vectors are near-duplicates of each other; such
#: vectors hang together all the same, and then their links are counted exactly.
MOST_PASSES = 96
#: Lengths of vectors of which the mean is taken, those of most vectors first; vectors of others aren't centred.
_CENTRED = 1_000
BLOCK_ROWS = 4096
_BITS = 64


def passes_for(chance: float) -> int:
    """How many passes find nearly all pairs, if a pass finds one at the threshold with this chance."""
    if chance >= 1 - MISSED:
        return LEAST_PASSES
    return min(MOST_PASSES, max(LEAST_PASSES, math.ceil(math.log(MISSED) / math.log1p(-chance)))) if chance > 0 else MOST_PASSES


def same_side(threshold: float, common: float) -> float:
    """The chance that a hyperplane through the mean leaves a pair at the threshold together; `common` is the mean's squared length.

    Without what all vectors have in common, the cosine of the rest is smaller.
    """
    rest = (threshold - common) / (1 - common) if common < threshold else 0.0
    return 1 - math.acos(max(0.0, min(1.0, rest))) / math.pi


def _matrix(column: pa.Array) -> np.ndarray:
    """Unit vectors, in double precision; all rows have the same length."""
    values = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), -1)
    values = values / np.abs(values).max(axis=1, keepdims=True)  # so that squares stay finite
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def _planes(which: int, dimensions: int) -> np.ndarray:
    return np.random.default_rng([SEED, which, dimensions]).standard_normal((dimensions, _BITS))


def means_of(classes: DataFrame) -> dict[int, np.ndarray]:
    """The mean of the unit vectors of each length. A vector for each length reaches the driver, of the `_CENTRED` most frequent lengths."""

    def run(batches):
        for batch in batches:
            dims = batch.column(0).to_numpy()
            for dim in np.unique(dims):
                unit = _matrix(batch.column(1).take(pa.array(np.flatnonzero(dims == dim))))
                yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([unit.sum(axis=0)], pa.list_(pa.float64())), pa.array([len(unit)])], ["dim", "total", "n"])

    sums = stored(classes.select("dim", "vec").mapInArrow(run, "dim int, total array<double>, n long"), "vector-sums")
    most = sums.groupBy("dim").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "dim").limit(_CENTRED)
    each = sums.join(F.broadcast(most.select("dim")), "dim").select("dim", F.posexplode("total").alias("place", "x"))
    added = each.groupBy("dim", "place").agg(F.sum("x").alias("x")).groupBy("dim").agg(F.array_sort(F.collect_list(F.struct("place", "x"))).alias("m"))
    counts = {r.dim: r.n for r in most.collect()}
    return {r.dim: np.array([m.x for m in r.m]) / counts[r.dim] for r in added.collect()}


def _chance(classes: DataFrame, means: dict[int, np.ndarray], threshold: float, window: int) -> float:
    """The chance that one pass has a pair at the threshold in a window, over all vectors, from the order of the first pass.

    A vector and its pair stay together if they share the hashes in which a window around it agrees, and one more.
    """
    first = _sort_keys(classes, 1, means).select("cid", "dim", F.col("keys")[0].alias("k"))
    ranked = stored(number_rows(first, F.col("dim"), F.col("k"), F.col("cid"), name="rank"), "first-pass")
    ahead = ranked.select((F.col("rank") - window).alias("rank"), F.col("dim").alias("other_dim"), F.col("k").alias("other"))
    differ = F.length(F.bin(F.col("k").bitwiseXOR(F.col("other"))))
    depth = F.when(F.col("k") == F.col("other"), _BITS).otherwise(_BITS - differ)
    # Near the end of a length's vectors everything is within the window.
    deep = F.when(F.col("dim") == F.col("other_dim"), F.least(F.lit(_BITS), depth + 1)).otherwise(0)
    known = F.when(F.col("dim").isin(*means), F.col("dim")).otherwise(-1) if means else F.lit(-1)
    counts = ranked.join(ahead, "rank", "left").groupBy(known.alias("dim"), F.coalesce(deep, F.lit(0)).alias("deep")).count()
    total = found = 0.0
    # At most 65 rows for each length of vectors that has a mean.
    by_dim: dict[int, float] = {}
    for dim, deep_, n in counts.collect():
        if dim not in by_dim:
            by_dim[dim] = same_side(threshold, float(means[dim] @ means[dim]) if dim in means else 0.0)
        total += n
        found += n * by_dim[dim] ** deep_
    return found / total if total else 1.0


def _sort_keys(classes: DataFrame, passes: int, means: dict[int, np.ndarray]) -> DataFrame:
    """`cid`, `dim` and `keys`, for each pass the hashes put together as one number."""
    centres = classes.sparkSession.sparkContext.broadcast(means)

    def run(batches):
        for batch in batches:
            keys = np.zeros((batch.num_rows, passes), np.int64)
            dims = batch.column(1).to_numpy()
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                unit = _matrix(batch.column(2).take(pa.array(rows))) - centres.value.get(int(dim), 0.0)
                for p in range(passes):
                    bits = np.packbits(unit @ _planes(p, int(dim)) > 0, axis=1)
                    keys[rows, p] = bits.view(">u8").reshape(-1).astype(np.uint64).view(np.int64)
            lists = pa.ListArray.from_arrays(np.arange(0, keys.size + 1, passes, dtype=np.int32), pa.array(keys.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], ["cid", "dim", "keys"])

    return classes.select("cid", "dim", "vec").mapInArrow(run, "cid long, dim int, keys array<long>")


def _placed(classes: DataFrame, passes: int, means: dict[int, np.ndarray]) -> DataFrame:
    """The classes with `ranks`, their places in the order of each pass."""
    keys = stored(_sort_keys(classes, passes, means), "projection-keys")
    ranks = None
    for p in range(passes):
        one = number_rows(keys.select("cid", "dim", F.col("keys")[p].alias("k")), F.col("dim"), F.col("k"), F.col("cid"), name="rank")
        one = one.select("cid", F.lit(p).alias("p"), "rank")
        ranks = one if ranks is None else ranks.unionByName(one)
    wide = ranks.groupBy("cid").agg(*(F.max(F.when(F.col("p") == p, F.col("rank"))).alias(f"r{p}") for p in range(passes)))
    return stored(classes.join(wide.select("cid", F.array(*(f"r{p}" for p in range(passes))).alias("ranks")), "cid"), "placed")


def _compared(placed: DataFrame, passes: int, threshold: float, window: int) -> DataFrame:
    """`cid`, `links` and `root`, for each class and tile of each pass: copies that are linked and counted there, and the smallest class reached.

    A tile is four windows of ranks, with the last window of the tile before.
    """
    tile_rows = 4 * window
    span = max(1, 1 << 40)  # tiles of a pass

    def tiles(batches):
        for batch in batches:
            ranks = batch.column(batch.schema.get_field_index("ranks")).flatten().to_numpy().reshape(-1, passes)
            for p in range(passes):
                tile, rest = np.divmod(ranks[:, p], tile_rows)
                halo = np.flatnonzero(rest >= tile_rows - window)
                for rows, key, home in ((np.arange(len(tile)), p * span + tile, True), (halo, p * span + tile[halo] + 1, False)):
                    part = batch.take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.full(len(rows), home)), *part.columns], ["tile", "home", *batch.schema.names])

    def compare(batches):
        for key, group in by_key(batches):
            p = int(key) // span
            everyone = group.combine_chunks().to_batches()[0]
            dims = everyone.column("dim").to_numpy()
            for dim in np.unique(dims):
                rows = everyone.take(pa.array(np.flatnonzero(dims == dim)))
                order = np.argsort(rows.column("ranks").flatten().to_numpy().reshape(-1, passes)[:, p], kind="stable")
                rows = rows.take(pa.array(order))
                unit = _matrix(rows.column("vec"))
                ranks = rows.column("ranks").flatten().to_numpy().reshape(-1, passes)
                cid, weight = rows.column("cid").to_numpy(), rows.column("copies").to_numpy()
                home = rows.column("home").to_numpy(zero_copy_only=False)
                links, found_a, found_b = np.zeros(len(cid), np.int64), [], []
                for first in range(0, len(cid), 256):
                    last = min(len(cid), first + 256)
                    low = int(np.searchsorted(ranks[:, p], ranks[first, p] - window))
                    i, j = np.nonzero(unit[low:last] @ unit[first:last].T >= threshold)
                    i, j = i + low, j + first
                    near = (i < j) & home[j] & (ranks[j, p] - ranks[i, p] <= window)
                    i, j = i[near], j[near]
                    new = (np.abs(ranks[i, :p] - ranks[j, :p]) > window).all(axis=1)
                    i, j = i[new], j[new]
                    np.add.at(links, i, weight[j])
                    np.add.at(links, j, weight[i])
                    found_a.append(i)
                    found_b.append(j)
                by_cid = np.argsort(cid, kind="stable")
                place = np.empty(len(cid), np.int64)
                place[by_cid] = np.arange(len(cid))
                root = local_roots(len(cid), place[np.concatenate(found_a)], place[np.concatenate(found_b)])
                linked = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cid[linked]), pa.array(links[linked]), pa.array(cid[by_cid][root[place[linked]]])], ["cid", "links", "root"]
                )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema)
    parts = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = placed.mapInArrow(tiles, f"tile long, home boolean, {kinds}").repartition(parts, "tile").sortWithinPartitions("tile")
    return laid.mapInArrow(compare, "cid long, links long, root long")


def _cores(placed: DataFrame, groups: DataFrame, threshold: float, window: int) -> DataFrame:
    """`cid` and `core` for the members of groups (`cid`, `group`) larger than a window that lie within half the angle around the group's mean."""
    large = groups.join(groups.groupBy("group").count().where(F.col("count") > window).select("group"), "group")
    members = stored(placed.join(large, "cid").select("cid", "group", "vec"), "large-groups")

    def unit_vectors(batches):
        for batch in batches:
            dims = np.diff(batch.column(2).offsets.to_numpy())
            for dim in np.unique(dims):  # one length for all members of a group
                part = batch.take(pa.array(np.flatnonzero(dims == dim)))
                unit = _matrix(part.column(2))
                lists = pa.ListArray.from_arrays(np.arange(0, unit.size + 1, dim, dtype=np.int32), pa.array(unit.reshape(-1)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), lists], ["cid", "group", "unit"])

    units = stored(members.mapInArrow(unit_vectors, "cid long, group long, unit array<double>"), "unit-vectors")
    means = (
        units.select("group", F.posexplode("unit").alias("place", "x")).groupBy("group", "place").agg(F.avg("x").alias("x"))
        .groupBy("group").agg(F.array_sort(F.collect_list(F.struct("place", "x"))).alias("m"))
        .select("group", F.col("m.x").alias("mean"))
    )
    dot = F.aggregate(F.zip_with("unit", "mean", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    length = F.sqrt(F.aggregate("mean", F.lit(0.0), lambda a, b: a + b * b))
    # A little more than half the angle, so that rounding can't let in a pair below the threshold.
    bound = math.cos(math.acos(threshold) / 2) + 1e-9
    return units.join(means, "group").where(dot >= length * F.lit(bound)).select("cid", F.col("group").alias("core"))


def _counted_in_blocks(members: DataFrame, threshold: float) -> DataFrame:
    """`cid` and `links`, in parts: linked copies of the same group, but for pairs of a core. Each block outside the cores meets every block of its group."""

    def blocks(rows: DataFrame, side: str) -> tuple[DataFrame, DataFrame]:
        counts = rows.groupBy("group").agg(F.ceil(F.count("*") / F.lit(BLOCK_ROWS)).cast("int").alias(side))
        return rows.join(counts, "group").withColumn("block", F.pmod(F.xxhash64("cid"), F.col(side)).cast("int")), counts

    left, lefts = blocks(members.where("core is null"), "lefts")
    right, rights = blocks(members, "rights")
    columns = ("cid", "dim", "vec", "copies", F.col("core").isNotNull().alias("in_core"))
    left = left.join(rights, "group").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("rights") - 1)))
    left = left.select(F.xxhash64("group", "block", "other").alias("tile"), F.lit(True).alias("first"), *columns)
    right = right.join(lefts, "group").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("lefts") - 1)))
    right = right.select(F.xxhash64("group", "other", "block").alias("tile"), F.lit(False).alias("first"), *columns)

    def compare(batches):
        for _, tile in by_key(batches):
            rows = tile.combine_chunks().to_batches()[0]
            first = rows.column("first").to_numpy(zero_copy_only=False)
            a, b = (rows.take(pa.array(np.flatnonzero(x))) for x in (first, ~first))
            if not a.num_rows or not b.num_rows:
                continue
            one, two = _matrix(a.column("vec")), _matrix(b.column("vec"))
            weight_a, weight_b = a.column("copies").to_numpy(), b.column("copies").to_numpy()
            cid_a, cid_b = a.column("cid").to_numpy(), b.column("cid").to_numpy()
            links_a, links_b = np.zeros(len(cid_a), np.int64), np.zeros(len(cid_b), np.int64)
            for at in range(0, len(cid_a), 512):
                part = slice(at, at + 512)
                i, j = np.nonzero(one[part] @ two.T >= threshold)
                i += at
                new = cid_a[i] != cid_b[j]
                i, j = i[new], j[new]
                np.add.at(links_a, i, weight_b[j])
                np.add.at(links_b, j, weight_a[i])
            core = b.column("in_core").to_numpy(zero_copy_only=False)  # the others are a first side too
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([cid_a, cid_b[core]])), pa.array(np.concatenate([links_a, links_b[core]]))], ["cid", "links"])

    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return left.unionByName(right).repartition(parts, "tile").sortWithinPartitions("tile").mapInArrow(compare, "cid long, links long")


def near_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD, window: int = WINDOW) -> DataFrame:
    """For each row of `df`: `key`, `n_links` (other rows linked directly), `component_id` (the smallest key reached) and `kept`.

    Rows are linked if the passes find them and their cosine, in double precision, is at least `threshold`. Vectors that are
    null, empty, zero or hold a null or non-finite component link with nothing, nor do vectors of different lengths.
    Equal rows are linked to each other. A null key is never the smallest; a component of nulls alone has a null id and
    is kept. Other columns are ignored. Every row is indexed. An empty table gives no rows.
    """
    double = F.col("vec").cast("array<double>")
    fine = F.forall(double, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(double, lambda x: x != 0)
    rows = df.select(F.col(key).alias("key"), F.col(vector).alias("vec")).withColumn("fine", F.coalesce(fine, F.lit(False)))
    useful = bounded_batches(rows).where("fine")
    classes = stored(
        useful.groupBy("vec").agg(F.count("*").alias("copies"), F.min("key").alias("least"))
        .withColumns({"cid": F.monotonically_increasing_id(), "dim": F.size("vec"), "core": F.lit(None).cast("long")}),
        "vector-classes",
    )
    means = means_of(classes)
    passes = passes_for(_chance(classes, means, threshold, window))
    placed = _placed(classes.select("cid", "dim", "vec", "copies", "core"), passes, means)
    found = stored(_compared(placed, passes, threshold, window), "vector-links")
    groups = components(found.select("cid", "root"))
    groups = stored(groups.select(F.col("node").alias("cid"), F.col("root").alias("group")), "vector-groups")

    # Members of large groups are counted anew: their cores by number, all other pairs by blocks.
    large = groups.groupBy("group").count().where(F.col("count") > window).select("group")
    crowded = stored(groups.join(large, "group"), "large-group-members")
    cores = stored(_cores(placed, groups, threshold, window), "vector-cores")
    again = stored(placed.drop("core").join(crowded, "cid").join(cores, "cid", "left").select("cid", "group", "dim", "vec", "copies", "core"), "crowded")
    recount = _counted_in_blocks(again, threshold).groupBy("cid").agg(F.sum("links").alias("links"))
    core_copies = again.where("core is not null").groupBy("core").agg(F.sum("copies").alias("core_copies"))
    crowded_links = (
        again.join(recount, "cid", "left").join(core_copies, "core", "left")
        .select("cid", (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("core_copies") - F.col("copies"), F.lit(0))).alias("links"))
    )
    plain_links = found.groupBy("cid").agg(F.sum("links").alias("links")).join(crowded.select("cid"), "cid", "left_anti")
    links = plain_links.unionByName(crowded_links)

    named = classes.join(groups, "cid", "left").withColumn("group", F.coalesce("group", "cid"))
    named = stored(named.join(links, "cid", "left").select("vec", "copies", "least", "group", F.coalesce("links", F.lit(0)).alias("links")), "vector-answers")
    smallest = named.groupBy("group").agg(F.min("least").alias("component_id"))
    answers = named.join(smallest, "group").select("vec", (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id")
    alone = rows.where("not fine").select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"))
    out = useful.join(answers, "vec").select("key", "n_links", "component_id").unionByName(alone)
    return out.select(F.col("key").alias(key), "n_links", "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept"))


def op8_sorted_projection_near_dedup(spark, folder: str) -> DataFrame:
    """Every embedding with its near-duplicates counted, and the one that stands for them."""
    return near_vectors(spark.read.parquet(f"{folder}/embeddings.parquet"))
