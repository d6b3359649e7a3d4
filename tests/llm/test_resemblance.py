import random
import re

import numpy as np

import corpus_pipeline as cp
from tallyforge.llm import resemblance, simhash
from tallyforge.llm.grouped import local_roots


def shingles(text):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = [w for w in re.split("[ \t\n\v\f\r]+", lower) if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_force(rows):
    """The component of each key, by comparing all pairs."""
    sets, root = [(k, shingles(t)) for k, t in rows], {k: k for k, _ in rows}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if 5 * len(s & t) >= 4 * len(s | t):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: find(k) for k in root}


def edited(rng, words, edits):
    words = list(words)
    for at in rng.sample(range(len(words)), edits):
        words[at] = f"edit{rng.random()}"
    return " ".join(words)


def stage(spark, make, folder, rows):
    docs = make(rows, "doc_id long, text string")
    return {r.doc_id for r in cp.drop_near_duplicates(spark, docs, folder).collect()}


def test_edited_copies_go_and_less_similar_texts_stay(spark, make, folder):
    rng = random.Random(5)
    rows = []
    for i in range(60):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(150, 600))]
        rows += [(10 * i + j, edited(rng, words, j)) for j in (0, 1, 2, 3, 5)]
        rows += [(10 * i + 9, edited(rng, words, len(words) // 12))]
    rows += [(9000, "one two three"), (9001, "One  two\tthree"), (9002, "one two four"), (9003, "")]
    want = brute_force(rows)
    kept = stage(spark, make, folder, rows)
    assert kept == {k for k, root in want.items() if k == root}
    assert not any(k % 10 in (1, 2, 3) for k in kept if k < 9000) and sum(k % 10 == 9 for k in kept) > 30


def test_large_group_and_chains(make):
    """More in a bucket than the first rounds' leaders reach, and links that only a chain has."""
    rng = random.Random(6)
    words = [f"w{i}" for i in range(300)]
    rows = [(i, edited(rng, words, 3)) for i in range(150)]
    chain = [f"c{i}" for i in range(200)]
    for i in range(40):
        chain = [f"n{i}.{j}" for j in range(12)] + chain[:-12]
        rows.append((1000 + i, " ".join(chain)))
    loose = [f"l{i}" for i in range(300)]
    rows += [(2000 + i, edited(rng, loose, 9)) for i in range(60)]
    found = {r.doc_id: r.component_id for r in resemblance.resembling(make(rows, "doc_id long, text string")).collect()}
    want = brute_force(rows)
    assert found == want and want[149] == 0 and want[1039] == 1000


def test_whole_table(spark, folder, documents):
    known = {k: r.text for k, r in documents.items() if r.text and any(c.isalpha() for c in r.text)}
    docs = spark.createDataFrame(list(known.items()), "doc_id long, text string")
    assert {r.doc_id for r in cp.drop_near_duplicates(spark, docs, folder).collect()} == {k for k, root in brute_force(list(known.items())).items() if k == root}


def just_below(rng, name, count):
    """Texts of which each shares about 0.75 of its shingles with each other."""
    words = [f"{name}{i}" for i in range(400)]
    return [edited(rng, words, 6) for _ in range(count)]


def test_large_groups_just_below(spark, make, tmp_path):
    """What is sent to be compared follows the members of a group, not its pairs."""
    rng = random.Random(7)
    sent = {}
    for count in (100, 400):
        rows = [(i, t) for i, t in enumerate(just_below(rng, "w", count))]
        docs = make(rows, "doc_id long, text string")
        classes = cp.stored(
            resemblance._described(docs, "doc_id", "text").withColumn("cid", resemblance.F.monotonically_increasing_id()), "classes"
        )
        sent[count] = resemblance._members(classes, resemblance.BIN_SHINGLES).count()
        found = {r.doc_id: r.component_id for r in resemblance.resembling(docs).collect()}
        assert found == brute_force(rows) and len(set(found.values())) > count / 4
    assert sent[400] <= 4.5 * sent[100]


def test_small_bins_give_the_same(make):
    """A bin that holds few shingles deals components out by their bands, and buckets by pairs of parts."""
    rng = random.Random(8)
    words = [f"v{i}" for i in range(300)]
    rows = [(i, t) for i, t in enumerate([edited(rng, words, 4) for _ in range(60)] + just_below(rng, "u", 40))]
    docs = make(rows, "doc_id long, text string")
    want = brute_force(rows)
    for bound in (1_000, 20_000):
        assert {r.doc_id: r.component_id for r in resemblance.resembling(docs, bin_shingles=bound).collect()} == want


def test_recall_at_the_threshold(make):
    """Pairs between 0.8 and 0.85: at least 0.9 must be found; 0.99 is expected."""
    rng = random.Random(9)
    rows = []
    for i in range(300):
        words = [f"p{i}.{j}" for j in range(300)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, edited(rng, words, 6))]
    want = brute_force(rows)
    pairs = [k for k, root in want.items() if k != root]
    found = {r.doc_id: r.component_id for r in resemblance.resembling(make(rows, "doc_id long, text string")).collect()}
    assert len(pairs) > 100 and all(want[k] == root for k, root in found.items() if k != root)
    assert sum(found[k] != k for k in pairs) >= 0.9 * len(pairs)


def test_fingerprints_choose_what_is_compared(make):
    """Classes meet in a bin if their fingerprints are close, and otherwise not; nothing else of a text is looked at."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(200):
        fp = rng.integers(0, 2, 256, np.uint8)
        near, far = fp.copy(), fp.copy()
        near[rng.permutation(256)[:20]] ^= 1
        far[:128][rng.permutation(128)[:50]] ^= 1
        rows += [(3 * i + j, 10, bytearray(np.packbits(x).tobytes())) for j, x in enumerate((fp, near, far))]
    members = resemblance._members(make(rows, "cid long, n long, fp binary"), resemblance.BIN_SHINGLES).collect()
    bins = {}
    for r in members:
        bins.setdefault(r.bin, []).append(r.cid)
    assert sorted(sorted(b) for b in bins.values()) == [[3 * i, 3 * i + 1] for i in range(200)]


def test_bits_differ_as_the_angle_between_sets():
    """At a similarity of 0.8, 15 % of the bits; half of them where nothing is shared."""
    rng = np.random.default_rng(4)
    for size, shared in ((900, 800), (9, 8)):
        one = rng.integers(0, 1 << 63, (300, size), np.uint64)
        two = one.copy()
        two[:, shared:] = rng.integers(0, 1 << 63, (300, size - shared), np.uint64)
        fps = [simhash.wide_fingerprints(x.reshape(-1), np.arange(0, x.size + 1, size)) for x in (one, two)]
        apart = np.bitwise_count(fps[0] ^ fps[1]).sum(axis=1)
        assert 36 < apart.mean() < 42 and apart.max() <= resemblance.RADIUS
        assert 124 < np.bitwise_count(fps[0][1:] ^ fps[1][:-1]).sum(axis=1).mean() < 132
    # Texts side by side and without words change nothing.
    starts = np.array([0, 0, 9, 9, 18])
    fps = simhash.wide_fingerprints(one[:2].reshape(-1), starts)
    alone = [simhash.wide_fingerprints(one[i], np.array([0, 9]))[0] for i in range(2)]
    assert (fps[[0, 2]] == 0).all() and (fps[[1, 3]] == alone).all()


def test_blocks_of_any_size_give_the_same():
    """All that hangs together in a block, whether its members meet one by one or lag by lag."""
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 1 << 63, (60, 2), np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (3000, 2, 9), np.uint64)
    words = centres[rng.integers(0, 60, 3000)] ^ np.bitwise_xor.reduce(flips, axis=2)
    block = np.minimum(rng.integers(0, 40, 3000), 20).astype(np.uint32)  # one block has half of them
    one, two = (np.ascontiguousarray(x) for x in words.T)
    near = np.bitwise_count(one[:, None] ^ one) + np.bitwise_count(two[:, None] ^ two) <= 20
    want = local_roots(3000, *np.nonzero(near & (block[:, None] == block)))
    got = simhash._close_in_blocks(block, one, two, 20)
    assert (block == 20).sum() > simhash.LAGS
    assert (local_roots(3000, *got) == want).all()


def test_no_pair_at_the_threshold_is_lost(make):
    """Of two texts that share exactly 40 of 50 shingles, blocks of bits miss one pair in about a hundred."""
    rows = []
    for i in range(1500):
        words = [f"t{i}.{j}" for j in range(49)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join([*words[:24], "other", *words[25:]]))]
    assert 5 * len(shingles(rows[0][1]) & shingles(rows[1][1])) == 4 * len(shingles(rows[0][1]) | shingles(rows[1][1]))
    found = {r.doc_id: r.component_id for r in resemblance.resembling(make(rows, "doc_id long, text string")).collect()}
    assert found == {k: k - k % 2 for k, _ in rows}
