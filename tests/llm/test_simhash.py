import re
from itertools import combinations

import numpy as np
import xxhash

from tallyforge.llm import simhash


def fingerprint(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute_force(rows):
    prints = [(key, fingerprint(text)) for key, text in rows]
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(prints)), 2):
        if bin(prints[i][1] ^ prints[j][1]).count("1") <= 2:
            root[find(i)] = find(j)
    groups = {}
    for i in range(len(prints)):
        groups.setdefault(find(i), []).append(i)
    out = []
    for members in groups.values():
        keys = [prints[i][0] for i in members if prints[i][0] is not None]
        out += [(prints[i][0], f"{prints[i][1]:016x}", min(keys) if keys else None) for i in members]
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_whole_table(spark, folder, documents):
    want = brute_force([(k, row.text) for k, row in documents.items()])
    assert got(simhash.op6_simhash_near_dedup(spark, folder)) == want
    assert any(component != key for key, _, component in want)


def test_nulls_empty_long_repeated_and_clashing_columns(make):
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    rows = [
        (1, None), (2, ""), (3, " \n"), (4, "one"), (4, "one"), (None, "one two"), (None, None), (5, long), (6, long + " end"),
        (7, "É é x a b"), (8, "A B c"), (9, "a b C"),
    ]
    df = make([(k, t, -1, "x", 0) for k, t in rows], "doc_id long, text string, fp long, root string, component_id int")
    assert got(simhash.near_duplicates(df)) == brute_force(rows)
    assert got(simhash.near_duplicates(df.limit(0))) == []


def test_small_tiles_and_dense_clusters(make):
    rng = np.random.default_rng(5)
    centres = rng.integers(-(2**63), 2**63 - 1, 12, dtype=np.int64)
    values = {int(c) for c in centres}
    for c in centres[:4]:  # all within two bits of the centre
        values |= {int(c ^ np.int64(1 << int(i)) ^ np.int64(1 << int(j))) for i, j in rng.integers(0, 62, (40, 2))}
    values = sorted(values)
    for tile_rows in (1, 7, 1000):
        links = simhash.near_links(make([(v,) for v in values], "fp long"), tile_rows=tile_rows).collect()
        root = {v: v for v in values}

        def find(v):
            while root[v] != v:
                v = root[v]
            return v

        for r in links:
            root[find(r.a)] = find(r.b)
        for x, y in combinations(values, 2):
            if bin((x ^ y) & (2**64 - 1)).count("1") <= 2:
                assert find(x) == find(y)
        assert len({find(v) for v in values}) == 12
