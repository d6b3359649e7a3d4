import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tallyforge.llm import ranking

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_force(docs, items, top=50):
    """(item, rank, key, score); a null key comes last of equal scores."""
    counted = [(key, Counter(terms(text))) for key, text in docs]
    counted = [(key, c, sum(c.values())) for key, c in counted if c]
    n_docs, total = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, mine in wanted.items():
        scored = []
        for key, c, n in counted:
            m = 100 - 50 + 50 * n * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in mine if c[t])
            if score > 0:
                scored.append((-score, key is None, key if key is not None else 0, key))
        scored.sort(key=lambda s: s[:3])
        out += [(item, i + 1, s[3], -s[0]) for i, s in enumerate(scored[:top])]
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def made(make, docs, items):
    return make(docs, "doc_id long, text string"), make(items, "item_id long, text string")


def test_whole_table_against_brute_force_and_sql(spark, folder, documents):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    found = got(ranking.op12_dense_ranked_search(spark, folder))
    assert found == brute_force([(k, r.text) for k, r in documents.items()], items)
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    assert sorted(con.execute(ranking.OP12_SQL).fetchall(), key=repr) == found


def test_odd_rows(make):
    docs = [
        (1, None), (2, ""), (3, "-- ??"), (4, "Cat cat CAT dog"), (5, "cat dog"), (6, "cat dog"), (None, "cat dog"), (None, "cat dog"), (6, "cat dog"),
        (7, "über Über été 東京 x1"), (8, "word " * 50_000 + "rare"), (9, "a_b a-b"),
    ]
    items = [(1, "the cat and the dog"), (2, None), (3, ""), (4, "ÜBER über 東京 X1"), (None, "rare a b"), (5, "word"), (5, "dog"), (6, "unknown words"), (7, "cat")]
    want = brute_force(docs, items)
    assert got(ranking.rank(*made(make, docs, items))) == want
    assert {i for i, *_ in want} == {1, 4, None, 5, 7} and sum(1 for i, _, k, _ in want if i == 1 and k is None) == 2


def test_ties_are_cut_by_key(make):
    """More equal scores than ranks, over several partitions and tiles."""
    rng = random.Random(3)
    docs = [(k, "same text here") for k in rng.sample(range(10_000), 3_000)] + [(20_000 + i, f"same other {i}") for i in range(500)]
    items = [(1, "same text"), (2, "other 7 here")]
    assert got(ranking.rank(*made(make, docs, items))) == brute_force(docs, items)
    assert got(ranking.rank(*made(make, docs, items), top=7)) == brute_force(docs, items, 7)


def test_blocks_of_items_change_nothing(make, monkeypatch):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 40)))) for i in range(300)]
    items = [(i, " ".join(rng.sample(words, rng.randrange(1, 12)))) for i in range(150)]
    want = brute_force(docs, items)
    assert got(ranking.rank(*made(make, docs, items))) == want  # more items than a tile
    assert got(ranking.rank(*made(make, docs, items), block_terms=100)) == want


def test_sums_stay_exact_when_columns_are_cut(monkeypatch):
    rng = np.random.default_rng(5)
    items, terms_, docs = 5, 40, 30
    item_at, term_at = (a.ravel() for a in np.meshgrid(np.arange(items), np.arange(terms_), indexing="ij"))
    weight = rng.integers(1, 10**9, terms_)
    impacts = rng.integers(1, ranking._IMPACT, (docs, terms_))
    tiles = ranking.ItemTiles(item_at, term_at, weight, tile=3)
    assert all(len(spans) > 1 for *_, spans in tiles.tiles)
    doc, term = (a.ravel() for a in np.meshgrid(np.arange(docs), np.arange(terms_), indexing="ij"))
    want = (impacts.astype(object) @ weight.astype(object)).tolist()
    for _, scores in tiles.scores(doc, term, impacts.ravel(), docs):
        for i in range(docs):
            assert set(scores[i].tolist()) - {0} == {want[i]}


def test_best_keeps_ties_in_order():
    best = ranking.Best(1, 3)
    for first in range(0, 6000, 600):
        keys = [first + (i * 7) % 600 for i in range(600)]
        best.add(np.zeros(600, np.int64), np.full(600, 9), pa.array([k if k != 3 else None for k in keys]))
    assert best.cut().column("key").to_pylist() == [0, 1, 2] and best.least[0] == 9


@pytest.mark.parametrize("docs, items", [([], [(1, "a")]), ([(1, "a")], []), ([], []), ([(1, None)], [(1, "a")]), ([(1, "a")], [(1, None)])])
def test_empty(make, docs, items):
    out = ranking.rank(*made(make, docs, items))
    assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.collect() == []


def test_columns_with_clashing_names(make):
    docs = make([(1, "cat", 5, "x"), (2, "dog cat", 6, "y")], "doc_id long, text string, score long, term string").withColumns(
        {n: ranking.F.lit("z") for n in ("item", "rank", "key", "item_id", "n", "tf", "salt", "block")}
    )
    items = make([(1, "cat", 3)], "item_id long, text string, block int").withColumns({n: ranking.F.lit("z") for n in ("item", "term", "doc_id", "place")})
    out = ranking.rank(docs, items)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    assert got(out) == brute_force([(1, "cat"), (2, "dog cat")], [(1, "cat")])
