import hashlib
import re

import pytest

from tallyforge.llm import decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_force(docs, items, window=10):
    wanted = {}
    for key, text in items:
        w = words(text)
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if size else 0):
            wanted.setdefault(tuple(w[i : i + size]), set()).add(key)
    sizes = {len(w) for w in wanted}
    out = []
    for key, text in docs:
        w, hit, found = words(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                items_here = wanted.get(tuple(w[i : i + size]))
                if items_here:
                    hit.update(range(i, i + size))
                    found |= items_here
        ids = sorted(str(x) for x in found if x is not None)
        out.append((key, len(w), len(hit), ids))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r[0], r.n_words, r.n_hit, r["items"]) for r in df.collect()), key=repr)


def test_whole_table(spark, folder, documents):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    want = brute_force([(k, d.text) for k, d in documents.items()], items)
    want = sorted((k, n, h, len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), h > 0) for k, n, h, ids in want)
    assert sorted(tuple(r) for r in decontamination.op3_prefix_filtered_decontamination(spark, folder).collect()) == want
    assert any(h for _, _, h, *_ in want)


@pytest.mark.parametrize("window", [1, 2, 3, 5, 10])
def test_cases(make, window):
    items = [
        (10, "The Quick brown fox"), (9, "quick brown"), (9, "quick brown"), (100, "lazy"), (1, None), (2, ""), (3, "-- !"), (None, "null item here"),
        (4, "a b c d e f g h i j k l m"), (5, "a a a a"), (6, "é ñ 9x"), (7, "c d e f g h i j k l"),
    ]
    docs = [
        (1, "the quick brown fox"), (1, "the quick brown fox"), (2, "QUICK, brown!"), (3, None), (4, ""), (5, "quick red brown the lazy-dog"),
        (6, "a b c d e f g h i j k l m n"), (7, "x b c d e f g h i j k"), (None, "a a a a a b"), (8, "É é ñ 9x null item here"), (9, "c d e f g h i j k l " * 3),
        (10, "a"), (11, "word " * 30_000 + "a b c d e f g h i j"),
    ]
    df = make([(k, t, -1, "x", 3) for k, t in docs], "doc_id long, text string, n_words int, row string, size int")
    things = make([(k, t, "h", 0) for k, t in items], "item_id long, text string, h string, n int")
    assert got(decontamination.contaminated(df, things, window=window)) == brute_force(docs, items, window)
    assert got(decontamination.contaminated(df, things.limit(0), window=window)) == brute_force(docs, [], window)
    assert decontamination.contaminated(df.limit(0), things, window=window).collect() == []


def test_containment_below_one_finds_changed_windows(make):
    item = [(1, "a b c d e f g h i j")]
    docs = [(1, "a b c d e f g h i X"), (2, "a b c d e X g h i j"), (3, "x a b c d e f g h i j x"), (4, "a b c X")]
    found = decontamination.contaminated(make(docs, "doc_id long, text string"), make(item, "item_id long, text string"), containment=0.8)
    assert {r.doc_id: r.n_hit for r in found.collect()} == {1: 10, 2: 0, 3: 10, 4: 0}
