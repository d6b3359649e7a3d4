import math
import os
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyforge.llm import quality
from tallyforge.session import scratch

ORDER = 3


def grams_of(text, order):
    line = [chr(1)] * (order - 1) + list(text or "") + [chr(2)]
    return [tuple(line[i : i + order]) for i in range(len(line) - order + 1)]


class KneserNey:
    """Interpolated modified Kneser-Ney, straight from its definition."""

    def __init__(self, trusted, everything, order):
        self.order = order
        self.levels = {order: Counter(g for t in trusted for g in grams_of(t, order))}
        for k in range(order - 1, 0, -1):
            self.levels[k] = Counter(g[1:] for g in self.levels[k + 1])
        self.characters = len({g[-1] for t in everything for g in grams_of(t, order)})
        self.discounts, self.contexts = {}, {}
        for k, counts in self.levels.items():
            n = [sum(c == i for c in counts.values()) for i in range(1, 5)]
            ratio = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
            d = [i + 1 - (i + 2) * ratio * n[i + 1] / n[i] if n[i] else 0.5 for i in range(3)]
            self.discounts[k] = [min(max(x, 0.05), i + 0.95) for i, x in enumerate(d)]
            self.contexts[k] = defaultdict(list)
            for g, c in counts.items():
                self.contexts[k][g[:-1]].append(c)

    def spared(self, k, c):
        return self.discounts[k][min(c, 3) - 1] if c else 0.0

    def p(self, gram):
        k = len(gram)
        if not k:
            return 1 / (self.characters + 1)
        lower, counts = self.p(gram[1:]), self.contexts[k].get(gram[:-1])
        if not counts:
            return lower
        c = self.levels[k][gram]
        return (max(0, c - self.spared(k, c)) + sum(self.spared(k, x) for x in counts) * lower) / sum(counts)

    def perplexity(self, text):
        grams = grams_of(text, self.order)
        return math.exp(-sum(math.log(self.p(g)) for g in grams) / len(grams))


def written(spark, make, path, rows, schema):
    make(rows, schema).write.parquet(path)
    return spark.read.parquet(path)


ROWS = [
    (1, "the cat sat on the mat", "en", True), (2, "the hat that sat", "en", True), (3, "zzzz the", "en", False), (4, None, "en", False), (5, "", None, True),
    (6, "é ñ日本", "es", False), (6, "é ñ日本", "es", False), (None, "the cat", None, None), (7, "a" * 3000 + "the cat " * 500, "en", False), (8, "\U0001F600", "xx", False),
]


@pytest.mark.parametrize("order", [1, 2, ORDER, 5])
def test_agrees_with_the_definition(spark, make, tmp_path, order):
    df = written(spark, make, str(tmp_path / "d"), [(*r, 1, "p") for r in ROWS], "doc_id long, text string, lang string, good boolean, perplexity int, piece string")
    model = KneserNey([t for _, t, _, good in ROWS if good], [t for _, t, *_ in ROWS], order)
    found = sorted((tuple(r) for r in quality.perplexities(df, F.col("good"), order=order).collect()), key=lambda r: repr(r[:3]))
    want = sorted(((k, lang, len(t or ""), model.perplexity(t)) for k, t, lang, _ in ROWS), key=lambda r: repr(r[:3]))
    assert [r[:3] for r in found] == [r[:3] for r in want]
    assert [r[3] for r in found] == pytest.approx([r[3] for r in want], rel=1e-5)


def test_probabilities_add_up_to_one():
    texts = ["the cat sat", "the hat"]
    model = KneserNey(texts, texts, ORDER)
    for context in (("t", "h"), ("x", "y"), ("q", "a")):
        total = sum(model.p((*context, c)) for c in {g[-1] for t in texts for g in grams_of(t, ORDER)})
        assert total == pytest.approx(1 - _spared_for_unknown(model, context), abs=1e-9)


def _spared_for_unknown(model, context):
    return model.p((*context, "\0unknown"))


def test_no_training_text_and_no_rows(spark, make, tmp_path):
    df = written(spark, make, str(tmp_path / "d"), ROWS, "doc_id long, text string, lang string, good boolean")
    found = quality.judge(df, F.lit(False)).collect()
    assert len(found) == len(ROWS) and len({round(r.perplexity, 3) for r in found}) == 1
    assert quality.judge(df.where("doc_id > 1000"), F.col("good")).collect() == []


def test_whole_table_tells_bad_from_good(spark, folder, documents):
    rows = {r.doc_id: r for r in quality.op10_kneser_ney_quality(spark, folder).collect()}
    assert sorted(rows) == sorted(documents)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    good = [rows[k].kept for k, q in labels.items() if q == 1]
    bad = [rows[k].kept for k, q in labels.items() if q == 0]
    assert np.mean(good) > 0.97 and (not bad or np.mean(bad) < 0.5)


@pytest.mark.parametrize("size", ["2000", "70000"])
def test_small_batches_give_the_same_perplexities(spark, folder, size):
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    trusted = F.col("doc_id") % 3 == 0
    whole = {r.doc_id: r.perplexity for r in quality.perplexities(docs, trusted).collect()}
    before = spark.conf.get(setting)
    spark.conf.set(setting, size)
    try:
        parts = {r.doc_id: r.perplexity for r in quality.perplexities(docs, trusted).collect()}
    finally:
        spark.conf.set(setting, before)
    assert parts == pytest.approx(whole, rel=1e-5)


def test_bounds_are_quantiles_of_each_language(make):
    values = [("en", math.exp(x / 100)) for x in range(101)] + [(None, 5.0)] * 3
    bounds = {r.lang: r for r in quality.language_bounds(make(values, "lang string, perplexity double"), reach=1.0).collect()}
    assert math.log(bounds["en"].low) == pytest.approx(0.1 - 0.4, abs=0.02) and math.log(bounds["en"].high) == pytest.approx(0.5 + 0.4, abs=0.02)
    assert bounds[None].low < 5 < bounds[None].high


def test_all_documents_labelled_as_good_train_the_model(spark):
    ids = spark.range(30_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 == 0, 0).otherwise(1).alias("quality"))
    labels = ids.unionByName(ids.where("doc_id < 50")).unionByName(ids.limit(1).select(F.lit(None).cast("long").alias("doc_id"), F.lit(1).alias("quality")))
    found = [r.doc_id for r in quality.training_ids(labels).collect()]
    assert sorted(found) == [i for i in range(30_000) if i % 10]


def test_a_piece_forms_its_ngrams_once(monkeypatch):
    forms, called = quality._grams, []
    monkeypatch.setattr(quality, "_grams", lambda *a: called.append(1) or forms(*a))
    blob = lambda text: pa.scalar(quality.packed(np.frombuffer(text, np.uint8), np.array([len(text)], "<i8"), np.empty(0, np.uint8)))
    held, grams = quality._formed_once([blob(b"abab"), blob(b"ba")], 2)
    assert len(called) == 2 and len(held) == 2
    for (_, listed, place, _), want in zip(held, (["^a", "ab", "ba", "ab", "b$"], ["^b", "ba", "a$"])):
        read = lambda g: "".join({0x110000: "^", 0x110001: "$"}.get(c) or chr(c) for c in (int.from_bytes(g[:3]), int.from_bytes(g[3:])))
        assert [read(listed[int(i)].as_py()) for i in place] == want
    assert sorted(set(g for _, listed, *_ in held for g in listed.to_pylist())) == grams.to_pylist()


def test_tables_of_ngrams_are_gone_before_texts_are_sent(spark, make, tmp_path):
    df = written(spark, make, str(tmp_path / "d"), ROWS, "doc_id long, text string, lang string, good boolean")
    with scratch(spark) as folder:
        found = quality.perplexities(df, F.col("good"))
        left = {name.rsplit("-", 1)[0] for name in os.listdir(folder)}
        assert left == {"vocabulary", "gram-values"} and found.count() == len(ROWS)
