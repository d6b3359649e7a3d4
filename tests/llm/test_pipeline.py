import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from tallyforge.llm import secrets
from tests.llm import test_decontamination, test_packing, test_resemblance, test_secrets


def test_masked():
    assert cp.masked(None, [(0, 1)]) is None
    assert cp.masked("abcdef", []) == "abcdef"
    assert cp.masked("abcdef", [(4, 5), (0, 2), (1, 3)]) == f"{cp.MASK}d{cp.MASK}f"


def table(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_stages_over_the_whole_table(spark, folder, tmp_path):
    """Each stage against brute force on what the stage before kept."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for number, (name, stage) in enumerate(cp.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        out = stage(spark, docs, folder)
        path = str(tmp_path / str(number))
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        if name == "packing":
            rows = docs.collect()
            assert test_packing.check(rows, {k: r.text for k, r in before.items()}) < 0.01
            continue
        assert docs.columns == columns
        after = {r.doc_id: r for r in docs.collect()}
        if name == "language ID":
            assert after == {k: r for k, r in before.items() if r.text and any(c.isalpha() for c in r.text)}
        elif name == "SimHash near-dedup":
            roots = test_resemblance.brute_force([(k, r.text) for k, r in before.items()])
            assert after == {k: before[k] for k, root in roots.items() if k == root}
            assert len(after) < len(before)
        elif name == "benchmark decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
            hit = {k for k, _, n, _ in test_decontamination.brute_force([(k, r.text) for k, r in before.items()], items) if n}
            assert after == {k: r for k, r in before.items() if k not in hit} and hit
        else:
            assert set(after) == set(before)
            for k, r in after.items():
                assert not test_secrets.base(r.text) and r.n_chars == len(r.text)
                if not test_secrets.base(before[k].text) and not secrets.values_in_context(before[k].text):
                    assert r == before[k]


def test_run_gives_the_pieces(spark, folder):
    rows = cp.run(spark, folder)
    assert {"doc_id", "sequence_id", "offset"} <= set(rows.columns) and rows.count() > 0


ODD = [
    (1, None, "en"), (2, "", None), (3, "123 --", "en"), (4, "The cat sat on the mat. token = 0123456789abcdef0123", "en"), (4, "The cat sat on the mat. token = 0123456789abcdef0123", "en"),
    (None, "the cat sat on the hat", "en"), (None, "el niño", "es"), (5, "the dog " * 20_000, "en"), (6, "The Cat sat on the mat. token = 0123456789abcdef0123", "en"), (8, "das ist", "de"),
]


def test_odd_rows_go_through_all_stages(spark, make, folder):
    rows = [(k, t, lang, "s", len(t or ""), "extra", 1, 2.5) for k, t, lang in ODD]
    docs = make(rows, "doc_id long, text string, lang string, source string, n_chars long, fingerprint string, row int, score double")
    docs = docs.unionByName(docs.where("doc_id = 8").withColumn("doc_id", F.lit(0).cast("long")))
    columns = docs.columns
    for name, stage in cp.STAGES[:-1]:
        docs = cp.stored(stage(spark, docs, folder), "odd")
        assert docs.columns == columns
    texts = {(r.doc_id, r.text) for r in docs.collect()}
    assert docs.count() == len(texts)
    assert (4, f"The cat sat on the mat. {cp.MASK}") in texts and not any(re.search("[0-9a-f]{16}", t) for _, t in texts)
    assert {k for k, _ in texts} == {0, 4, None, 5}
    assert sum(k is None for k, _ in texts) == 2
    assert {r.fingerprint for r in docs.collect()} == {"extra"}


def test_columns_of_any_name_pass_through(spark, make, folder):
    """Columns with names that stages use for themselves, in upper case as well, keep their values."""
    names = ["_language", "_likeness", "_row_a", "_ROW_B", "_spans", "__spans", "key", "component_id", "bands", "count"]
    rows = [(k, t, lang, f"source {k}", len(t or ""), *(f"{n} {k}" for n in names)) for k, t, lang in ODD if k is not None]
    docs = make(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in names))
    for name, stage in cp.STAGES[:-1]:
        columns = docs.columns
        docs = cp.stored(stage(spark, docs, folder), "names")
        assert docs.columns == columns
    found = docs.collect()
    assert found and all(r[n] == f"{n} {r.doc_id}" for r in found for n in names)
    assert cp.pack_sequences(spark, docs, folder).count()


@pytest.mark.parametrize("number", range(len(cp.STAGES)))
def test_empty_table(spark, folder, number):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    assert cp.STAGES[number][1](spark, docs, folder).collect() == []
