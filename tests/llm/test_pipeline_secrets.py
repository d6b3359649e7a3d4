import corpus_pipeline as cp
from tallyforge.llm import secrets

PHRASE = "copper-lantern-meadow-orchid"


def test_words_of_texts_without_credentials_are_known(spark, make, folder):
    """A passphrase of words common elsewhere in the corpus stays; the stage masks what op4 finds on the same rows."""
    rows = [(1, f"my password is {PHRASE} today"), (2, "the password is xK7#pQ2!mZ9&vT today"), (3, "pass: abcdefgh"), (None, None)]
    rows += [(10 + i, "copper lantern meadow orchid common words " * 20) for i in range(5)]
    docs = make(rows, "doc_id long, text string")
    texts = {r.doc_id: r.text for r in docs.collect()}
    spans = {r.doc_id: [(s.start, s.end) for s in r.spans] for r in secrets.find_secrets(docs).collect()}
    out = {r.doc_id: r.text for r in cp.mask_secrets(spark, docs, folder).collect()}
    assert out == {k: cp.masked(t, spans[k]) for k, t in texts.items()}
    assert out[1] == texts[1] and cp.MASK in out[2]


def test_stage_and_op4_agree_on_the_whole_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    spans = {r.doc_id: [(s.start, s.end) for s in r.spans] for r in secrets.find_secrets(docs).collect()}
    out = {r.doc_id: r.text for r in cp.mask_secrets(spark, docs, folder).collect()}
    assert out == {r.doc_id: cp.masked(r.text, spans[r.doc_id]) for r in docs.collect()}
