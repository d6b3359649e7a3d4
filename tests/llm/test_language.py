import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.llm import language

DIM = 256


def profile(text):
    """Gram by gram, from the definition."""
    codes = [language._letters()[ord(c)] for c in text]
    padded = [0, *codes, 0]
    total = np.zeros(DIM)
    for a, b, c in zip(padded, padded[1:], padded[2:]):
        if b:
            va, vb, vc = (language._letter_vector(int(x), DIM).astype(float) for x in (a, b, c))
            total += np.roll(va, 2) * np.roll(vb, 1) * vc
    return total


def cosine(a, b):
    return float(a @ b / np.linalg.norm(a) / np.linalg.norm(b))


def test_held_out_accuracy_over_the_whole_table(spark, folder, documents):
    rows = language.op1_hyperdimensional_language_id(spark, folder).collect()
    assert sorted(r.doc_id for r in rows) == sorted(documents)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(held) > 20 and np.mean([r.lang_pred == documents[r.doc_id].lang for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_agrees_with_profiles_made_gram_by_gram(make):
    texts = {"xa": ["The hat, the cat", "a hat"], "xb": ["Ñandú é niño", "ño"], "xc": ["日本語 日本", "語"]}
    train = make([(i, t, lang) for lang, ts in texts.items() for i, t in enumerate(ts)], "doc_id long, text string, lang string")
    labels, vectors = language.prototypes(train, F.col("lang"), dimensions=DIM)
    assert labels == ["xa", "xb", "xc"]
    want = np.array([sum(profile(t) for t in ts) for ts in texts.values()])
    assert np.array_equal(vectors, want)
    asked = ["that cat", "niños", "本", "x9-y", "the niño", "É"]
    found = {r.text: r for r in language.identify(make([(t,) for t in asked], "text string"), labels, vectors).collect()}
    for text in asked:
        scores = [cosine(profile(text), v) for v in want]
        assert found[text].lang_pred == labels[int(np.argmax(scores))]
        assert found[text].score == pytest.approx(max(0, max(scores)), abs=1e-5)


def test_nulls_empty_long_repeated_and_clashing_columns(make):
    schema = "doc_id long, text string, lang string, lang_pred int, score string, held_out int"
    long = "the cat sat on the mat " * 40_000
    rows = [(1, None, "xa"), (2, "", "xa"), (3, "123 \n !", "xb"), (4, "the cat", "xa"), (4, "the cat", "xa"), (None, "el niño", "xb"), (5, long, "xa"), (6, "niño", "xb"), (7, "the", None)]
    df = make([(*r, 1, "s", 2) for r in rows], schema)
    labels, vectors = language.learn(df)
    assert set(labels) <= {"xa", "xb"}
    found = language.identify(df, labels, vectors).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: (r.lang_pred, r.score) for r in found}
    assert by_id[1] == by_id[2] == by_id[3] == ("und", 0.0)
    assert by_id[5][0] == "xa"
    assert len({(r.lang_pred, r.score) for r in found if r.doc_id == 4}) == 1
    nothing, none = language.learn(df.limit(0))
    assert nothing == [] and language.identify(df.limit(0), nothing, none).collect() == []
    assert {r.lang_pred for r in language.identify(df, nothing, none).collect()} == {"und"}
