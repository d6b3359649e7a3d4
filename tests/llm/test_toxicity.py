import random
import re

import numpy as np
import pytest

from tallyforge.llm import toxicity

BAD = ["vile", "rotten", "wretch"]


def invented(rng, toxic, sentences):
    """A text whose sentences are harmless, but for a third of them where it is toxic."""
    out = []
    for i in range(sentences):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(4, 10))]
        if toxic and (i % 3 == 0):
            words[rng.randrange(len(words))] = rng.choice(BAD) + rng.choice(["", "est", "ness"])
        out.append(" ".join(words).capitalize())
    return ". ".join(out) + "."


def table(make, rng, count):
    rows, labels = [], []
    for i in range(count):
        toxic = i % 5 == 0
        rows.append((i, invented(rng, toxic, rng.randrange(1, 30))))
        if i % 2:
            labels.append((i, int(toxic)))
    return rows, labels


def brute_scores(model, text):
    """The score of a text and of its sentences, sentence by sentence."""
    lower = re.sub("[A-ZÀ-ÖØ-Þ]", lambda m: m[0].lower(), text or "")
    parts = []
    for m in re.finditer(r"[^.!?\n\r]+", lower):
        words = [w.encode() for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", m[0])]
        if words:
            parts.append(words)
    scores = []
    for words in parts:
        data = np.frombuffer(b" ".join(words), np.uint8)
        found = toxicity.sentences(data, np.array([0, len(data)]))
        keys = {int(k) for _, part in toxicity.features(found.words) for k in part}
        logit = model.base + model.length * np.log(max(1, len(parts))) + sum(w for k, w in zip(model.keys.tolist(), model.weights) if k in keys)
        scores.append(1 / (1 + np.exp(-logit)))
    return 1 - (1 - 1 / (1 + np.exp(-model.leak))) * np.prod([1 - p for p in scores]), scores


def test_learns_and_locates(make):
    rng = random.Random(2)
    rows, labels = table(make, rng, 900)
    docs, known = make(rows, "doc_id long, text string"), make(labels, "doc_id long, toxic int")
    model = toxicity.learn(docs, known)
    texts, right = dict(rows), 0
    for r in toxicity.judge(docs, model).collect():
        right += (r.score >= toxicity.THRESHOLD) == (r.doc_id % 5 == 0)
        want, each = brute_scores(model, texts[r.doc_id])
        assert abs(r.score - want) < 1e-9 and r.sentences == len(each)
        assert [round(s.score, 9) for s in r.offending] == [round(p, 9) for p in each if p >= toxicity.THRESHOLD]
        for s in r.offending:
            assert any(w in texts[r.doc_id][s.start : s.end].lower() for w in BAD)
    assert right >= 0.97 * len(rows) and model.weights.max() > 1


def test_fit_follows_the_gradient_of_the_likelihood():
    """The trained parameters can't be improved by small steps."""
    rng = np.random.default_rng(3)
    count = rng.integers(1, 6, 200)
    doc = np.repeat(np.arange(200), count)
    sentence = np.concatenate([np.arange(c) for c in count])
    feature = rng.integers(0, 6, len(doc))
    p = 1 / (1 + np.exp(-(-3 + 4.0 * (feature == 2))))
    toxic = np.array([rng.random() < 1 - np.prod(1 - p[doc == d]) for d in range(200)])
    model = toxicity.fit(toxic, np.ones(200), count, doc, sentence, feature, np.arange(6, dtype=np.uint64))

    def loss(w, base, length, leak):
        logits = base + length * np.log(count)[doc] + w[feature]
        s = np.logaddexp(0, leak) + np.bincount(doc, np.logaddexp(0, logits), minlength=200)
        return np.mean(np.where(toxic, -np.log(-np.expm1(-s)), s)) + toxicity._DECAY / 2 * (w**2).sum()

    best = loss(model.weights, model.base, model.length, model.leak)
    for i in range(6):
        for step in (-0.3, 0.3):
            w = model.weights.copy()
            w[i] += step
            assert loss(w, model.base, model.length, model.leak) > best - 1e-4
    assert model.weights.argmax() == 2


def test_held_out_accuracy_on_the_whole_table(spark):
    """On a larger table, by the ids that are held out; about one label in fifty is noise."""
    folder = "/root/testdata/sf0.1"
    found = {r.doc_id: r for r in toxicity.op13_multiple_instance_toxicity(spark, folder).collect()}
    assert len(found) == spark.read.parquet(f"{folder}/documents.parquet").count()
    held = [(r.toxic, found[r.doc_id]) for r in spark.read.parquet(f"{folder}/labels.parquet").collect() if found[r.doc_id].held_out and r.toxic is not None]
    bad, good = [f for t, f in held if t], [f for t, f in held if not t]
    assert sum(f.predicted for f in bad) >= 0.85 * len(bad)
    assert sum(f.predicted for f in good) <= 0.02 * len(good)
    assert all(0 <= f.score <= 1 and f.predicted == (f.score >= 0.3) for f in found.values())


ODD = [(1, None), (2, ""), (3, "...!?"), (4, "Vile"), (None, "vile"), (None, "vile"), (5, "fine " * 50_000 + "vile."), (6, "ÉTÉ vile été 東京。\nNext line"), (6, "ÉTÉ vile été 東京。\nNext line")]


def test_odd_rows(make):
    rng = random.Random(4)
    rows, labels = table(make, rng, 300)
    model = toxicity.learn(make(rows, "doc_id long, text string"), make([*labels, (None, 1), (7, None), (9, 0), (9, 1)], "doc_id long, toxic int"))
    docs = make(ODD, "doc_id long, text string").withColumns({n: toxicity.F.lit("x") for n in ("score", "key", "offending", "toxic", "sentences")})
    found = toxicity.judge(docs, model)
    assert found.columns == ["doc_id", "score", "sentences", "offending"]
    texts = dict(ODD)
    for r in found.collect():
        want, each = brute_scores(model, texts[r.doc_id])
        assert abs(r.score - want) < 1e-9 and r.sentences == len(each)
    assert found.count() == len(ODD)


@pytest.mark.parametrize("labels, score", [([], 0.0), ([(1, 0)], 0.0), ([(1, 1)], 1.0)])
def test_labels_of_one_kind_or_none(make, labels, score):
    docs = make([(1, "one two."), (2, None)], "doc_id long, text string")
    model = toxicity.learn(docs, make(labels, "doc_id long, toxic int"))
    assert [r.score for r in toxicity.judge(docs, model).collect()] == [score, score]


def test_empty_table(make):
    docs = make([], "doc_id long, text string")
    model = toxicity.learn(docs, make([(1, 1)], "doc_id long, toxic int"))
    assert toxicity.judge(docs, model).collect() == []
