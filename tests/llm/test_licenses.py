import math
import random
import re
from collections import Counter

import pytest

from tallyforge.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_force(rows, containment=0.8):
    out = []
    for key, text in rows:
        w = words(text)
        base = []
        for phrase, label in licenses.PHRASES.items():
            p = phrase.split()
            base += [(label, i) for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
        best = {}
        for label, template in [(label, t) for label, texts in licenses.ALL_TEMPLATES.items() for t in texts]:
            step = 32
            while step < len(words(template)):
                step *= 2
            need = set(words(template))
            for first in range(0, max(1, math.ceil((len(w) - 2 * step) / step) * step + 1), step):
                block = set(w[first : first + 2 * step])
                share = len(need & block) / len(need)
                if len(need & block) >= math.ceil(containment * len(need)):
                    best[label] = max(best.get(label, 0), share)
        labels = sorted({b for b, _ in base} | set(best))
        at = [i for _, i in base]
        score = 1.0 if base else max(best.values(), default=0.0)
        out.append((key, len(w), len(base), min(at, default=None), max(at, default=None), ",".join(sorted({b for b, _ in base})), ",".join(labels), score))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_whole_table(spark, folder, documents):
    want = brute_force([(k, d.text) for k, d in documents.items()])
    assert got(licenses.op9_prefix_filtered_license_scan(spark, folder)) == want
    assert any(n for _, _, n, *_ in want)


def test_cases(make, tmp_path, spark):
    templates = licenses.TEMPLATES
    filler = " ".join(f"w{i}" for i in range(50))
    rows = [
        (1, None), (2, ""), (3, "-- ."), (4, "MIT License"), (4, "MIT License"), (None, "the Apache-License"), (5, "mit mit license mit\nLICENSE general public license"),
        (6, "mit"), (7, "license mit"), (8, filler + " " + templates["mit"] + " " + filler), (9, " ".join(reversed(words(templates["bsd"])))),
        (10, " ".join(words(templates["gpl"])[: int(0.75 * len(words(templates["gpl"])))])), (11, "é mit license ñ" * 3), (12, filler * 400 + " general public license"),
        *((100 + i, " ".join(words(t)[:-2]) + " " + filler) for i, t in enumerate(templates.values())),
        *((200 + i, " ".join(f"x{j}" for j in range(i)) + " " + templates["isc"]) for i in range(0, 70, 3)),
    ]
    path = str(tmp_path)
    make([(k, t, "l", 0) for k, t in rows], "doc_id long, text string, label string, row int").write.parquet(f"{path}/documents.parquet")
    assert got(licenses.op9_prefix_filtered_license_scan(spark, path)) == brute_force(rows)
    empty = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    assert licenses.find_licenses(empty).collect() == []
    with pytest.raises(ValueError):
        licenses.find_licenses(empty, templates={"x": ["words", "-- ?"]})


def test_whole_licenses_anywhere(make, tmp_path, spark):
    """Texts far longer than a sentence, at many places, some with words left out or a text in front that is as long."""
    rng = random.Random(6)
    rows = []
    for i, (label, text) in enumerate(licenses.TEXTS.items()):
        spelled = words(text)
        for j, before in enumerate(range(0, 700, 97)):
            left = [w for k, w in enumerate(spelled) if k % 12 or j % 2]
            rows.append((100 * i + j, " ".join([f"x{k}" for k in range(before)] + left + [f"y{k}" for k in range(300)])))
        rng.shuffle(spelled)
        rows.append((100 * i + 50, " ".join(spelled[: int(0.6 * len(spelled))])))
    path = str(tmp_path)
    make(rows, "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    found = got(licenses.op9_prefix_filtered_license_scan(spark, path))
    assert found == brute_force(rows)
    labels = {r[0]: r[6].split(",") for r in found}
    assert all(label in labels[100 * i + j] for i, label in enumerate(licenses.TEXTS) for j in range(8))


def test_templates_of_any_length(make):
    long = " ".join(f"t{i}" for i in range(1_000))
    docs = make([(1, "a " * 777 + long + " b" * 500), (2, long[: len(long) // 2])], "doc_id long, text string")
    found = {r.doc_id: r.matches for r in licenses.find_licenses(docs, templates={"long": [long], "short": ["b"]}).collect()}
    assert [(m.label, m.containment) for m in found[1]] == [("long", 1.0), ("short", 1.0)] and found[2] == []


def test_rarest_words_come_first(make):
    df = make([(1, "the the of"), (2, "the of rare")], "doc_id long, text string")
    assert licenses.token_order(df, "text", ["of", "rare", "the", "zero"]) == ["zero", "rare", "of", "the"]
    assert Counter(licenses.words_of("Add-on, the ADD")) == Counter(["add", "on", "the", "add"])
