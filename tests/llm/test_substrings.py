import hashlib
import re
from collections import Counter

import pytest

from tallyforge.llm import substrings


def brute_force(rows, window=35):
    texts = [(key, re.findall(r"[^\x20\x09-\x0D]+", text or "")) for key, text in rows]
    places = Counter(tuple(w[i : i + window]) for _, w in texts for i in range(len(w) - window + 1))
    out = []
    for key, w in texts:
        gone = set()
        for i in range(len(w) - window + 1):
            if places[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((key, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_whole_table(spark, folder, documents):
    want = [(k, n, r, hashlib.sha256(t.encode()).hexdigest()) for k, n, r, t in brute_force([(k, d.text) for k, d in documents.items()])]
    assert got(substrings.op2_difference_cover_substring_dedup(spark, folder)) == sorted(want, key=repr)
    assert any(0 < r < n for _, n, r, _ in want)


@pytest.mark.parametrize("period", range(1, 65))
def test_cover_holds_every_shift(period):
    cover = substrings.difference_cover(period)
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))
    assert period < 30 or len(cover) < period / 3


@pytest.mark.parametrize("window, period", [(1, 1), (3, 1), (3, 3), (6, 4), (35, 21)])
def test_windows_at_any_place(make, monkeypatch, window, period):
    monkeypatch.setattr(substrings, "PIECE_BYTES", 60)
    shared = " ".join(f"s{i}" for i in range(window))
    rows = [(i, " ".join([f"u{i}x{j}" for j in range(i)]) + " " + shared + f" v{i}") for i in range(2 * period + 1)]
    rows += [(100, " ".join(shared.split()[:-1])), (101, "a " * (window + 2)), (102, None), (103, ""), (104, " \n "), (None, shared), (None, "z"), (100, "q")]
    df = make([(k, t, 0, "x") for k, t in rows], "doc_id long, text string, piece int, rows string")
    assert got(substrings.without_repeats(df, window=window, period=period)) == brute_force(rows, window)
    assert got(substrings.without_repeats(df.limit(0), window=window, period=period)) == []


def test_repeated_rows_and_a_very_long_text(make):
    long = " ".join(f"w{i * i % 50021}" for i in range(120_000))
    rows = [(1, long), (1, "b " + " ".join(long.split()[777:900]) + " e"), (2, "same text " * 30), (2, "same text " * 30)]
    assert got(substrings.without_repeats(make(rows, "doc_id long, text string"))) == brute_force(rows)
