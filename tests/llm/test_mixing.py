import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.llm import exchange, mixing


def tokens(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), "\n"]


def base(rows):
    """doc: held out, tokens, known tokens, N, base score."""
    part = lambda k: None if k is None else zlib.crc32(str(k).encode()) % 5
    counts = Counter(t for k, text in rows if part(k) not in (None, 1) for t in tokens(text))
    total, types = sum(counts.values()), len(counts)
    out = []
    for k, text in rows:
        own = tokens(text)
        score = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (types + 1))) for t in own)
        out.append((k, part(k) == 1, len(own), sum(counts[t] > 0 for t in own), total, score))
    return out


def agrees(found, want):
    found = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found), key=lambda r: repr(r[:5]))
    want = sorted(want, key=lambda r: repr(r[:5]))
    assert [r[:5] for r in found] == [r[:5] for r in want]
    assert [r[5] for r in found] == pytest.approx([r[5] for r in want], rel=1e-9)


def test_whole_table(spark, folder, documents):
    found = mixing.op7_context_mixing_scores(spark, folder).collect()
    agrees(found, base([(k, d.text) for k, d in documents.items()]))
    held = [r for r in found if r.held_out]
    # Better than equal chances, and than a tenth more than the smoothed counts, which waste nothing on unknown words.
    assert all(0 < r.bits_per_byte < 8 for r in found)
    assert np.mean([r.bits_per_byte for r in held]) < 3.5


def test_odd_rows(make):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a B a"), (4, "a B a"), (None, "b é"), (5, "x" * 5000 + " y"), (7, "Ünïcode wörd\x0bnext"), (8, "w " * 100_000)]
    df = make([(k, t, 1, "s") for k, t in rows], "doc_id long, text string, score int, piece string")
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    found = mixing.score_texts(df, "doc_id", "text", part == 1, part != 1).collect()
    agrees(found, base(rows))
    assert len({r.score for r in found if r.doc_id == 4}) == 1 and all(r.score < 0 for r in found)
    assert mixing.score_texts(df.limit(0), "doc_id", "text", part == 1, part != 1).collect() == []
    untaught = mixing.score_texts(df, "doc_id", "text", part == 1, F.lit(False)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in untaught)


def model_of(words):
    data = np.frombuffer("".join(words).encode(), np.uint8)
    lengths = np.array([len(w.encode()) for w in words])
    tables = [np.zeros(2 << size) for _, size in mixing.ORDERS]
    for _, _, bits in mixing._batches(data, lengths, 100):
        for table, slot in zip(tables, bits.slots):
            table += np.bincount(2 * slot + bits.value, minlength=len(table))
    return mixing._untrained([t.reshape(-1, 2) for t in tables])


def test_probabilities_of_all_next_bytes_add_up_to_one():
    model = model_of(["the", "then", "they", "there", "\n", "no"] * 5)
    # All words of the prefix 'th' and one more byte: the score without the last space is the prefix's share.
    p = lambda line: sum(math.log10(q) for q in _bit_chances(model, line))
    total = sum(10 ** (p(b"th" + bytes([b])) - p(b"th")) for b in range(256) if b != 0x20)
    space = 10 ** (p(b"th ") - p(b"th"))
    assert total + space == pytest.approx(1, abs=1e-9)


def _bit_chances(model, line):
    """The chance of each bit of some bytes, as the start of a word."""
    bits = mixing._Bits(np.frombuffer(line, np.uint8), np.array([len(line)]))
    chance = model.probability(*model.inputs(bits))
    return np.where(bits.value == 1, chance, 1 - chance)[: 8 * len(line)]


def test_learning_helps(spark):
    words = [f"{a}{b}" for a in ("un", "re", "pre") for b in ("do", "make", "set", "turn")] * 40
    model = model_of(words)
    data = np.frombuffer("".join(words).encode(), np.uint8)
    known = model.word_scores(data, np.array([len(w) for w in words])).mean()
    noise = model.word_scores(np.frombuffer(b"zqxkvjq", np.uint8), np.array([7]))[0]
    assert known > noise + 3


def test_arrays_survive_packing():
    a, b = np.arange(7, dtype="<i4"), np.empty(0, "<f4")
    x, y = exchange.unpacked(exchange.packed(a, b), "<i4", "<f4")
    assert x.tolist() == a.tolist() and len(y) == 0


def test_contexts_cross_words(spark, make):
    """A text scores better than the same words in another order, and scores add up over its bytes."""
    names = ["alpha", "brook", "cedarwood", "delta", "ember", "fjord"]
    lines = [" ".join(names[(i + k) % 6] for k in range(24)) for i in range(6)]
    mixed_up = " ".join(names[(5 * k * k + k) % 6] for k in range(24))
    same_bag = " ".join(sorted(lines[0].split()))
    rows = [*((i, text) for i, text in enumerate(lines * 8)), (100, lines[0]), (101, same_bag), (102, mixed_up)]
    found = mixing.score_texts(make(rows, "doc_id long, text string"), "doc_id", "text", F.col("doc_id") >= 100, F.col("doc_id") < 100).collect()
    score = {r.doc_id: r.score for r in found}
    assert score[100] == pytest.approx(score[0], abs=1e-6)
    assert score[101] < score[100] - 5


def test_heads_are_read_from_whole_lines():
    texts = ["Ab  cdefghij\tk", "", "x"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    lower = mixing.LOWER[data]
    words = mixing.split(lower, np.cumsum([0, *map(len, texts)]), mixing.UNSPACED)
    line, lengths = mixing._lines(words, lower)
    assert line.tobytes() == b"ab cdefghij k \n" + b"\n" + b"x \n" and lengths.tolist() == [15, 1, 3]
    want = []
    for i, text in enumerate([b"ab cdefghij k \n", b"\n", b"x \n"]):
        for at in range(len(text)):
            place = at - (text[:at].rfind(b" ") + 1)
            if place < 6:
                want.append(((place << 56) | int.from_bytes(text[max(0, at - 6) : at + 1], "big"), i))
    items, text_of = mixing._heads(line, lengths)
    assert list(zip(items.tolist(), text_of.tolist())) == want


def test_heads_are_formed_once_for_words_that_open_alike():
    texts = ["the cat the cat the cats", "", "a cat the cat"] * 50
    words = mixing.split(np.frombuffer("".join(texts).encode(), np.uint8), np.cumsum([0, *map(len, texts)]), mixing.UNSPACED)
    line, lengths = mixing._lines(words, words.data)
    every, text_of_every = mixing._heads(line, lengths)
    items, number, owner, opening, text_of = mixing._distinct_heads(line, lengths)
    assert items.tolist() == sorted(set(every.tolist())) and len(number) < len(every) / 20
    cost = np.arange(len(items)) + 1.0
    want = np.bincount(text_of_every, cost[np.searchsorted(items, every)])
    assert np.bincount(text_of, np.bincount(owner, cost[number])[opening]).tolist() == want.tolist()


def test_bits_to_learn_from_are_formed_for_some_batches_at_once(monkeypatch):
    """In the same batches as one by one; a long word doesn't make a group of many."""
    words = sorted({f"word{i * 7919 % 100_003}" for i in range(1500)} | {"x" * 40_000, "y" * 40_000, "z" * 40_000})
    spelled, lengths = np.frombuffer("".join(words).encode(), np.uint8), np.array([len(w) for w in words], "<i4")
    train = (np.arange(len(words)) % 3).astype("<i8")
    formed, form = [], mixing._Bits.__init__
    monkeypatch.setattr(mixing._Bits, "__init__", lambda self, data, *a: formed.append(len(data)) or form(self, data, *a))
    lessons = list(mixing._lessons(False, exchange.packed(spelled, lengths, train)))
    batches = [b - a for _, _, cuts in lessons for a, b in zip(cuts[:-1], cuts[1:])]
    tails = sum(8 * (len(w) - 5) for w, n in zip(words, train) if n)
    assert sum(batches) == tails and min(batches) > 0
    assert len(formed) < len(batches) / 2 and max(formed) < 80_000
    items = np.sort(np.unique(mixing.mixed(np.arange(10_000, dtype=np.uint64)) & np.uint64((1 << 56) - 1)))
    heads = list(mixing._lessons(True, exchange.packed(items, np.ones(len(items), "<i8"))))
    assert len(heads) == 2 and [len(c) - 1 for *_, c in heads] == [16, 11] and all(c[-1] == len(b.value) for b, _, c in heads)


def test_distinct_values_are_numbered_in_order():
    """Equal values get equal numbers, also where hashes meet in a slot; only what is distinct is sorted."""
    rng = np.random.default_rng(6)
    for values in (np.empty(0, np.uint64), np.array([5], np.uint64), rng.choice(rng.integers(0, 1 << 63, 700, np.uint64), 5000)):
        known, want = np.unique(values, return_inverse=True)
        place, number = mixing._distinct(values)
        assert (values[place] == known).all() and (number == want).all()
        place, number = mixing._distinct(values, ordered=False)
        assert (values[place][number] == values).all() and len(place) == len(known)
        of = mixing._examples(values, np.zeros(len(values), np.uint64))  # all in one slot at first
        assert (values[of] == values).all() and len(np.unique(of)) == len(known)
