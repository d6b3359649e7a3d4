import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from tallyforge.llm import filters, words as W
from tallyforge.llm.graph import components

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="abZ9é ñ \n\t.-", max_size=40)), max_size=8)


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    column = pa.array(texts, pa.string())
    found = []
    for _, _, data, offsets in W.pieces(column, limit=16):
        w = W.split(W.LOWER[data], offsets, W.ALPHANUMERIC)
        spans = [w.data[s:e].tobytes().decode() for s, e in zip(w.starts, w.ends)]
        found += [spans[a:b] for a, b in zip(w.first, w.first[1:])]
    lower = [re.sub("[A-Z]", lambda m: m[0].lower(), t or "") for t in texts]
    assert found == [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t) for t in lower]


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_joined_words(texts):
    for _, _, data, offsets in W.pieces(pa.array(texts, pa.string())):
        w = W.split(data, offsets, W.UNSPACED)
        line, starts, ends = W.joined(w, W.UNSPACED)
        for i, text in enumerate(texts):
            a, b = w.first[i], w.first[i + 1]
            got = line[starts[a] : ends[b - 1]].decode() if b > a else ""
            assert got == " ".join(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_hashes_tell_words_and_runs_apart():
    text = "a b ab ba abcdefgh abcdefghi abcdefgh\x01 x" * 2 + " abcdefghabcdefghabcdefgh"
    _, _, data, offsets = next(W.pieces(pa.array([text])))
    w = W.split(data, offsets, W.UNSPACED)
    spans = [w.data[s:e].tobytes() for s, e in zip(w.starts, w.ends)]
    hashes = W.word_hashes(w)
    assert len(set(spans)) == len(set(hashes.tolist())) == len(set(zip(spans, hashes.tolist())))
    for length in (1, 2, 3, 7, 35):
        runs = [tuple(spans[i : i + length]) for i in range(len(spans) - length + 1)]
        made = W.run_hashes(hashes, length).tolist()
        assert len(made) == len(runs) and len(set(zip(runs, made))) == len(set(runs)) == len(set(made))


@pytest.mark.parametrize("count", [0, 1, 5000])
def test_filter_has_no_false_negatives(spark, count):
    hashes = W.mixed(np.arange(count, dtype=np.uint64)).view(np.int64)
    df = spark.createDataFrame([(int(h),) for h in hashes] + [(None,)], "h long")
    bits = filters.build(df, "h", 1 << 16)
    assert W.membership(bits, hashes.view(np.uint64)).all()
    others = W.mixed(np.arange(10**6, 10**6 + 2000, dtype=np.uint64))
    assert W.membership(bits, others).mean() < 0.05


def test_components_of_chains_stars_and_nulls(spark):
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(100, 100 + i) for i in range(1, 300)]
    other = [(500, 501), (501, 500), (7, 7), (600, None), (None, None), (None, 601)]
    found = {r.node: r.root for r in components(spark.createDataFrame(chain + star + other, "a long, b long").repartition(4)).collect()}
    want = {i: 0 for i in range(61)} | {100 + i: 100 for i in range(300)} | {500: 500, 501: 500}
    assert found == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
