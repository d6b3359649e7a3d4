import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tallyforge.llm import packing

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(text):
    return np.array(TOKENIZER.encode(text or "", add_special_tokens=False).ids + [0], "<u4")


def check(rows, texts, limit=1024, segments=64):
    """Round trip: the pieces of every document put together give its ids, and sequences are gapless."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for key, text in texts.items():
        ids, at = ids_of(text), 0
        for r in sorted(by_doc[key], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids)) and r.length > 0
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    padding = 0
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= limit and len(parts) <= segments
        padding += 0 if at & (at - 1) == 0 else limit - at
    return padding / sum(r.length for r in rows)


def test_whole_table(spark, folder, documents):
    rows = packing.op5_vector_bin_packing(spark, folder).collect()
    assert check(rows, {k: d.text for k, d in documents.items()}) < 0.01


def test_odd_texts(make):
    texts = {1: None, 2: "", 3: " ", 4: "a", 5: "word " * 30_000, 6: " " * 200_000, 7: "<|endoftext|>"[:5], 8: "é\U0001F600\n\t x", 9: "ab" * 50_000}
    df = make([(k, t, "c", 1) for k, t in texts.items()], "doc_id long, text string, parts string, start int")
    assert check(packing.pack_documents(df).collect(), texts) < 0.01
    assert packing.pack_documents(df.limit(0)).collect() == []
    same = make([(1, "one two"), (1, "one two"), (None, "x")], "doc_id long, text string")
    rows = packing.pack_documents(same).collect()
    assert sum(r.length for r in rows) == 2 * len(ids_of("one two")) + len(ids_of("x"))


def test_special_tokens_in_a_text_are_one_id(make):
    texts = {1: "<|endoftext|>", 2: "a <|endoftext|> b", 3: "<|endoftext|><|endoftext|>", 4: "<|endoftext", 5: "x" * 3_000 + "<|endoftext|>"}
    rows = packing.pack_documents(make(list(texts.items()), "doc_id long, text string")).collect()
    check(rows, texts)
    assert {r.doc_id: r.doc_tokens for r in rows if r.doc_id < 4} == {1: 2, 2: 5, 3: 3}


def test_instruction_data_keeps_all_limits(make):
    limits = packing.Limits(tokens=64, segments=3, loss=20)
    examples = [(i, [("ask " * (i % 7 + 1), False), ("answer " * (i % 11 + 1), True), (None, True)]) for i in range(200)] + [(900, None), (901, []), (902, [(None, None)])]
    df = make(examples, "id long, parts array<struct<text:string,loss:boolean>>")
    rows = packing.pack(df, "id", "parts", limits).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append(r)
    for parts in by.values():
        assert sum(r.length for r in parts) <= 64 and len(parts) <= 3 and sum(r.loss_tokens for r in parts) <= 20
    assert {r.id for r in rows} == {e[0] for e in examples}
    with pytest.raises(ValueError):
        packing.pack(df, "id", "parts", packing.Limits(segments=0))


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.lists(st.booleans(), min_size=1, max_size=60), max_size=40),
    st.integers(1, 16), st.integers(1, 4), st.integers(1, 16), st.integers(1, 8),
)
def test_every_token_once_within_limits(examples, tokens, segments, loss, pool):
    limits = packing.Limits(tokens, segments, loss)
    packer = packing.Packer(limits, pool=pool)
    for i, mask in enumerate(examples):
        packer.add(i, np.cumsum(mask))
    packer.finish()
    seen, use = defaultdict(set), defaultdict(lambda: np.zeros(3, int))
    for i, start, length, lossy, sequence, offset in packer.out:
        assert offset == use[sequence][0] and lossy == sum(examples[i][start : start + length])
        use[sequence] += [length, 1, lossy]
        assert not seen[i] & set(range(start, start + length))
        seen[i] |= set(range(start, start + length))
    assert all(seen[i] == set(range(len(m))) for i, m in enumerate(examples))
    assert all((u <= [tokens, segments, loss]).all() for u in use.values())
