import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers

from tallyforge.llm import alignment

ODD = [
    (1, None), (2, ""), (3, " "), (4, "a"), (5, "Hello, world!  Two spaces\n\tand tabs"), (6, "a <|endoftext|> b <s> </s> <unk>"), (7, "low ▁ line"),
    (8, "naïve café 東京 😀 é"), (None, "Hello, world!"), (5, "Hello, world!  Two spaces\n\tand tabs"), (9, "x" * 5_000 + " end"), (10, "word " * 20_000),
    (11, "zero\x00byte <0x41>"), (12, "   odd spaces \r\n"),
]


@pytest.fixture(scope="module")
def plain():
    """The two tokenizers, as their files are meant to be read."""
    a = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    letters = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in letters]
    decode = {chr(b): b for b in letters} | {chr(256 + i): b for i, b in enumerate(rest)}
    spell_a = {i: bytes(decode[c] for c in t) for t, i in a.get_vocab(with_added_tokens=False).items() if all(c in decode for c in t)}
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    return a, spell_a, b


def spell_b(model, i):
    piece = model.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()


def groups_of(plain, text):
    """Ids by group, with links, by looking at every pair of a group."""
    a, spell_a, b = plain
    if not text:
        return [], []
    one = [(i, spell_a[i]) for i in a.encode(" " + text, add_special_tokens=False).ids]
    two = [(i, spell_b(b, i)) for i in b.encode(text)]
    want = (" " + text).encode()
    if b"".join(s for _, s in one) != want or b"".join(s for _, s in two) != want:
        return [], []
    spans = []
    for side in (one, two):
        at, mine = 0, []
        for i, s in side:
            mine.append((i, at, at + len(s)))
            at += len(s)
        spans.append(mine)
    ends = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
    groups, links, last = [], [], 0
    for end in ends:
        x, y = ([t for t in side if last < t[2] <= end] for side in spans)
        groups.append(([t[0] for t in x], [t[0] for t in y]))
        links += [(p, q) for p, s, e in x for q, t, f in y if s < f and t < e]
        last = end
    return groups, links


def brute_force(plain, rows):
    made = [(key, *groups_of(plain, text)) for key, text in rows]
    count = Counter(pair for _, _, links in made for pair in set(links))
    best = {}
    for (a, _), n in count.items():
        best[a] = max(best.get(a, 0), n)
    out = []
    for key, groups, links in made:
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((
            key, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links), sum(count[x] == best[x[0]] for x in links),
            sum(count[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if groups else "",
        ))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_gallop_finds_what_a_binary_search_does():
    rng = random.Random(1)
    for _ in range(300):
        short, long = (np.array(sorted(rng.sample(range(400), rng.randrange(0, 60))), np.int64) for _ in range(2))
        assert (alignment.gallop(short, long) == np.searchsorted(long, short)).all()
    clustered = np.sort(np.concatenate([np.arange(5_000), 10**9 + 7 * np.arange(50_000)]))
    some = clustered[:: 37]
    assert (alignment.gallop(some, clustered) == np.arange(len(clustered))[::37]).all()


def test_whole_table(spark, folder, documents, plain):
    assert got(alignment.op11_galloping_token_alignment(spark, folder)) == brute_force(plain, [(k, r.text) for k, r in documents.items()])


def test_odd_rows(make, plain):
    found = got(alignment.linked_documents(make(ODD, "doc_id long, text string")))
    assert found == brute_force(plain, ODD)
    assert {r[0] for r in found if r[1] == 0} == {1, 2, 7}


def test_groups_as_lists(make, plain):
    for r in alignment.align(make(ODD, "id long, body string"), "id", "body").collect():
        starts = [0, *r.until_a], [0, *r.until_b]
        cut = [(r.a[p:q], r.b[s:t]) for p, q, s, t in zip(starts[0], r.until_a, starts[1], r.until_b)]
        texts = [text for key, text in ODD if key == r.id]
        assert cut == groups_of(plain, texts[0])[0]


def test_both_libraries_of_the_byte_vocabulary_agree(documents):
    tokens, _ = alignment.both()
    for r in documents.values():
        text = " " + (r.text or "")
        assert tokens.fast.encode_ordinary(text) == tokens.sure.encode(text, add_special_tokens=False).ids


def test_empty_table_and_clashing_names(make):
    empty = make([], "doc_id long, text string")
    assert alignment.linked_documents(empty).collect() == [] and alignment.align(empty).collect() == []
    docs = make([(1, "one two", "x", 2)], "doc_id long, text string, key string, piece int").withColumns({n: alignment.F.lit(0) for n in ("pair", "n_a", "count", "keys", "at")})
    assert alignment.linked_documents(docs).columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert alignment.linked_documents(docs).count() == 1
