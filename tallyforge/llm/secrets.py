"""Secret scans: fixed patterns, and the cost of guessing values that stand where credentials stand.

A value after a credential word is split, by dynamic programming, into the segments that make it cheapest
to guess: words of the corpus, dates, repeats, keyboard walks and brute-force spans. A value that stays
expensive is a secret; 'token = the' or 'password: 12345678' is none.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyforge.llm import filters
from tallyforge.llm.words import ALPHANUMERIC, LOWER, bounded_batches, membership, pieces, split, word_hashes
from tallyforge.session import stored

# The patterns, with the shortest match that counts, in the order of their kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ASSIGN_VALUE = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "guess")
# Words that announce a credential, beyond those of ASSIGN.
CONTEXT = re.compile(
    r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_\x20-]?key|credentials?|auth(?:orization)?|private[_\x20-]?key)["']?"""
    r"""(?:\x20*[:=]\x20*|\x20is\x20)["']?([^\s"',;]{6,})""",
    re.ASCII | re.IGNORECASE,
)
# Rows of keys, as they lie on a keyboard.
KEY_ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")

#: A value is a secret if the attacker needs at least 10 to this power guesses.
THRESHOLD = 10.0
LONGEST_WORD = 24
SHORTEST_WORD = 3
#: Letters of a value whose parts are held at once.
_STRETCH = 2_000
#: Guesses for a character that nothing explains, as a power of 10, by its class.
_CLASSES = ((str.isdigit, 1.0), (str.islower, math.log10(26)), (str.isupper, math.log10(26)), (lambda c: True, math.log10(33)))
_BETWEEN = math.log10(2)  # where one segment ends and the next begins
_DATE = re.compile(r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d|(?:19|20)\d\d", re.ASCII)
_DATE_GUESSES = {True: math.log10(365 * 200), False: math.log10(200)}


@lru_cache(maxsize=1)
def _neighbours() -> frozenset[tuple[str, str]]:
    """Keys that touch: in one row, or in two rows at the same place or the one before."""
    pairs = set()
    for r, row in enumerate(KEY_ROWS):
        for i, key in enumerate(row):
            near = [row[j] for j in (i - 1, i + 1) if 0 <= j < len(row)]
            near += [KEY_ROWS[q][j] for q, js in ((r + 1, (i - 1, i)), (r - 1, (i, i + 1))) if 0 <= q < len(KEY_ROWS) for j in js if 0 <= j < len(KEY_ROWS[q])]
            pairs |= {(key, n) for n in near}
    return frozenset(pairs)


def _single(c: str) -> float:
    return next(cost for test, cost in _CLASSES if test(c))


def _runs(value: str, goes_on) -> list[int]:
    """For each place the end of the run that starts there: one more character as long as `goes_on`."""
    ends = [len(value)] * len(value)
    for i in range(len(value) - 2, -1, -1):
        ends[i] = ends[i + 1] if goes_on(value[i], value[i + 1]) else i + 1
    return ends


def guess_cost(value: str, words: dict[str, float]) -> float:
    """The power of 10 of the guesses for the cheapest segmentation of `value`. `words`: the same for known lower-case words.

    Time grows with the length of the value, not with its square, but for the runs it holds.
    """
    lower = value.lower()
    if len(lower) != len(value):  # some letters grow when lower-cased
        lower = value
    n = len(value)
    best = [0.0] + [math.inf] * n
    same = _runs(value, lambda a, b: a == b)
    near = _neighbours()
    walk = _runs(lower, lambda a, b: (a, b) in near)
    step = _runs(value, lambda a, b: ord(b) - ord(a) == 1)
    dates = {m.start(): m.group() for m in (_DATE.match(value, i) for i, c in enumerate(value) if c.isdigit() and c.isascii()) if m}
    dull = 0.0  # cost of the brute-force span that ends here, with what stands before it
    for i in range(n):
        dull = min(dull, best[i] + (_BETWEEN if i else 0.0)) + _single(value[i])
        best[i + 1] = min(best[i + 1], dull)
        so_far = best[i] + (_BETWEEN if i else 0.0)

        def offer(end: int, cost: float) -> None:
            best[end] = min(best[end], so_far + cost)

        for runs, shortest, start in ((same, 3, _single(value[i])), (walk, 4, math.log10(47)), (step, 3, _single(value[i]))):
            if runs[i] - i >= shortest:
                turns = 0.3 * (runs[i] - i - 1) if runs is walk else 0.0
                offer(runs[i], start + math.log10(runs[i] - i) + turns)
        if i in dates:
            offer(i + len(dates[i]), _DATE_GUESSES[len(dates[i]) > 4])
        for end in range(i + SHORTEST_WORD, min(n, i + LONGEST_WORD) + 1):
            cost = words.get(lower[i:end])
            if cost is not None:
                part = value[i:end]
                caps = 0.0 if part.islower() else math.log10(2) if part.istitle() or part.isupper() else math.log10(end - i + 1) + 0.3 * sum(map(str.isupper, part))
                offer(end, cost + caps)
    return best[n]


def parts_of(value: str) -> Iterator[set[str]]:
    """The letter sequences in a value that may be words, the distinct ones of a stretch at a time."""
    for run in re.findall(r"[^\W\d_]+", value.lower()):
        for first in range(0, len(run), _STRETCH):
            starts = range(first, min(len(run), first + _STRETCH))
            yield {run[i:end] for i in starts for end in range(i + SHORTEST_WORD, min(len(run), i + LONGEST_WORD) + 1)}


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Start, kind and end of what the fixed patterns find, sorted."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def values_in_context(text: str) -> list[tuple[int, int, str]]:
    """Start, end and text of the values that stand after a credential word."""
    return [(m.start(1), m.end(1), m[1]) for m in CONTEXT.finditer(text)]


_SPAN = "struct<start:long,kind:int,end:long>"
_VALUE = "struct<start:long,end:long,value:string>"


def _scan(docs: DataFrame, key: str, text: str) -> DataFrame:
    """`key`, `spans` of the patterns and `found`, the values in context, for every row."""
    kind = docs.schema[key].dataType.simpleString()
    span = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
    value = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())])

    def run(batches):
        for batch in batches:
            spans, found = [], []
            for t in batch.column(1):
                t = t.as_py() or ""
                spans.append([dict(zip(("start", "kind", "end"), s)) for s in base_spans(t)])
                found.append([dict(zip(("start", "end", "value"), s)) for s in values_in_context(t)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(span)), pa.array(found, pa.list_(value))], [key, "spans", "found"])

    return bounded_batches(docs).select(key, text).mapInArrow(run, f"`{key}` {kind}, spans array<{_SPAN}>, found array<{_VALUE}>")


def _parts(values: DataFrame, bits=None) -> DataFrame:
    """`id` and `word`, the parts of each value of `values` (`id`, `value`), a stretch of a value at a time; with the bits of a filter only those that may be in it."""

    def run(batches):
        for batch in batches:
            for number, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                for some in parts_of(value.as_py()):
                    words = pa.array(sorted(some), pa.large_string())
                    if bits is not None and len(words):
                        hashes = np.concatenate([word_hashes(split(d, o, np.ones(256, bool))) for _, _, d, o in pieces(words)])
                        words = words.filter(pa.array(membership(bits.value, hashes)))
                    if len(words):
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(words), number)), words.cast(pa.string())], ["id", "word"])

    return values.select("id", "value").mapInArrow(run, "id long, word string")


def _filter_of(words: DataFrame):
    """A broadcast filter, of fixed size, of the column `word`."""

    def hashed(batches):
        for batch in batches:
            hashes = [word_hashes(split(d, o, np.ones(256, bool))) for _, _, d, o in pieces(batch.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(hashes).view(np.int64) if hashes else [], pa.int64())], ["h"])

    return words.sparkSession.sparkContext.broadcast(filters.build(words.select("word").mapInArrow(hashed, "h long"), "h"))


def word_costs(docs: DataFrame, text: str, values: DataFrame) -> DataFrame:
    """`word` and `cost`, for each part of a value (columns `id`, `value`) that is a word of the corpus: log10 of all words over its count.

    All whole texts are counted, without the values themselves. A filter of fixed size, made from the parts,
    keeps other words from being shuffled; the join afterwards is exact. Words have 3 to 24 letters: a part of a value
    that is longer is no word, and is made of shorter ones or guessed by brute force.
    """
    wanted = stored(_parts(values).select("word").distinct(), "value-parts")
    bits = _filter_of(wanted)

    def count(batches):
        """Words that may be wanted, once for each piece of text; and the number of all words, under the empty word."""
        for batch in batches:
            blanked = [CONTEXT.sub(lambda m: " " * 8, t) if t else "" for t in batch.column(0).to_pylist()]
            for _, _, data, offsets in pieces(pa.array(blanked, pa.large_string())):
                words = split(LOWER[data], offsets, ALPHANUMERIC)
                hashes = word_hashes(words)
                here = np.flatnonzero(membership(bits.value, hashes))
                _, some, number = np.unique(hashes[here], return_index=True, return_counts=True)
                names = [words.data[words.starts[i] : words.ends[i]].tobytes().decode("utf-8", "replace") for i in here[some]]
                yield pa.RecordBatch.from_arrays([pa.array([*names, ""]), pa.array([*number.tolist(), len(words)], pa.int64())], ["word", "n"])

    counts = stored(docs.select(text).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    total = counts.where("word = ''").select("n").first()
    total = max(1, total["n"] if total else 1)
    # A word seen once proves nothing: it may be a secret itself.
    return wanted.join(counts.where("n > 1"), "word").select("word", F.log10(F.greatest(F.lit(2.0), F.lit(float(total)) / F.col("n"))).alias("cost"))


def _costly(docs: DataFrame, text: str, found: DataFrame, threshold: float) -> DataFrame:
    """The distinct values (column `value`) that cost at least 10 ** threshold guesses, with `guesses`, that power.

    The parts of a value meet the words by its number, so that a long value is not copied for each of its parts; a
    filter of the words that were found leaves few parts to shuffle.
    """
    values = stored(found.select("value").distinct().withColumn("id", F.monotonically_increasing_id()), "values")
    words = stored(word_costs(docs, text, values), "value-words")

    @F.pandas_udf("double")
    def cost(value: pd.Series, names: pd.Series, costs: pd.Series) -> pd.Series:
        return pd.Series([guess_cost(v, dict(zip(n, c))) for v, n, c in zip(value, names, costs)], dtype="float64")

    known = (
        _parts(values, _filter_of(words)).distinct().join(words, "word")
        .groupBy("id").agg(F.collect_list(F.struct("word", "cost")).alias("words"))
    )
    empty = F.array().cast("array<struct<word:string,cost:double>>")
    return (
        values.join(known, "id", "left").withColumn("words", F.coalesce("words", empty))
        .select("value", cost("value", F.col("words.word"), F.col("words.cost")).alias("guesses"))
        .where(F.col("guesses") >= threshold)
    )


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, corpus: DataFrame | None = None) -> DataFrame:
    """For each row of `docs`: `key` and `spans`, an array of (start, kind, end, guesses) sorted by start, then kind.

    Kinds 0 to 2 are the fixed patterns, with null guesses; 3 is a value in a credential context that costs at
    least 10 ** `threshold` guesses. Offsets count code points, ends are exclusive. Null and empty texts have no
    spans. Repeated rows and rows with a null key each get a row of their own. Other columns are ignored. An empty table
    gives no rows. Values of any length are scanned whole; of segmentations that cost the same any counts. Words are
    counted in the column `text` of `corpus`, for `docs` that are a part of it; without one in `docs`.
    """
    rows = stored(_scan(docs, key, text).withColumn("row", F.monotonically_increasing_id()), "secret-scan")
    found = rows.select("row", F.explode("found").alias("f")).select("row", "f.*")
    costly = _costly(docs if corpus is None else corpus, text, found, threshold)
    extra = (
        found.join(costly, "value").groupBy("row")
        .agg(F.collect_list(F.struct("start", F.lit(3).alias("kind"), "end", "guesses")).alias("extra"))
    )
    plain = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.lit(None).cast("double").alias("guesses")))
    none = F.array().cast("array<struct<start:long,kind:int,end:long,guesses:double>>")
    return rows.join(extra, "row", "left").select(key, F.array_sort(F.concat(plain, F.coalesce("extra", none))).alias("spans"))


def _named(spans: Column | str) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kinds[s["kind"]], s["start"], s["end"])), ",")


def _count(kind: int) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def op4_guess_cost_secret_scan(spark, folder: str) -> DataFrame:
    """The secrets in every whole document."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    base = F.filter("spans", lambda s: s["kind"] < 3)
    number = [_count(kind).alias(f"n_{KINDS[kind]}") for kind in range(4)]
    return find_secrets(docs).select(
        "doc_id", *number, F.sha2(_named(base), 256).alias("base_sha256"), _named(F.col("spans")).alias("spans"),
    )
