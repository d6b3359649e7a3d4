"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1, made from its code point alone. A gram of three letters is
the product of their vectors, the first permuted (shifted) twice and the second once. The vectors of all
grams of a text are added up: its profile. The profiles of a language's texts add up to its prototype, and a
text gets the language whose prototype has the largest cosine with the text's profile.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyforge.llm.words import bounded_batches, pieces

DIMENSIONS = 1024
SEED = 20
UNDETERMINED = "und"
_GRAMS_AT_ONCE = 1 << 13
_CODE_POINTS = 0x110000


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point its lower-case letter, or 0 if it is no letter."""
    out = np.zeros(_CODE_POINTS, np.int32)
    for code in range(_CODE_POINTS):
        if chr(code).isalpha():
            out[code] = ord(chr(code).lower()[0])
    return out


@lru_cache(maxsize=4096)
def _letter_vector(code: int, dimensions: int) -> np.ndarray:
    return (np.random.default_rng([SEED, code]).integers(0, 2, dimensions) * 2 - 1).astype(np.int8)


def gram_vectors(grams: np.ndarray, dimensions: int) -> np.ndarray:
    """A vector for each row of three code points; 0 stands for 'no letter'."""
    letters, place = np.unique(grams, return_inverse=True)
    plain = np.stack([_letter_vector(int(c), dimensions) for c in letters])
    place = place.reshape(grams.shape)
    return np.roll(plain, 2, axis=1)[place[:, 0]] * np.roll(plain, 1, axis=1)[place[:, 1]] * plain[place[:, 2]]


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct grams around each letter of some texts; the gram of each letter; the first letter of each text."""
    codes = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), "<u4")
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    line = np.insert(_letters()[codes], chars, 0)  # texts don't touch
    at = np.flatnonzero(line)
    first = np.searchsorted(at, chars + np.arange(len(chars)))
    if not len(at):
        return np.zeros((0, 3), np.int64), at, first
    used = np.flatnonzero(np.bincount(line))
    place = np.zeros(used[-1] + 1, np.int64)
    place[used] = np.arange(len(used))
    line = place[line]
    key = (line[at - 1] * len(used) + line[at]) * len(used) + line[at + 1]
    if len(used) ** 3 <= 1 << 25:
        seen = np.zeros(len(used) ** 3, bool)
        seen[key] = True
        distinct = np.flatnonzero(seen)
        gram = (np.cumsum(seen) - 1)[key]
    else:
        distinct, gram = np.unique(key, return_inverse=True)
    digits = np.stack([distinct // len(used) ** 2, distinct // len(used) % len(used), distinct % len(used)], axis=1)
    return used[digits], gram, first


def _bundle(grams: np.ndarray, counts: np.ndarray, dimensions: int) -> np.ndarray:
    """The sum of the vectors of all grams, each as often as it is counted. `counts` can have a row for each of several bundles."""
    out = np.zeros((*counts.shape[:-1], dimensions))
    for at in range(0, len(grams), _GRAMS_AT_ONCE):
        part = slice(at, at + _GRAMS_AT_ONCE)
        out += counts[..., part].astype(np.float64) @ gram_vectors(grams[part], dimensions).astype(np.float64)
    return out


def profiles_of(data: np.ndarray, offsets: np.ndarray, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """The profile of each text, and its number of letters."""
    grams, gram, first = _grams(data, offsets)
    texts = len(offsets) - 1
    out = np.zeros((texts, dimensions), np.float32)
    known = gram_vectors(grams, dimensions).astype(np.float32) if 0 < len(grams) <= 4 * _GRAMS_AT_ONCE else None
    for i in range(texts):
        if first[i] < first[i + 1]:
            counts = np.bincount(gram[first[i] : first[i + 1]])
            present = np.flatnonzero(counts)
            if known is not None:
                out[i] = counts[present].astype(np.float32) @ known[present]
            else:
                out[i] = _bundle(grams[present], counts[present], dimensions)
    return out, np.diff(first)


def prototypes(docs: DataFrame, label: Column, text: str = "text", dimensions: int = DIMENSIONS) -> tuple[list[str], np.ndarray]:
    """The labels, sorted, and a prototype for each, from all rows with a label and a text.

    Sums of whole numbers, so the order of rows doesn't matter. What reaches the driver is one vector
    for each label, added up by Spark.
    """

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            labels = np.array(batch.column(0).to_pylist(), object)
            for a, b, data, offsets in pieces(batch.column(1)):
                grams, gram, first = _grams(data, offsets)
                owner = np.repeat(np.arange(a, b), np.diff(first))
                here = sorted(set(labels[a:b]))
                counts = np.stack([np.bincount(gram[labels[owner] == name], minlength=len(grams)) for name in here])
                for name, vector in zip(here, _bundle(grams, counts, dimensions)):
                    sums[name] = sums.get(name, 0) + np.rint(vector).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.int64()))], ["label", "vector"]
        )

    rows = (
        bounded_batches(docs).select(label.cast("string").alias("label"), text).where(f"label is not null and `{text}` is not null")
        .mapInArrow(run, "label string, vector array<long>")
        .select("label", F.posexplode("vector").alias("place", "value"))
        .groupBy("label", "place").agg(F.sum("value").alias("value"))
        .groupBy("label").agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("v"))
        .select("label", F.col("v.value").alias("v"))
        .orderBy("label").collect()
    )
    return [r.label for r in rows], np.array([r.v for r in rows], np.float64).reshape(len(rows), dimensions)


def identify(
    docs: DataFrame, labels: list[str], vectors: np.ndarray, text: str = "text", prediction: str = "lang_pred", score: str = "score"
) -> DataFrame:
    """`docs` with `prediction` and `score`, the cosine (0 if negative), judged by the text alone.

    A text that is null or has no letter gets `und` and 0, as does any text if there are no prototypes.
    Of equal cosines the first label in sorted order wins. Repeated rows get equal answers. Columns of `docs`
    with these two names are replaced. Very long texts are taken whole.
    """
    dimensions = vectors.shape[1]
    lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
    unit = (vectors / np.where(lengths == 0, 1, lengths)).astype(np.float32)
    kept = [c for c in docs.columns if c not in (prediction, score)]
    spot = kept.index(text)

    def run(batches):
        for batch in batches:
            names, scores = [], []
            for _, _, data, offsets in pieces(batch.column(spot)):
                made, letters = profiles_of(data, offsets, dimensions)
                norms = np.linalg.norm(made, axis=1)
                known = (letters > 0) & (norms > 0) & (len(labels) > 0)
                cosines = made @ unit.T / np.where(norms > 0, norms, 1)[:, None]
                best = cosines.argmax(axis=1) if labels else np.zeros(len(made), int)
                names += [labels[k] if ok else UNDETERMINED for k, ok in zip(best, known)]
                scores += [min(1.0, max(0.0, float(cosines[i, best[i]]))) if ok else 0.0 for i, ok in enumerate(known)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], schema.names)

    kind = T.StructType([*(docs.schema[c] for c in kept), T.StructField(prediction, T.StringType()), T.StructField(score, T.DoubleType())])
    schema = to_arrow_schema(kind)
    return bounded_batches(docs).select(*kept).mapInArrow(run, kind)


def remainder(key: str, parts: int) -> Column:
    """crc32 of the key as text, modulo `parts`; null for a null key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % parts


def learn(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """Prototypes from the labelled rows that aren't held out. A row with a null key isn't learned from."""
    return prototypes(docs.where(remainder(key, 4) != 2), F.col(lang), text)


def op1_hyperdimensional_language_id(spark, folder: str) -> DataFrame:
    """The language of every document, predicted from its text alone; a quarter of the ids is held out."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang")
    held = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    return identify(docs.select("doc_id", "text", held), *learn(docs)).select("doc_id", "held_out", "lang_pred", "score")
