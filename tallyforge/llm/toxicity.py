"""Toxicity by multiple-instance learning: sentences get scores, but only documents have labels.

The features of a sentence are its words and their first 3 to 8 bytes. A sentence is offending with the logistic function of its
features' weights, and a document is toxic with the noisy-or of its sentences and a leak, 1 - (1 - leak) * product(1 - p), which
is what the labels train. The leak takes labels that no sentence explains; the logarithm of the number of sentences
is a feature of each sentence, so that a long document needs more evidence. Trained weights then locate sentences.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyforge.llm.language import remainder
from tallyforge.llm.words import ALPHANUMERIC, LOWER, Words, bounded_batches, mixed, pieces, split, word_hashes
from tallyforge.session import stored

#: The model is fitted on at most so many documents of either label, chosen by the hash of their ids, of at most so many characters.
TRAINING_DOCUMENTS, TRAINING_CHARACTERS = 5_000, 20_000
#: Features with a weight: those that tell the labels apart best, each in at least so many toxic documents.
FEATURES, LEAST_DOCUMENTS = 2_048, 3
PREFIXES = (3, 4, 5, 6, 7, 8)
#: Documents and sentences from this score on are named toxic.
THRESHOLD = 0.3
_STEPS, _RATE, _DECAY = 400, 0.05, 2e-4
_ODD = np.uint64(0x9E3779B97F4A7C15)
_ENDS = np.isin(np.arange(256), [ord(c) for c in ".!?\n\r"])


def lowered(data: np.ndarray) -> np.ndarray:
    """Upper-case letters of ASCII and Latin-1 as lower-case ones of the same length."""
    out = LOWER[data]
    second = np.zeros(len(data), bool)
    second[1:] = data[:-1] == 0xC3
    out[second & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)] += 32
    return out


@dataclass
class Sentences:
    """Sentences that have a word, in order: the text each is of, its first and last byte, and the sentence of each word."""

    words: Words
    of_word: np.ndarray
    text: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def sentences(data: np.ndarray, offsets: np.ndarray) -> Sentences:
    """Sentences end at full stops, exclamation and question marks, line ends, and with the text."""
    words = split(lowered(data), offsets, ALPHANUMERIC)
    text = words.text_of()
    number = np.concatenate([[0], np.cumsum(_ENDS[data])])[words.starts] + text
    heads = np.flatnonzero(np.diff(number, prepend=-1))
    of_word = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(words))))
    last = np.append(heads[1:], len(words)) - 1 if len(heads) else heads
    return Sentences(words, of_word, text[heads], words.starts[heads], words.ends[last])


def features(words: Words):
    """For each kind of feature the words that have it, and its hash for each of these."""
    yield np.arange(len(words)), mixed(word_hashes(words, seed=9))
    lanes = np.ndarray((len(words.data) + 1,), np.dtype("<u8"), np.concatenate([words.data, np.zeros(8, np.uint8)]), strides=(1,))
    lane, length = lanes[words.starts], words.ends - words.starts
    for size in PREFIXES:
        mine = np.flatnonzero(length >= size)
        yield mine, mixed((lane[mine] & np.uint64((1 << 8 * size) - 1)) * _ODD + np.uint64(size))


def _sentence_features(found: Sentences, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of a sentence and a place in `known`, the sorted hashes of the features that count."""
    pairs = [np.empty(0, np.int64)]
    if len(known):
        for word, keys in features(found.words):
            at = np.searchsorted(known, keys)
            has = np.flatnonzero(known[np.minimum(at, len(known) - 1)] == keys)
            pairs.append(found.of_word[word[has]] * len(known) + at[has])
    both = np.unique(np.concatenate(pairs))
    return both // max(1, len(known)), both % max(1, len(known))


def _softplus(x):
    return np.logaddexp(0, x)


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class Model:
    """Hashes of the features, sorted, their weights, what every sentence has, the weight of the log of their number, and the leak's logit."""

    keys: np.ndarray
    weights: np.ndarray
    base: float
    length: float
    leak: float

    def judge(self, found: Sentences, texts: int) -> tuple[np.ndarray, np.ndarray]:
        """The score of each text, and of each sentence."""
        sentence, feature = _sentence_features(found, self.keys)
        count = np.bincount(found.text, minlength=texts)
        logits = self.base + self.length * np.log(np.maximum(count, 1))[found.text]
        logits += np.bincount(sentence, self.weights[feature], minlength=len(found.text))
        total = _softplus(self.leak) + np.bincount(found.text, _softplus(logits), minlength=texts)
        return -np.expm1(-total), _sigmoid(logits)


def _without_evidence(share: float) -> Model:
    """Gives every text the same score."""
    leak = -np.inf if share <= 0 else 700.0 if share >= 1 else float(np.log(share / (1 - share)))
    return Model(np.empty(0, np.uint64), np.empty(0), -np.inf, 0.0, leak)


def fit(toxic: np.ndarray, weight: np.ndarray, count: np.ndarray, doc: np.ndarray, sentence: np.ndarray, feature: np.ndarray, keys: np.ndarray) -> Model:
    """Weights that make the noisy-or of the documents' sentences agree with their labels, by gradient steps over all of them.

    `count` has the sentences of each document; `doc`, `sentence` and `feature` are distinct triples, sentences numbered within a document.
    """
    span = int(sentence.max(initial=0)) + 1
    named, at = np.unique(doc * span + sentence, return_inverse=True)
    of = named // span  # the document of each sentence that has features
    rest = count - np.bincount(of, minlength=len(toxic))
    long = np.log(np.maximum(count, 1))
    weight = weight / weight.sum()
    k = len(keys)
    x = np.concatenate([np.zeros(k), [-6.0, 0.0, -4.0]])
    mean, square = np.zeros_like(x), np.zeros_like(x)
    for step in range(1, _STEPS + 1):
        base = x[k] + x[k + 1] * long
        logits = base[of] + np.bincount(at, x[feature], minlength=len(of))
        total = _softplus(x[k + 2]) + np.bincount(of, _softplus(logits), minlength=len(toxic)) + rest * _softplus(base)
        left = np.exp(-total)
        slope = weight * np.where(toxic, -left / np.maximum(1 - left, 1e-12), 1.0)
        by_sentence = slope[of] * _sigmoid(logits)
        by_document = np.bincount(of, by_sentence, minlength=len(toxic)) + slope * rest * _sigmoid(base)
        gradient = np.concatenate([
            np.bincount(feature, by_sentence[at], minlength=k) + _DECAY * x[:k],
            [by_document.sum(), (by_document * long).sum(), slope.sum() * _sigmoid(x[k + 2])],
        ])
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        x = x - _RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
    return Model(keys, x[:k], float(x[k]), float(x[k + 1]), float(x[k + 2]))


def _sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, size: int) -> DataFrame:
    """`toxic`, `share` (documents with this label for each one taken) and `text`: at most `size` documents of either label."""
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("id")).agg((F.max(label) > 0).alias("toxic"))
    parts = []
    for toxic in (True, False):
        mine = known.where(F.col("toxic") == toxic)
        taken = mine.orderBy(F.xxhash64("id"), "id").limit(size).withColumn("share", F.lit(1.0))
        # A figure for each class: how many stand for one that is taken.
        number = mine.agg(F.greatest(F.lit(1.0), F.count("*") / F.lit(float(size))).alias("many"))
        parts.append((taken, number.first()["many"]))
    ids = parts[0][0].withColumn("share", F.lit(parts[0][1])).unionByName(parts[1][0].withColumn("share", F.lit(parts[1][1])))
    rows = docs.where(F.length(text) <= TRAINING_CHARACTERS).select(F.col(key).alias("id"), F.col(text).alias("text"))
    # At most twice `size` short rows are broadcast. Of rows that share an id one is taken.
    held = rows.join(F.broadcast(ids), "id").groupBy("id", "toxic", "share").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return held.select("toxic", "share", "text")


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", size: int = TRAINING_DOCUMENTS) -> Model:
    """A model from the documents that have a label. Rows with a null key, label or text aren't learned from.

    If a document has several labels, it is toxic if one says so. Without documents of both labels every text gets the same score.
    Features are chosen by Spark; what reaches the driver is bounded by the sample.
    """
    sample = stored(bounded_batches(_sample(docs, labels, key, text, label, size)), "toxicity-sample")

    def count(batches):
        for batch in batches:
            toxic = batch.column(0).to_numpy(zero_copy_only=False)
            for first, last, data, offsets in pieces(batch.column(2)):
                found = sentences(data, offsets)
                made = list(features(found.words))
                keys = np.concatenate([key for _, key in made])
                doc = np.concatenate([found.text[found.of_word[word]] for word, _ in made])
                order = np.lexsort((doc, keys))
                keys, doc = keys[order], doc[order]
                new = np.ones(len(keys), bool)
                new[1:] = (np.diff(keys) != 0) | (np.diff(doc) != 0)
                keys, doc = keys[new], doc[new]
                heads = np.flatnonzero(np.diff(keys, prepend=~keys[:1]))
                number = np.diff(np.append(heads, len(keys)))
                bad = np.add.reduceat(toxic[first:last][doc].astype(np.int64), heads) if len(heads) else number
                yield pa.RecordBatch.from_arrays([pa.array(keys[heads].view(np.int64)), pa.array(bad), pa.array(number - bad)], ["key", "bad", "good"])

    sizes = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    bad, good = sizes.get(True, 0), sizes.get(False, 0)
    if not bad or not good:
        return _without_evidence(bad / max(1, bad + good))
    counted = sample.mapInArrow(count, "key long, bad long, good long").groupBy("key").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    b, g = F.col("bad"), F.col("good")
    share = (b + g) / F.lit(float(bad + good))
    gain = sum(part(s, e) for s, e in (
        (b, share * bad), (g, share * good), (F.lit(bad) - b, (1 - share) * bad), (F.lit(good) - g, (1 - share) * good),
    ))
    chosen = counted.where((b >= LEAST_DOCUMENTS) & (b * good > g * bad)).orderBy(F.desc(gain), "key").limit(FEATURES).select("key").collect()
    keys = np.sort(np.array([r.key for r in chosen], np.int64).view(np.uint64))

    def describe(batches):
        for batch in batches:
            for first, last, data, offsets in pieces(batch.column(2)):
                found = sentences(data, offsets)
                sentence, feature = _sentence_features(found, keys)
                head = np.searchsorted(found.text, np.arange(last - first))
                doc = found.text[sentence]
                cuts = np.searchsorted(doc, np.arange(last - first + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(cuts, pa.array(x.astype(np.int32))) for x in (sentence - head[doc], feature)]
                number = pa.array(np.bincount(found.text, minlength=last - first))
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(first, last - first) for i in (0, 1)), number, *lists], ["toxic", "share", "sentences", "sentence", "feature"])

    rows = sample.mapInArrow(describe, "toxic boolean, share double, sentences long, sentence array<int>, feature array<int>").toArrow().combine_chunks()
    toxic, weight, number = (rows.column(i).to_numpy(zero_copy_only=False) for i in range(3))
    lists = [rows.column(i).combine_chunks() for i in (3, 4)]
    doc = np.repeat(np.arange(len(number)), np.diff(lists[0].offsets.to_numpy()))
    sentence, feature = (x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in lists)
    return fit(toxic.astype(bool), weight, number, doc, sentence, feature, keys)


def judge(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """`key`, `score`, `sentences` (how many) and `offending`, for every row of `docs`, from the text alone.

    `offending` lists the sentences with a score of at least `threshold`: start, end (code points, end exclusive) and score, in order.
    A text that is null, empty or has no word has the score of the leak alone. Texts are taken whole, equal texts get equal
    answers, other columns are ignored, an empty table gives no rows.
    """
    kind = docs.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)
    entry = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    def run(batches):
        for batch in batches:
            for first, last, data, offsets in pieces(batch.column(1)):
                found = sentences(data, offsets)
                scores, each = shared.value.judge(found, last - first)
                named = np.flatnonzero(each >= threshold)
                points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                base = points[offsets[found.text[named]]]
                spans = pa.StructArray.from_arrays(
                    [pa.array(points[found.starts[named]] - base), pa.array(points[found.ends[named]] - base), pa.array(each[named])], fields=list(entry)
                )
                cuts = np.searchsorted(found.text[named], np.arange(last - first + 1)).astype(np.int32)
                number = np.bincount(found.text, minlength=last - first)
                columns = [batch.column(0).slice(first, last - first), pa.array(scores), pa.array(number), pa.ListArray.from_arrays(cuts, spans)]
                yield pa.RecordBatch.from_arrays(columns, ["key", "score", "sentences", "offending"])

    rows = bounded_batches(docs).select(F.col(key).alias("key"), text)
    out = rows.mapInArrow(run, f"key {kind}, score double, sentences long, offending array<struct<start:long,end:long,score:double>>")
    return out.withColumnRenamed("key", key)


def op13_multiple_instance_toxicity(spark, folder: str) -> DataFrame:
    """The toxicity of every document, learned from the labels of three quarters of the ids, with its offending sentences."""
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    model = learn(docs.where(remainder("doc_id", 4) != 2), labels.where(remainder("doc_id", 4) != 2))
    held = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    return judge(docs, model).select("doc_id", held, "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "sentences", "offending")
