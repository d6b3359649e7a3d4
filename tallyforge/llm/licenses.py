"""License scans: an exact set-similarity join of license templates with blocks of text.

Blocks are runs of consecutive words of a text that overlap by half. Their length follows the template: a template of up to
32 words meets blocks of 64, one of up to 64 words blocks of 128, and so on, so any stretch as long as the template lies in one. A block contains a template if it holds a share `containment` of the template's distinct words, at least
`need` of them. Words are ordered by how often the corpus holds them, rarest first. Then the first common word is
among the first `size - need + 1` words of the template (prefix); the block has to hold `need` template words
(length), and enough of them must be left after the first common one, on both sides (position). What passes is
compared in full.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyforge.llm.words import ALPHANUMERIC, LOWER, Words, bounded_batches, pieces, split, word_hashes
from tallyforge.session import stored

# Phrases that name a license, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Sentences that stand at the head of licensed work.
TEMPLATES = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "apache": "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "gpl": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "mpl": "This Source Code Form is subject to the terms of the Mozilla Public License",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "cc": "This work is licensed under a Creative Commons Attribution International License",
    "unlicense": "This is free and unencumbered software released into the public domain",
}
# The texts of licenses, and of notices that stand in each file of a work, without names and years.
TEXTS = {
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
        (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
        distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
        following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
        Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
        CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE
        OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that
        the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL
        WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE
        FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
        ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "bsd": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions
        are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
        Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
        documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
        AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
        PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
        EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS;
        OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
        OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "apache": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You
        may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,
        software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or
        implied. See the License for the specific language governing permissions and limitations under the License.""",
    "gpl": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published
        by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope
        that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See
        the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program.""",
    "zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any
        damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial
        applications, and to alter it and redistribute it freely, subject to the following restrictions: The origin of this software must not be
        misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product
        documentation would be appreciated but is not required. Altered source versions must be plainly marked as such, and must not be misrepresented as
        being the original software. This notice may not be removed or altered from any source distribution.""",
    "unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile,
        sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any
        means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the
        software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors.
        We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright
        law.""",
}
ALL_TEMPLATES = {label: [t[label] for t in (TEMPLATES, TEXTS) if label in t] for label in {**TEMPLATES, **TEXTS}}
#: Words of the shortest step from block to block; a block has twice as many.
STEP_WORDS = 32
CONTAINMENT = 0.8


def words_of(text: str) -> list[str]:
    """The words of a template or phrase."""
    data = np.frombuffer(text.encode(), np.uint8)
    found = split(LOWER[data], np.array([0, len(data)]), ALPHANUMERIC)
    return [found.data[s:e].tobytes().decode() for s, e in zip(found.starts, found.ends)]


class _Vocabulary:
    """Finds the words of a list in texts: the position in the list, or -1."""

    def __init__(self, words: list[str]):
        self.words = [w.encode() for w in words]
        data = np.frombuffer(b"".join(self.words), np.uint8)
        ends = np.cumsum([len(w) for w in self.words])
        own = Words(data, ends - [len(w) for w in self.words], ends, np.array([0, len(words)]))
        hashes = word_hashes(own)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]

    def find(self, words: Words) -> np.ndarray:
        hashes = word_hashes(words)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        out = np.where(self.hashes[at] == hashes, self.order[at], -1)
        for i in np.flatnonzero(out >= 0):  # a hash alone proves nothing
            if words.data[words.starts[i] : words.ends[i]].tobytes() != self.words[out[i]]:
                out[i] = -1
        return out


def token_order(docs: DataFrame, text: str, words: list[str]) -> list[str]:
    """The words, rarest in all whole texts first; equal counts in alphabetical order. One row per word reaches the driver."""

    def run(batches):
        vocabulary = _Vocabulary(words)
        total = np.zeros(len(words), np.int64)
        for batch in batches:
            for _, _, data, offsets in pieces(batch.column(0)):
                hashes = word_hashes(split(LOWER[data], offsets, ALPHANUMERIC))
                at = np.minimum(np.searchsorted(vocabulary.hashes, hashes), len(words) - 1)
                total += np.bincount(vocabulary.order[at[vocabulary.hashes[at] == hashes]], minlength=len(words))
        yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(total)], ["word", "n"])

    counts = {r.word: r.n for r in docs.select(text).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()}
    return sorted(words, key=lambda w: (counts.get(w, 0), w))


def step_of(words: int) -> int:
    """The step from block to block for a template of so many words: a power of two that isn't smaller."""
    return max(STEP_WORDS, 1 << (words - 1).bit_length())


def template_prefixes(
    spark: SparkSession, templates: dict[str, list[str]], order: list[str], containment: float
) -> tuple[DataFrame, dict[int, set[int]]]:
    """`token`, `step`, `place`, `label`, `tokens`, `need` for each prefix token of each template; and the prefix tokens of each step."""
    rank = {w: i for i, w in enumerate(order)}
    rows, prefixes = [], {}
    for label, texts in templates.items():
        for text in texts:
            words = words_of(text)
            tokens, step = sorted({rank[w] for w in words}), step_of(len(words))
            need = max(1, math.ceil(containment * len(tokens)))
            rows += [(tokens[i], step, i, label, tokens, need) for i in range(len(tokens) - need + 1)]
            prefixes.setdefault(step, set()).update(tokens[: len(tokens) - need + 1])
    schema = "token int, step int, place int, label string, tokens array<int>, need int"
    return spark.createDataFrame(rows, schema), prefixes


def _scan(docs: DataFrame, key: str, text: str, phrases: dict[str, str], order: list[str], prefixes: dict[int, set[int]]) -> DataFrame:
    """`key`, `n_words`, `base` (label and first word of each place of a phrase) and `blocks`, step and template words of each block with a prefix token."""
    kind = docs.schema[key].dataType.simpleString()
    base_type = pa.struct([("label", pa.string()), ("at", pa.int64())])
    block_type = pa.struct([("step", pa.int32()), ("tokens", pa.list_(pa.int32()))])
    parts = {phrase: words_of(phrase) for phrase in phrases}
    wanted = [*order, *sorted({w for p in parts.values() for w in p} - set(order))]
    place = {w: i for i, w in enumerate(wanted)}

    def run(batches):
        vocabulary = _Vocabulary(wanted)
        in_prefix = {step: np.isin(np.arange(len(wanted) + 1), list(prefix)) for step, prefix in prefixes.items()}
        for batch in batches:
            number, base, blocks = [], [], []
            for _, _, data, offsets in pieces(batch.column(1)):
                words = split(LOWER[data], offsets, ALPHANUMERIC)
                token = vocabulary.find(words)
                owner = words.text_of()
                counts = words.counts()
                number += counts.tolist()
                base_here: list[list] = [[] for _ in counts]
                blocks_here: list[list] = [[] for _ in counts]
                for phrase, spelled in parts.items():
                    last = len(token) - len(spelled) + 1
                    if last <= 0:
                        continue
                    same = owner[:last] == owner[len(spelled) - 1 :]
                    for i, w in enumerate(spelled):
                        same &= token[i : i + last] == place[w]
                    for at in np.flatnonzero(same):
                        base_here[owner[at]].append({"label": phrases[phrase], "at": int(at - words.first[owner[at]])})
                for step, inside in in_prefix.items():
                    hits = np.flatnonzero(inside[token])
                    of = owner[hits]
                    within = hits - words.first[of]
                    last_block = np.maximum(0, -(-(counts[of] - 2 * step) // step))
                    for back in (0, 1):
                        block = within // step - back
                        ok = (block >= 0) & (block <= last_block)
                        for t, b in set(zip(of[ok].tolist(), block[ok].tolist())):
                            first = int(words.first[t]) + b * step
                            found = np.unique(token[first : min(first + 2 * step, int(words.first[t + 1]))])
                            blocks_here[t].append({"step": step, "tokens": found[(found >= 0) & (found < len(order))].tolist()})
                base += base_here
                blocks += blocks_here
            columns = [batch.column(0), pa.array(number, pa.int64()), pa.array(base, pa.list_(base_type)), pa.array(blocks, pa.list_(block_type))]
            yield pa.RecordBatch.from_arrays(columns, [key, "n_words", "base", "blocks"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_words long, base array<struct<label:string,at:long>>, blocks array<struct<step:int,tokens:array<int>>>")


def find_licenses(
    docs: DataFrame, key: str = "doc_id", text: str = "text", phrases: dict[str, str] = PHRASES,
    templates: dict[str, list[str]] = ALL_TEMPLATES,
    containment: float = CONTAINMENT,
) -> DataFrame:
    """For each row of `docs`: `key`, `n_words`, `base` (places of phrases: label, first word) and `matches` (label, containment), each array sorted.

    `templates` maps labels to texts of any length, `phrases` phrases to labels; both are small constants of the
    program. A label's containment is the largest of its texts. Lower-cases A-Z; words are runs of letters, digits and everything beyond ASCII. Null and empty texts have no words.
    Repeated rows and null keys get a row each; other columns are ignored. Whole texts are scanned. Words that the corpus holds
    equally often are ordered by the alphabet, which changes no result. An empty table gives no rows.
    """
    if not all(words_of(t) for texts in templates.values() for t in texts):
        raise ValueError("a template has at least one word")
    order = token_order(bounded_batches(docs), text, sorted({w for texts in templates.values() for t in texts for w in words_of(t)}))
    prefixes, by_step = template_prefixes(docs.sparkSession, templates, order, containment)
    scan = _scan(docs, key, text, phrases, order, by_step).withColumn("row", F.monotonically_increasing_id())
    rows = stored(scan, "license-scan")
    blocks = rows.select("row", F.explode("blocks").alias("b")).distinct().select("row", "b.step", F.col("b.tokens").alias("block"))
    blocks = blocks.select("row", "step", "block", F.posexplode("block").alias("at", "token"))
    left = F.least(F.size("tokens") - F.col("place"), F.size("block") - F.col("at"))
    matches = (
        blocks.join(prefixes, ["token", "step"])
        .where((F.size("block") >= F.col("need")) & (left >= F.col("need")))  # length and position
        .withColumn("common", F.size(F.array_intersect("block", "tokens")))
        .where("common >= need")
        .groupBy("row", "label").agg(F.max(F.col("common") / F.size("tokens")).alias("containment"))
        .groupBy("row").agg(F.array_sort(F.collect_list(F.struct("label", "containment"))).alias("matches"))
    )
    none = F.array().cast("array<struct<label:string,containment:double>>")
    return rows.join(matches, "row", "left").select(key, "n_words", F.array_sort("base").alias("base"), F.coalesce("matches", none).alias("matches"))


def op9_prefix_filtered_license_scan(spark, folder: str) -> DataFrame:
    """The licenses that every whole document names or quotes. The score is 1 for a phrase, else the largest containment."""
    base = F.transform("base", lambda b: b["label"])
    quoted = F.transform("matches", lambda m: m["label"])
    at = F.transform("base", lambda b: b["at"])
    share = F.array_max(F.transform("matches", lambda m: m["containment"]))
    return find_licenses(spark.read.parquet(f"{folder}/documents.parquet")).select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(at).alias("first_word"), F.array_max(at).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base, quoted))), ",").alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce(share, F.lit(0.0))).alias("score"),
    )
