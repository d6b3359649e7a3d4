"""Bloom filters of a fixed size: what may be broadcast however large the set is.

A filter only spares work: what passes it is joined with the real set afterwards.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyforge.llm.words import filter_places

FILTER_BITS = 1 << 22  # 512 KB


def build(df: DataFrame, column: str, bits: int = FILTER_BITS) -> np.ndarray:
    """The filter of a column of 64-bit hashes. At most `bits / 64` rows reach the driver, however many hashes there are."""

    def places(batches):
        for batch in batches:
            hashes = batch.column(0).drop_null().to_numpy(zero_copy_only=False).view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(filter_places(hashes, bits), pa.int64())], ["place"])

    words = (
        df.select(F.col(column).cast("long"))
        .mapInArrow(places, "place long")
        .groupBy(F.shiftright("place", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("value"))
        .toArrow()
    )
    out = np.zeros(bits // 64, np.uint64)
    out[words["word"].to_numpy()] = words["value"].to_numpy().view(np.uint64)
    return out
