"""A Bloom filter over any number of keys, of bounded size.

It tells a scan which rows may matter, so that the others are not shuffled; what
it lets through by chance is compared like everything else. With many more keys
than the largest has room for it lets everything through: costs grow, results
don't change.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labeltext.llm.textvec import mix

#: Bits a key, and bits in all: 32 MB, enough for some forty million keys.
KEY_BITS, MOST_BITS = 16, 1 << 28


def _slots(keys: np.ndarray, size: int) -> np.ndarray:
    return np.stack([mix(keys + np.uint64(i)) & np.uint64(size - 1) for i in (11, 12, 13)])


def member(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    slots = _slots(keys, 8 * len(bits))
    return ((bits[(slots >> np.uint64(3)).astype(np.int64)] >> (slots & np.uint64(7)).astype(np.uint8)) & 1).all(0)


def key_filter(keys: DataFrame) -> np.ndarray:
    """A Bloom filter of the longs in column ``key``: MOST_BITS at most, whatever comes in.

    ``keys`` is read twice, so it should be a written table.
    """
    size = min(MOST_BITS, max(1 << 10, 1 << (KEY_BITS * keys.count()).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = np.unique(_slots(batch.column(0).to_numpy().view(np.uint64), size))
            place = (slots >> np.uint64(6)).astype(np.int64)
            value = np.uint64(1) << (slots & np.uint64(63))
            head = np.flatnonzero(np.r_[True, place[1:] != place[:-1]]) if len(place) else place
            if len(place):
                word = np.bitwise_or.reduceat(value, head)
                yield pa.RecordBatch.from_arrays([pa.array(place[head]), pa.array(word.view(np.int64))], ["place", "bits"])

    table = keys.select("key").mapInArrow(run, "place bigint, bits bigint").groupBy("place").agg(
        F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(size // 64, np.int64)
    out[table.column("place").to_numpy()] = table.column("bits").to_numpy()
    return out.view(np.uint8)


def rows_in(df: DataFrame, key: Column | str, bits: np.ndarray, inside: bool = True) -> DataFrame:
    """The rows of ``df`` whose long ``key`` is in the filter, and few others.

    With ``inside`` false: the rows left, those with a null key among them. Only keys go
    through Python; the rows stay where they are.
    """

    def found(keys: pa.Array) -> pa.Array:
        hit = member(bits, keys.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64))
        return pa.array(hit & keys.is_valid().to_numpy(zero_copy_only=False))

    hit = F.arrow_udf(found, "boolean")(key)
    return df.where(hit if inside else ~hit)
