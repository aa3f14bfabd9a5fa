"""Blocks: bounded runs of documents that share one local dictionary.

Counting jobs that need a global fact of every word of every document keep the words of a block once,
in its dictionary, and the documents as numbers into it. Only dictionaries meet in joins, so a
word that all documents hold is one row per block there. Numbers are stored as compressed byte planes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Numbers(dict):
    """Numbers words in the order in which they are first asked for, from ``first``."""

    def __init__(self, first: int = 0):
        super().__init__()
        self.first = first

    def __missing__(self, word):
        number = self[word] = len(self) + self.first
        return number


def pack(values: np.ndarray) -> bytes:
    """Unsigned numbers (little-endian, any width) as compressed byte planes, lowest byte first."""
    values = np.ascontiguousarray(values)
    planes = values.view(np.uint8).reshape(-1, values.itemsize).T
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes, n: int, dtype: str = "<u4") -> np.ndarray:
    width = np.dtype(dtype).itemsize
    plain = pa.decompress(data, decompressed_size=width * n, codec="zstd", asbytes=True)
    return np.frombuffer(plain, np.uint8).reshape(width, n).T.copy().view(dtype).reshape(n)


#: Bits of an answer, beside which the place in the dictionary stands in one long.
_BITS = 40
#: Words that a block's dictionary may hold.
LONGEST_DICTIONARY = 1 << (63 - _BITS)


def returned(blocks: DataFrame, answers: DataFrame, value: str) -> DataFrame:
    """``blocks`` with ``answers``, for :func:`told`: those of (block, at, ``value``) that are not null.

    A block's answer is as long as its dictionary at most. Values are below 2 ** 40.
    """
    one = F.shiftleft(F.col("at").cast("long"), _BITS) + F.col(value)
    found = answers.groupBy("block").agg(F.collect_list(one).alias("answers"))
    return blocks.join(found, "block", "left")


def told(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in the dictionary of a block, and the answers for them."""
    answers = batch.column("answers")[i]
    found = answers.values.to_numpy(zero_copy_only=False) if answers.is_valid else np.zeros(0, np.int64)
    return found >> _BITS, found & ((1 << _BITS) - 1)
