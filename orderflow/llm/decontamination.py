"""Benchmark decontamination by SimHash windows, multi-index Hamming blocks and exact similarity.

A benchmark item of m words is looked for in every window of m consecutive words of every
document; a document of fewer words is one window, compared exactly. Words are in lower case, parted by white space and punctuation. A text's shingles are its
runs of five words, counted; a text of fewer words is one shingle. An item is found in a
window if the weighted Jaccard similarity of their counted shingles (sum of smaller counts over sum
of larger counts) is 0.8 or more.

1. A window that shares no shingle with any item of its size has similarity 0 with all of them, so
   only windows with such a shingle in them are fingerprinted: nothing is lost by that.
2. The 128-bit SimHash of a window is the sign of the summed +-1 bits of its counted shingles. All
   windows of one size are summed as differences of running totals.
3. A fingerprint is cut into 16 blocks of 8 bits. Two fingerprints within ``radius`` 31 agree in some
   block but for at most one bit (31 // 16 = 1), and each item is filed under all block values
   that near: so every item within the radius is found, and its full distance is then checked.
4. The candidates' similarity is computed exactly from the counted shingles.

At similarity 0.8 the expected distance is 19.4 bits with a deviation of 4.1, so the radius loses
about 2 pairs in 1,000 just at the threshold and far fewer above it.

The benchmark is a query set. It goes to the tasks in blocks of at most about ``block_words`` words;
a larger benchmark takes more passes over the documents, never more memory. Which block an item
is in follows from the hash of its text. Documents stream through batch by batch; memory is bounded
by one document.

Defined results: null and empty texts match nothing, on either side; items of equal text are found
together; repeated documents are searched each; empty tables give empty results; other columns are
not looked at. A text of any length is searched whole.
"""

from __future__ import annotations

import hashlib
import string
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import packed, stored, text_of

SHINGLE = 5
BITS, BLOCK_BITS = 128, 8
RADIUS = 31
SIMILARITY = 0.8
BLOCK_WORDS = 500_000
#: ASCII punctuation and common other marks; each parts words like a space.
PUNCTUATION = string.punctuation + "\u2018\u2019\u201c\u201d\u00ab\u00bb\u2013\u2014\u2026\u00a1\u00bf"
_MIX = np.uint64(0x9E3779B97F4A7C15)

MATCHES = "item_id long, start_word long, n_words long, similarity double"


def words(text: str | None) -> list[str]:
    if not text:
        return []
    text = text.lower()
    for mark in PUNCTUATION:
        if mark in text:
            text = text.replace(mark, " ")
    return text.split()


def shingle_ids(ids: np.ndarray, size: int, starts: np.ndarray | None = None) -> np.ndarray:
    """A number for each run of ``size`` word numbers, or for those at ``starts`` only."""
    n = max(len(ids) - size + 1, 0)
    out = np.zeros(n if starts is None else len(starts), np.uint64)
    for k in range(size):
        out = (out ^ (ids[k : k + n] if starts is None else ids[starts + k])) * _MIX
        out ^= out >> np.uint64(29)
    return out


def shingle_bits(shingles: np.ndarray) -> np.ndarray:
    """128 random bits for each shingle number, as 0 and 1."""
    halves = []
    for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
        x = shingles ^ np.uint64(salt)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        halves.append(x ^ (x >> np.uint64(31)))
    joined = np.stack(halves, axis=1).view(np.uint8)
    return np.unpackbits(joined, axis=1)


def similarity(one: Counter, other: Counter) -> float:
    smaller = sum((one & other).values())
    larger = sum(one.values()) + sum(other.values()) - smaller
    return smaller / larger if larger else 0.0


class Index:
    """The fingerprints and counted shingles of one block of benchmark items."""

    def __init__(self, items: list[tuple[int, str]], radius: int = RADIUS):
        self.radius = radius
        self.vocabulary: dict[str, int] = {}
        by_text: dict[tuple[str, ...], list[int]] = {}
        for item_id, text in items:
            if found := words(text):
                by_text.setdefault(tuple(found), []).append(item_id)
        self.items = [(w, sorted(ids)) for w, ids in sorted(by_text.items())]
        for item, _ in self.items:
            for word in item:
                if word not in self.vocabulary:
                    digest = hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8)
                    # 0 stands for words of no item.
                    self.vocabulary[word] = int.from_bytes(digest.digest(), "little") or 1
        self.groups = []
        by_size: dict[int, list[int]] = {}
        for place, (item, _) in enumerate(self.items):
            by_size.setdefault(len(item), []).append(place)
        for m, places in sorted(by_size.items()):
            size = min(SHINGLE, m)
            counted, prints = [], []
            for place in places:
                ids = np.array([self.vocabulary[w] for w in self.items[place][0]], np.uint64)
                shingles = shingle_ids(ids, size)
                counted.append(Counter(shingles.tolist()))
                ones = shingle_bits(shingles).sum(axis=0, dtype=np.int64)
                prints.append(np.packbits(2 * ones > len(shingles)))
            self.groups.append((m, size, places, counted, np.array(prints), self._filed(prints)))
        #: By shingle size: the groups that have a shingle.
        self.owners: dict[int, dict[int, list[int]]] = {}
        for place, (_, size, _, counted, _, _) in enumerate(self.groups):
            owners = self.owners.setdefault(size, {})
            for shingle in {k for c in counted for k in c}:
                owners.setdefault(shingle, []).append(place)
        self.anchors = {s: np.array(sorted(o), np.uint64) for s, o in self.owners.items()}

    def _filed(self, prints: list[np.ndarray]) -> list[list[list[int]]]:
        """For each block and each of its values: the items filed there."""
        blocks = BITS // BLOCK_BITS
        near = self.radius // blocks
        values = np.arange(1 << BLOCK_BITS)
        ones = np.array([bin(v).count("1") for v in values])
        return [
            [np.flatnonzero([ones[v ^ int(p[b])] <= near for p in prints]).tolist() for v in values]
            for b in range(blocks)
        ]

    def find(self, text: str | None) -> Iterator[tuple[int, int, int, float]]:
        """(item, first word, words, similarity) of the best window of each item that is found."""
        spoken = words(text)
        known = np.fromiter(map(self.vocabulary.get, spoken, repeat(0)), np.uint64, len(spoken))
        for size, owners in self.owners.items():
            n = len(known) - size + 1
            if n < 1:
                continue
            complete = known[:n] != 0
            for k in range(1, size):
                complete &= known[k : k + n] != 0
            starts = np.flatnonzero(complete)
            if not len(starts):
                continue
            anchors, own = self.anchors[size], shingle_ids(known, size, starts)
            found = anchors[np.minimum(np.searchsorted(anchors, own), len(anchors) - 1)] == own
            hits: dict[int, list[int]] = {}
            for start, shingle in zip(starts[found].tolist(), own[found].tolist(), strict=True):
                for place in owners[shingle]:
                    hits.setdefault(place, []).append(start)
            shingles = shingle_ids(known, size) if hits else own
            for place in sorted(hits):
                if self.groups[place][0] > len(known):
                    yield from self._whole(place, shingles, len(known))
                else:
                    yield from self._search(place, np.array(hits[place]), shingles, len(known))

    def _search(self, place: int, hits: np.ndarray, shingles: np.ndarray, n_words: int) -> Iterator:
        m, size, places, counted, prints, filed = self.groups[place]
        width = m - size + 1
        best: dict[int, tuple[float, int]] = {}
        for first, last in self._spans(hits, m - size, n_words - m):
            for offset, near in self._near(shingles[first : last + width], width, prints, filed):
                start = first + offset
                window = Counter(shingles[start : start + width].tolist())
                for j in near:
                    score = similarity(window, counted[j])
                    if score >= SIMILARITY and score > best.get(j, (0.0, 0))[0]:
                        best[j] = score, start
        for j, (score, start) in sorted(best.items()):
            for item_id in self.items[places[j]][1]:
                yield item_id, start, m, score

    def _whole(self, place: int, shingles: np.ndarray, n_words: int) -> Iterator:
        """Items of more words than the text, which is the one window."""
        m, size, places, counted, _, _ = self.groups[place]
        # Of so few shingles no more than all can be shared.
        if len(shingles) / (m - size + 1) < SIMILARITY:
            return
        window = Counter(shingles.tolist())
        for j, item in enumerate(counted):
            if (score := similarity(window, item)) >= SIMILARITY:
                for item_id in self.items[places[j]][1]:
                    yield item_id, 0, n_words, score

    @staticmethod
    def _spans(hits: np.ndarray, reach: int, last: int) -> Iterator[tuple[int, int]]:
        """Runs of window starts whose windows hold a hit: joined, cut to the text."""
        breaks = np.flatnonzero(np.diff(hits) > reach + 1)
        for a, b in zip(np.r_[0, breaks + 1], np.r_[breaks, len(hits) - 1], strict=True):
            first, end = max(0, int(hits[a]) - reach), min(int(hits[b]), last)
            if first <= end:
                yield first, end

    def _near(self, shingles: np.ndarray, width: int, prints: np.ndarray, filed: list) -> Iterator:
        """(window, items within the radius) of each window of ``width`` shingles, in bounded pieces."""
        for piece in range(0, len(shingles) - width + 1, 4096):
            own = shingles[piece : piece + 4096 + width - 1]
            totals = np.zeros((len(own) + 1, BITS), np.int64)
            np.cumsum(shingle_bits(own), axis=0, dtype=np.int64, out=totals[1:])
            found = np.packbits(2 * (totals[width:] - totals[:-width]) > width, axis=1)
            for at, mark in enumerate(found):
                near = {j for b, value in enumerate(mark.tolist()) for j in filed[b][value]}
                if near:
                    chosen = np.array(sorted(near))
                    far = np.unpackbits(prints[chosen] ^ mark, axis=1).sum(axis=1)
                    if len(chosen := chosen[far <= self.radius]):
                        yield piece + at, chosen.tolist()


def item_blocks(benchmark: DataFrame, item: str, text: str, block_words: int) -> Iterator[list]:
    """The items in blocks of about ``block_words`` words, each fetched when its turn comes."""
    items = stored(
        benchmark.select(F.col(item).cast("long").alias("item_id"), text_of(text).alias("text")), "items"
    )
    total = items.agg(F.sum(F.size(F.split("text", r"\W+")))).first()[0] or 0
    blocks = 1 + total // block_words
    for block in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block)
        yield [(r.item_id, r.text) for r in part.collect()]


def matches(
    documents: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    radius: int = RADIUS,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row for each document and item found in it: the key and ``MATCHES``, of the best window."""
    narrow = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = None
    for block in item_blocks(benchmark, item, item_text, block_words):
        index = Index(block, radius)

        def search(batches: Iterator[pd.DataFrame], index: Index = index) -> Iterator[pd.DataFrame]:
            for batch in batches:
                rows = [(d, *m) for d, t in zip(batch.doc_id, batch.text, strict=True) for m in index.find(t)]
                columns = ["doc_id", "item_id", "start_word", "n_words", "similarity"]
                out = pd.DataFrame(rows, columns=columns)
                yield out.astype({"doc_id": "Int64", "item_id": "Int64"})

        part = narrow.mapInPandas(search, f"doc_id long, {MATCHES}")
        found = part if found is None else found.unionByName(part)
    return found


def _is_clean(index: Index):
    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        return pd.Series([next(index.find(t), None) is None for t in texts], dtype=bool)

    return clean


def remove_contaminated(documents: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents in which no item is found, with their columns as they were."""
    kept = packed(documents, F.col(text).alias("text"))
    for block in item_blocks(benchmark, "item_id", "text", BLOCK_WORDS):
        kept = kept.filter(_is_clean(Index(block))("text"))
    return kept.select("row.*")
