"""Phrases whose parts occur together more often than chance: count automata over sorted n-grams.

Texts, with A-Z in lower case, are cut at marks and line ends into pieces, and pieces at spaces and tabs into words.
Every place of a piece starts one window of up to five words, so the occurrences of a phrase are
the windows that begin with it.

Shards. Documents of a language are read in blocks of about ``BLOCK`` words with a dictionary of their own
(``blocks``). The dictionaries are summed up, words below the least count are given up (no phrase with one
can reach it) and the others are numbered, in order, without a gap; the numbers go back to the blocks. A block
sorts its windows and builds a transducer from them: a prefix tree whose paths are the
n-grams and whose weights count them, each window adding the arcs after what it shares with the one before.

Union. The window space is cut into prefix ranges of about ``RANGE`` windows, at places sampled from all blocks, so
that a frequent word or phrase is cut further than a rare one. A block's transducer is cut there, the parts
of one range meet in one task, and their union adds up the weights of equal paths. A phrase that reaches over
the end of a range is handed on by all its ranges whatever its weight, others if they reach the least
count; one more sum makes them whole.

Composition. The path of a candidate is cut into two paths after each word, and both are looked up in the table of
all counts by merge joins. A candidate lies in a longer one of at least its own count only if it lies in
one longer by one word with that count, so two parts of each candidate are compared.

Bounds: a task holds a block or a range. The driver sees the sampled range ends, about one window per ``RANGE``
words, and the totals. The list of languages is joined, not broadcast by hand.

Defined results: a null language is ``und``; null and empty texts have no words; repeated rows count each time; an
empty table gives an empty table; a table whose words all stay below the least count too; other columns are not looked at.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderflow.llm.blocks import LONGEST_DICTIONARY, Numbers, pack, returned, told, unpack
from orderflow.llm.common import stored, text_of

LONGEST = 5
LEAST, TOP = 100, 2000
#: Words of a block, and windows of a range, about.
BLOCK, RANGE = 4_000_000, 2_000_000
#: Windows of a block that are sorted at a time.
_SORTED = 1_000_000
#: Sampled windows per range.
_PER_RANGE = 64
SLICE = 1 << 20

_END = b"\xff"  # stands in no UTF-8 text
_TABLE = bytes(
    0xFF if c in b".,;:!?\n\x0b\x0c\r" else c + 32 if 65 <= c <= 90 else c for c in range(256)
)
_GAP = re.compile(rb"[\x20\x09\xff]")


def _words(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text in portions; ``_END`` stands between pieces."""
    data = data.translate(_TABLE)
    begin = 0
    while begin < len(data):
        end = len(data)
        if end - begin > SLICE:
            gap = _GAP.search(data, begin + SLICE)
            end = gap.start() if gap else end
        yield data[begin:end].replace(_END, b" \xff ").split()
        begin = end


class _Shard:
    """The words of one language in a block, as numbers from 1; 0 ends a piece."""

    def __init__(self, before: list[bytes] = ()):
        self.numbers = Numbers()
        self.numbers[_END] = 0
        self.places = array("I", map(self.numbers.__getitem__, before))


def _shards(block: int) -> Callable:
    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 33
        made = total = 0
        held: dict[str, _Shard] = {}

        def close(lang: str, open_end: bool = False) -> pa.RecordBatch:
            """The block; with an open end its last windows are left to the next block."""
            nonlocal made
            shard = held.pop(lang)
            places = np.array(shard.places, "<u4")
            own = max(len(places) - (LONGEST - 1), 0) if open_end else len(places)
            words = list(shard.numbers)
            if open_end:
                held[lang] = _Shard([words[i] for i in shard.places[own:]])
            counts = np.bincount(places[:own], minlength=len(words))[1:]
            made += 1
            return pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([base + made], pa.int64()),
                    "lang": pa.array([lang], pa.string()),
                    "length": pa.array([len(places)], pa.int64()),
                    "own": pa.array([own], pa.int64()),
                    "n": pa.array([int(counts.sum())], pa.int64()),
                    "places": pa.array([pack(places)], pa.binary()),
                    "words": pa.array([words[1:]], pa.list_(pa.binary())).cast(pa.list_(pa.string())),
                    "counts": pa.array([counts], pa.list_(pa.int64())),
                }
            )

        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for lang, text in zip(batch.column("lang").to_pylist(), texts, strict=True):
                for words in _words(text):
                    shard = held.setdefault(lang, _Shard())
                    before = len(shard.places)
                    shard.places.extend(map(shard.numbers.__getitem__, words))
                    total += len(shard.places) - before
                    if len(shard.places) >= block:
                        total -= len(shard.places)
                        yield close(lang, open_end=True)
                        total += len(held[lang].places)
                if lang in held:
                    held[lang].places.append(0)
                    total += 1
                if total >= 2 * block:  # many languages
                    yield from [close(name) for name in list(held)]
                    total = 0
        yield from [close(name) for name in list(held)]

    return shards


# --- transducers -------------------------------------------------------------


def windows(numbers: np.ndarray, own: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct windows that start at the first ``own`` places, one per row, and their counts.

    A window ends before a 0 and is filled up with 0; windows of nothing are left out.
    """
    padded = np.concatenate([numbers, np.zeros(LONGEST, numbers.dtype)])
    starts = np.flatnonzero(padded[:own])
    rows = np.zeros((len(starts), LONGEST), numbers.dtype)
    alive = np.ones(len(starts), bool)
    for k in range(LONGEST):
        rows[:, k] = np.where(alive, padded[starts + k], 0)
        alive &= rows[:, k] > 0
    return summed(rows, np.ones(len(rows), np.int64))


def summed(rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct rows with their counts added up."""
    if not len(rows):
        return rows, counts
    order = np.lexsort(rows.T[::-1])
    rows, counts = rows[order], counts[order]
    new = np.concatenate(([True], (rows[1:] != rows[:-1]).any(axis=1)))
    return rows[new], np.add.reduceat(counts, np.flatnonzero(new))


def _levels(rows: np.ndarray) -> list[np.ndarray]:
    """For each level, the rows where a new path of that many words begins: what the row before does not share."""
    new = np.zeros(len(rows), bool)
    new[:1] = True
    found = []
    for k in range(LONGEST):
        new = new.copy()
        new[1:] |= rows[1:, k] != rows[:-1, k]
        found.append(np.flatnonzero(new & (rows[:, k] > 0)))
    return found


def built(rows: np.ndarray, counts: np.ndarray) -> bytes:
    """The transducer of sorted windows: per level the arcs' labels, how many arcs follow each, and how many windows end there."""
    levels, parts = _levels(rows), [np.array([len(rows)], "<u8").tobytes()]
    length = (rows > 0).sum(axis=1)
    for k, starts in enumerate(levels):
        follow = np.zeros(len(starts), "<u4")
        if k + 1 < LONGEST and len(levels[k + 1]):
            follow = np.bincount(
                np.searchsorted(starts, levels[k + 1], side="right") - 1, minlength=len(starts)
            ).astype("<u4")
        ended = np.zeros(len(starts), "<u8")
        here = np.flatnonzero(length == k + 1)
        ended[np.searchsorted(starts, here, side="right") - 1] = counts[here]
        for values in (rows[starts, k], follow, ended):
            data = pack(values)
            parts += [np.array([len(values), len(data)], "<u8").tobytes(), data]
    return b"".join(parts)


def paths(data: bytes, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """The windows of a transducer, shorter ones first, and their counts."""
    n, at = int(np.frombuffer(data, "<u8", 1)[0]), 8
    levels = []
    for _ in range(LONGEST):
        level = []
        for kind in (dtype, "<u4", "<u8"):
            size, length = np.frombuffer(data, "<u8", 2, at).tolist()
            level.append(unpack(data[at + 16 : at + 16 + length], size, kind))
            at += 16 + length
        levels.append(level)
    prefix = np.zeros((1, 0), dtype)
    follow = np.array([len(levels[0][0])])
    done = []
    for k, (labels, after, ended) in enumerate(levels):
        parent = np.repeat(np.arange(len(prefix)), follow)
        prefix = np.concatenate([prefix[parent], labels[:, None]], axis=1)
        ends = np.flatnonzero(ended)
        full = np.zeros((len(ends), LONGEST), dtype)
        full[:, : k + 1] = prefix[ends]
        done.append((full, ended[ends].astype(np.int64)))
        follow = after
    rows = np.concatenate([d[0] for d in done])
    counts = np.concatenate([d[1] for d in done])
    assert len(rows) == n
    return rows, counts


def _ranges(rows: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The number of ``ends`` at or before each of sorted ``rows``: where a range begins, among the rows."""
    both = np.concatenate([ends, rows])
    kind = np.concatenate([np.zeros(len(ends), np.int8), np.ones(len(rows), np.int8)])
    order = np.lexsort((kind, *both.T[::-1]))
    return np.cumsum(kind[order] == 0)[kind[order] == 1]


def _keys(rows: np.ndarray) -> pa.Array:
    """The rows as big-endian bytes, which sort as they do."""
    data = np.ascontiguousarray(rows).astype(rows.dtype.newbyteorder(">")).tobytes()
    width = rows.shape[1] * rows.dtype.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int64) * width
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(rows), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)]
    ).cast(pa.binary())


def _numbered(batch: pa.RecordBatch, i: int, dtype: str) -> tuple[str, np.ndarray, int]:
    """Language, words by their numbers in the whole table, and own places of a block."""
    length, own = batch.column("length")[i].as_py(), batch.column("own")[i].as_py()
    local = unpack(batch.column("places")[i].as_py(), length)
    known = np.zeros(int(local.max(initial=0)) + 1, dtype)
    at, ids = told(batch, i)
    known[at + 1] = ids
    return batch.column("lang")[i].as_py(), known[local], own


def _sampled(dtype: str, every: int) -> Callable:
    """(lang, key) of every so many windows, from a place that follows from the block."""

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                lang, numbers, own = _numbered(batch, i, dtype)
                start = batch.column("block")[i].as_py() * 7919 % every
                picked = np.arange(start, own, every)
                padded = np.concatenate([numbers, np.zeros(LONGEST, numbers.dtype)])
                rows = np.stack([padded[picked + k] for k in range(LONGEST)], axis=1)
                for k in range(1, LONGEST):
                    rows[rows[:, k - 1] == 0, k] = 0
                rows = rows[rows[:, 0] > 0]
                langs = pa.array([lang] * len(rows), pa.string())
                yield pa.RecordBatch.from_arrays([langs, _keys(rows)], ["lang", "key"])

    return sampled


def _cut(dtype: str, ends: dict[str, np.ndarray]) -> Callable:
    """(lang, part, arcs): the transducer of each block, cut at the ends of the ranges."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                lang, numbers, own = _numbered(batch, i, dtype)
                for begin in range(0, own, _SORTED):
                    size = min(_SORTED, own - begin)
                    rows, counts = windows(numbers[begin : begin + size + LONGEST], size)
                    if len(rows):
                        yield _arcs(lang, rows, counts, ends.get(lang, np.zeros((0, LONGEST), dtype)))

    return cut


def _arcs(lang: str, rows: np.ndarray, counts: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
    part = _ranges(rows, ends)
    starts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
    stops = [*starts[1:].tolist(), len(rows)]
    arcs = [built(rows[a:b], counts[a:b]) for a, b in zip(starts.tolist(), stops, strict=True)]
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(arcs)), pa.array(part[starts], pa.int32()), pa.array(arcs, pa.binary())],
        ["lang", "part", "arcs"],
    )


def _united(dtype: str, least: int) -> Callable:
    """Rows sorted by (lang, part): the phrases of each range and their counts there."""

    def united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, held, n = None, [], 0

        def merged() -> None:
            rows, counts = summed(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))
            held[:] = [(rows, counts)]

        for batch in batches:
            for lang, part, arcs in zip(*(batch.column(c).to_pylist() for c in ("lang", "part", "arcs")), strict=True):
                if (lang, part) != own:
                    if held:
                        merged()
                        yield _phrases(own[0], *held[0], least)
                    own, held, n = (lang, part), [], 0
                held.append(paths(arcs, dtype))
                n += len(held[-1][0])
                if n > 2 * RANGE and n > 2 * len(held[0][0]):
                    merged()
                    n = len(held[0][0])
        if held:
            merged()
            yield _phrases(own[0], *held[0], least)

    return united


def _phrases(lang: str, rows: np.ndarray, counts: np.ndarray, least: int) -> pa.RecordBatch:
    """The paths of two words and more that reach the least count, or the ends of the range."""
    upto = np.concatenate(([0], np.cumsum(counts)))
    keys, totals = [], []
    # Where a path ends: at the next row whose prefix differs, even if that row has no such path.
    new = np.zeros(len(rows), bool)
    new[0] = True
    for k in range(LONGEST):
        new = new.copy()
        new[1:] |= rows[1:, k] != rows[:-1, k]
        if not k:
            continue
        starts = np.flatnonzero(new)
        stops = np.append(starts[1:], len(rows))
        weights = upto[stops] - upto[starts]
        chosen = (weights >= least) | (starts == 0) | (stops == len(rows))
        chosen &= rows[starts, k] > 0
        keys.append(_keys(rows[starts[chosen], : k + 1]))
        totals.append(weights[chosen])
    key, f = pa.concat_arrays(keys), np.concatenate(totals)
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(f), pa.string()), key, pa.array(f, pa.int64())], ["lang", "key", "f"]
    )


# --- the table ---------------------------------------------------------------


def numbered(words: DataFrame) -> DataFrame:
    """``words`` (lang, word, f, n) with ``id`` from 1, without a gap, in order.

    Ranges of words are numbered by the tasks that hold them; the ranges' sizes, a row per task, give their offsets.
    """
    placed = stored(
        words.repartitionByRange("lang", "word")
        .sortWithinPartitions("lang", "word")
        .withColumn("place", F.monotonically_increasing_id()),
        "vocabulary",
    ).withColumn("task", F.shiftright("place", 33))
    sizes = placed.groupBy("task").agg(F.count(F.lit(1)).alias("size"))
    before = W.orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("task", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    number = F.col("offset") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return stored(placed.join(offsets, "task").select(*words.columns, number.alias("id")), "numbered")


def _range_ends(blocks: DataFrame, dtype: str, total: int, size: int) -> dict[str, np.ndarray]:
    """Per language, the first windows of all ranges but the first: quantiles of a sample."""
    every = max(1, size // _PER_RANGE)
    if total <= size:
        return {}
    sample = blocks.mapInArrow(_sampled(dtype, every), "lang string, key binary").collect()
    found: dict[str, list[bytes]] = {}
    for row in sample:
        found.setdefault(row.lang, []).append(bytes(row.key))
    ends = {}
    for lang, keys in found.items():
        firsts = sorted(set(sorted(keys)[_PER_RANGE::_PER_RANGE]))
        if firsts:
            big = np.dtype(dtype).newbyteorder(">")
            ends[lang] = np.frombuffer(b"".join(firsts), big).astype(dtype).reshape(-1, LONGEST)
    return ends


def count_phrases(
    documents: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, block: int = BLOCK, size: int = RANGE
) -> tuple[DataFrame, DataFrame, int]:
    """All phrases (lang, key, f), f at least ``least``; the words (lang, word, f, n, id); bytes per word of a key."""
    if block + SLICE > LONGEST_DICTIONARY:
        raise ValueError(f"a block of {block} words is too long")
    rows = documents.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), text_of(text).alias("text"))
    blocks = stored(
        rows.mapInArrow(
            _shards(block),
            "block long, lang string, length long, own long, n long, places binary, words array<string>, counts array<long>",
        ),
        "phrase-blocks",
    )
    langs = blocks.groupBy("lang").agg(F.sum("n").alias("n"))
    entries = blocks.select("block", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "e")).select(
        "block", "lang", "at", "e.words", "e.counts"
    )
    totals = entries.groupBy("lang", F.col("words").alias("word")).agg(F.sum("counts").alias("f"))
    frequent = stored(totals.filter(F.col("f") >= least), "words")
    words = numbered(frequent.join(langs, "lang").select("lang", "word", "f", "n"))
    many, total = words.agg(F.count(F.lit(1)), F.coalesce(F.sum("f"), F.lit(0))).first()
    dtype = "<u4" if many < 1 << 32 else "<u8"
    # The dictionaries' words of a block; the answer is carried beside the block.
    asked = entries.select("block", "lang", "at", F.col("words").alias("word"))
    narrow = blocks.select("block", "lang", "length", "own", "places")
    # A merge join at any size: words that stand in all blocks are one row per block, so neither side is short.
    ids = words.select("lang", "word", "id").hint("merge")
    answers = asked.join(ids, ["lang", "word"], "left").select("block", "at", "id")
    known = stored(returned(narrow, answers, "id"), "numbered-blocks")
    ends = _range_ends(known, dtype, total, size)
    arcs = known.mapInArrow(_cut(dtype, ends), "lang string, part int, arcs binary")
    ranges = max(1, len(ends) + sum(map(len, ends.values())))
    parts = (
        arcs.repartition(ranges, "lang", "part")
        .sortWithinPartitions("lang", "part")
        .mapInArrow(_united(dtype, least), "lang string, key binary, f long")
    )
    phrases = stored(
        parts.groupBy("lang", "key").agg(F.sum("f").alias("f")).filter(F.col("f") >= least), "phrases"
    )
    return phrases, words, np.dtype(dtype).itemsize


def collocations(
    documents: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, top: int = TOP, **sizes: int
) -> DataFrame:
    """Each language's first phrases: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``."""
    phrases, words, width = count_phrases(documents, lang, text, least, **sizes)
    spelled = F.lpad(F.hex("id"), 2 * width, "0")
    single = words.select(F.unhex(spelled).alias("key"), "f", "n")
    counts = single.unionByName(phrases.select("key", "f", F.lit(None).cast("long").alias("n")))

    m = (F.octet_length("key") / width).cast("int")
    cuts = phrases.select("key", F.explode(F.sequence(F.lit(1), m - 1)).alias("k")).select(
        "key",
        "k",
        F.expr(f"substring(key, 1, {width} * k)").alias("one"),
        F.expr(f"substring(key, {width} * k + 1)").alias("other"),
    )
    one = counts.select(F.col("key").alias("one"), F.col("f").alias("l"), "n")
    other = counts.select(F.col("key").alias("other"), F.col("f").alias("r"))
    composed = (
        cuts.join(one, "one")
        .join(other, "other")
        .groupBy("key")
        .agg(F.collect_list(F.struct("k", "l", "r")).alias("cuts"), F.max("n").alias("n"))
    )
    inside = phrases.filter(m > 2).select(
        F.explode(
            F.array(F.expr(f"substring(key, {width + 1})"), F.expr(f"substring(key, 1, octet_length(key) - {width})"))
        ).alias("key"),
        "f",
    )
    over = inside.groupBy("key").agg(F.max("f").alias("over"))
    scored = (
        phrases.select("lang", "key", F.col("f").alias("a"))
        .join(over, "key", "left")
        .filter("over is null or over < a")
        .join(composed, "key")
        .withColumn(
            "best",
            F.expr(
                """array_min(transform(cuts, c -> struct(
                    (cast(1000 as decimal(4,0)) * (cast(a as decimal(19,0)) * cast(n as decimal(19,0))))
                        div (cast(c.l as decimal(19,0)) * cast(c.r as decimal(19,0))) as score,
                    c.k as k, c.l as l, c.r as r)))"""
            ),
        )
        .select("lang", "key", "a", "best.l", "best.r", "n", "best.score")
    )
    order = [F.desc("score"), F.desc("a")]
    # Ties at the end stay in until the phrases are spelled.
    first = scored.withColumn("rank", F.rank().over(W.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    first = stored(first, "first-phrases")
    at = F.posexplode(F.expr(f"transform(sequence(1, octet_length(key), {width}), i -> substring(key, i, {width}))"))
    by_id = words.select(F.unhex(spelled).alias("id"), "word")
    texts = (
        first.select("key", at.alias("place", "id"))
        .join(by_id, "id")
        .groupBy("key")
        .agg(F.array_join(F.expr("transform(array_sort(collect_list(struct(place, word))), w -> w.word)"), " ").alias("phrase"))
    )
    ranked = W.partitionBy("lang").orderBy(*order, "phrase")
    return (
        first.drop("rank")
        .join(texts, "key")
        .withColumn("rank", F.row_number().over(ranked).cast("long"))
        .filter(F.col("rank") <= top)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
