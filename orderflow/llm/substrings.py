"""Removal of repeated passages with prefix-partitioned suffix trees.

A window is 50 consecutive words of a document. A word goes if a window covers it whose word
sequence also starts in a document with a smaller id; windows are judged on the input. A window
is a suffix of its document cut at 50 words, and documents share it exactly where their suffixes
meet in an internal node of the suffix tree at a depth of 50 words or more. So the suffixes are
split by a prefix, a subtree is built for each memory-sized set of prefixes, and in each deep node
the documents behind the smallest one lose the window.

* Documents of equal word sequence are represented by the first one: a copy loses all its words,
  if it has a window.
* The prefix. The 26 runs of 25 words in a window have hashes; the place of the smallest is the
  window's anchor. Equal windows have equal anchors, so the run of 25 words at the anchor is the
  prefix that all suffixes of a deep node share. Only one suffix in about 13 is an anchor of its own;
  the windows of one anchor are carried as one stretch of text.
* A prefix that no two different documents have leads to no deep node and is dropped before any text
  moves.
* Prefixes are sorted into tasks; a task fills a set up to ``tree_stretches`` stretches, always whole
  prefixes, and builds its subtree as a sorted suffix array whose equal neighbours up to
  depth 50 are the deep nodes. Words, not hashes, are compared.
* A prefix with more stretches than that gets longer: stretches of equal text are first merged into one
  branch, by partial sums before the shuffle. The windows of the branches become prefixes of 50
  words, where each prefix is one deep node, and its smallest document is found by a grouped minimum.
  So a passage that a third of all documents share meets no single task, and is split into windows
  once. Branches and these prefixes are told apart by 256 and 128 bits of a cryptographic hash.

Defined results: a null or empty text has no words; a document of fewer than 50 words loses none;
rows that share an id are
documents of their own that take nothing from one another; rows with a null id come before all others; an empty table gives an empty table; other columns are
not looked at. Every word of a text of any length is treated.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderflow.llm.common import stored, text_of
from orderflow.llm.wordhash import run_hashes, word_hashes

WINDOW, PREFIX = 50, 25
TREE_STRETCHES = 16384
_NULL_ID = -(1 << 62)


def anchors(data: bytes, window: int, prefix: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(place, first window, prefix number) of each anchor, and the number of words."""
    words = word_hashes(data)
    runs = run_hashes(words, prefix)
    n = len(words) - window + 1
    if n < 1:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64), len(words)
    reach = window - prefix + 1
    place = np.empty(n, np.int64)
    for begin in range(0, n, 65536):
        views = np.lib.stride_tricks.sliding_window_view(
            runs[begin : min(begin + 65536, n) + reach - 1], reach
        )
        place[begin : begin + len(views)] = views.argmin(axis=1) + np.arange(begin, begin + len(views))
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    return place[first], first, runs[place[first]], len(words)


def _texts(batch: pa.RecordBatch, column: str) -> Iterator[bytes]:
    for value in batch.column(column).cast(pa.binary()):
        yield value.as_py() or b""


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(offsets, pa.array(flat.astype(kind.to_pandas_dtype()), kind))


def _survey(window: int, prefix: int):
    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, sequences, prefixes = [], [], []
            for data in _texts(batch, "text"):
                _, _, numbers, n = anchors(data, window, prefix)
                counts.append(n)
                digest = hashlib.blake2b(b" ".join(data.split()), digest_size=16).digest()
                sequences.append(digest)
                prefixes.append(np.unique(numbers).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("tag"), pa.array(counts, pa.int64()),
                 pa.array(sequences, pa.binary()), _lists(prefixes, pa.int64())],
                ["id", "tag", "n_words", "sequence", "prefixes"],
            )

    return survey


def _stretches(window: int, prefix: int):
    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            columns = [batch.column(c).to_pylist() for c in ("id", "tag", "shared")]
            for data, doc, tag, keys in zip(_texts(batch, "text"), *columns, strict=True):
                _, first, numbers, n = anchors(data, window, prefix)
                hit = np.isin(numbers.view(np.int64), np.array(keys, np.int64))
                words = data.split()
                last = np.r_[first[1:], n - window + 1] - 1
                for place in np.flatnonzero(hit).tolist():
                    a, b = int(first[place]), int(last[place])
                    text = b" ".join(words[a : b + window])
                    out.append((int(numbers[place : place + 1].view(np.int64)[0]), doc, tag, a, text))
                    if len(out) >= 20_000:
                        yield _batch(out, STRETCH)
                        out = []
            yield _batch(out, STRETCH)

    return stretches


_ROW = [("id", pa.int64()), ("tag", pa.int64()), ("first", pa.int32())]
STRETCH = pa.schema([("prefix", pa.int64()), *_ROW, ("text", pa.binary())])
SPAN = pa.schema([*_ROW, ("last", pa.int32())])
NODE = pa.schema(
    [("node", pa.binary()), ("prefix", pa.int64()), ("digest", pa.string()), ("place", pa.int32()),
     ("least", pa.int64()), ("most", pa.int64())]
)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def repeated_in_tree(stretches: list[tuple[int, int, bytes]], window: int) -> list[np.ndarray]:
    """The windows to remove of each stretch (id, first, text), as places in the document.

    The suffixes of all stretches are sorted by their first ``window`` words; neighbours that are equal
    so far hang below one deep node.
    """
    numbers: dict[bytes, int] = {}
    rows, owner, at = [], [], []
    for k, (_, first, text) in enumerate(stretches):
        ids = np.array([numbers.setdefault(w, len(numbers)) for w in text.split()], np.int32)
        views = np.lib.stride_tricks.sliding_window_view(ids, window)
        rows.append(views)
        owner.append(np.full(len(views), k))
        at.append(first + np.arange(len(views)))
    if not rows:
        return []
    suffixes, owner, at = np.ascontiguousarray(np.concatenate(rows)), np.concatenate(owner), np.concatenate(at)
    keys = suffixes.view(np.dtype((np.void, suffixes.dtype.itemsize * window))).ravel()
    order = np.argsort(keys, kind="stable")
    ordered = suffixes[order]
    opens = np.r_[True, (ordered[1:] != ordered[:-1]).any(axis=1)]
    docs = np.array([s[0] for s in stretches], np.int64)[owner[order]]
    smallest = np.minimum.reduceat(docs, np.flatnonzero(opens))[np.cumsum(opens) - 1]
    gone = order[docs > smallest]
    found: list[np.ndarray] = []
    by_owner = np.argsort(owner[gone], kind="stable")
    cuts = np.searchsorted(owner[gone][by_owner], np.arange(len(stretches) + 1))
    for k in range(len(stretches)):
        found.append(np.sort(at[gone[by_owner[cuts[k] : cuts[k + 1]]]]))
    return found


def _spans(places: np.ndarray) -> Iterator[tuple[int, int]]:
    if len(places):
        breaks = np.flatnonzero(np.diff(places) > 1)
        yield from zip(places[np.r_[0, breaks + 1]].tolist(), places[np.r_[breaks, len(places) - 1]].tolist(), strict=True)


def _subtrees(window: int, limit: int):
    def subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def grown() -> Iterator[pa.RecordBatch]:
            gone = repeated_in_tree([(h[1], h[3], h[4]) for h in held], window)
            yield _batch(
                [(*h[1:3], a, b) for h, places in zip(held, gone, strict=True) for a, b in _spans(places)],
                SPAN,
            )

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in STRETCH.names]
            for row in zip(*columns, strict=True):
                if len(held) >= limit and row[0] != held[-1][0]:
                    yield from grown()
                    held = []
                held.append(row)
        yield from grown()

    return subtrees


def _nodes(window: int):
    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            columns = [batch.column(c).to_pylist() for c in ("prefix", "digest", "least", "most", "text")]
            for prefix, own, least, most, text in zip(*columns, strict=True):
                words = text.split()
                for k in range(len(words) - window + 1):
                    node = hashlib.blake2b(b" ".join(words[k : k + window]), digest_size=16).digest()
                    out.append((node, prefix, own, k, least, most))
                if len(out) >= 50_000:
                    yield _batch(out, NODE)
                    out = []
            yield _batch(out, NODE)

    return nodes


def _runs(places: DataFrame, smallest_too: bool) -> DataFrame:
    """Runs (a, b) of neighbouring places in each branch."""
    branch = ["prefix", "digest", "least"]
    island = F.col("place") - F.row_number().over(Window.partitionBy(*branch).orderBy("place"))
    return (
        places.withColumn("island", island)
        .groupBy(*branch, "island")
        .agg(F.min("place").alias("a"), F.max("place").alias("b"))
        .select(*branch, "a", "b", F.lit(smallest_too).alias("smallest_too"))
    )


def repeated_below(stretches: DataFrame, window: int) -> DataFrame:
    """(id, tag, first, last) of the windows to remove of stretches whose prefix is too large for a task.

    Stretches of equal text are one branch, which is looked at once with its smallest and largest id. Of
    a branch, the documents after the smallest lose every window that is a deep node, and the
    smallest those that start in a yet smaller one.
    """
    held = stretches.withColumn("digest", F.sha2("text", 256))
    branches = held.groupBy("prefix", "digest").agg(
        F.min("id").alias("least"), F.max("id").alias("most"), F.any_value("text").alias("text")
    )
    columns = "node binary, prefix long, digest string, place int, least long, most long"
    nodes = stored(branches.mapInArrow(_nodes(window), columns), "nodes")
    ends = nodes.groupBy("node").agg(F.min("least").alias("bottom"), F.max("most").alias("top"))
    deep = nodes.join(ends.filter("bottom < top"), "node")
    runs = _runs(deep, False).unionByName(_runs(deep.filter("bottom < least"), True))
    return (
        held.select("prefix", "digest", "id", "tag", "first")
        .join(runs, ["prefix", "digest"])
        .filter((F.col("id") == F.col("least")) == F.col("smallest_too"))
        .select("id", "tag", (F.col("first") + F.col("a")).alias("first"), (F.col("first") + F.col("b")).alias("last"))
    )


def repeated_windows(
    documents: DataFrame, survey: DataFrame, window: int, prefix: int, tree_stretches: int
) -> DataFrame:
    """(id, tag, first, last): runs of window starts to remove, of the documents ``survey`` lists.

    ``documents`` has id, tag and text; ``survey`` has id, tag and prefixes of the documents that
    stand for their word sequence.
    """
    own = survey.select("id", "tag", F.explode("prefixes").alias("prefix"))
    shared = own.groupBy("prefix").agg(F.min("id").alias("a"), F.max("id").alias("b")).filter("a < b")
    hits = (
        own.join(shared.select("prefix"), "prefix")
        .groupBy("id", "tag")
        .agg(F.collect_set("prefix").alias("shared"))
    )
    row = "id long, tag long, first int"
    stretches = stored(
        documents.join(hits, ["id", "tag"])
        .select("id", "tag", "text", "shared")
        .mapInArrow(_stretches(window, prefix), f"prefix long, {row}, text binary"),
        "stretches",
    )
    large = stretches.groupBy("prefix").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > tree_stretches)
    large = stored(large.select("prefix"), "large-prefixes")
    spans = (
        stretches.join(large, "prefix", "left_anti")
        .repartition("prefix")
        .sortWithinPartitions("prefix")
        .mapInArrow(_subtrees(window, tree_stretches), f"{row}, last int")
    )
    if large.isEmpty():
        return spans
    return spans.unionByName(repeated_below(stretches.join(large, "prefix", "left_semi"), window))


def _rest(window: int):
    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, hashes = [], [], []
            columns = [batch.column(c).to_pylist() for c in ("is_copy", "spans")]
            for data, is_copy, spans in zip(_texts(batch, "text"), *columns, strict=True):
                words = data.split()
                if is_copy and len(words) >= window:
                    kept = []
                elif spans:
                    edges = np.zeros(len(words) + 1, np.int64)
                    for span in spans:
                        edges[span["first"]] += 1
                        edges[span["last"] + window] -= 1
                    covered = np.cumsum(edges[:-1]) > 0
                    kept = [w for w, gone in zip(words, covered.tolist(), strict=True) if not gone]
                else:
                    kept = words
                counts.append(len(words))
                removed.append(len(words) - len(kept))
                hashes.append(b" ".join(kept))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(hashes, pa.binary()).cast(pa.string())],
                ["id", "n_words", "n_removed", "kept"],
            )

    return rest


def remove_repeats(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    prefix: int = PREFIX,
    tree_stretches: int = TREE_STRETCHES,
) -> DataFrame:
    """One row per document: the key, ``n_words``, ``n_removed`` and ``kept``, the words that stay."""
    row = ["id", "tag"]
    narrow = documents.select(
        F.coalesce(F.col(key).cast("long"), F.lit(_NULL_ID)).alias("id"), text_of(text).alias("text")
    ).select("id", F.xxhash64("text").alias("tag"), "text")
    survey = stored(
        narrow.mapInArrow(
            _survey(window, prefix),
            "id long, tag long, n_words long, sequence binary, prefixes array<long>",
        ),
        "survey",
    ).filter(F.col("n_words") >= window)
    first = survey.groupBy("sequence").agg(F.min("id").alias("id"))
    leaders = survey.join(first, ["sequence", "id"], "left_semi").select(*row, "prefixes")
    spans = repeated_windows(narrow, leaders, window, prefix, tree_stretches)
    by_document = spans.groupBy(*row).agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    copies = (
        survey.select(*row, "sequence")
        .join(first.withColumnRenamed("id", "leader"), "sequence")
        .filter("id > leader")
        .select(*row, F.lit(True).alias("is_copy"))
        .distinct()
    )
    marks = by_document.join(copies, row, "full_outer")
    out = narrow.join(marks, row, "left").select("id", "text", "is_copy", "spans")
    return out.mapInArrow(_rest(window), "id long, n_words long, n_removed long, kept string").select(
        F.expr(f"nullif(id, {_NULL_ID})").alias(key), "n_words", "n_removed", "kept"
    )
