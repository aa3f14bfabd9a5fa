"""Spelling variants by a permuterm index: words that differ by one character, and the form they go to.

A word is marked with a terminator, and all rotations of the marked word are filed in sorted order. A
replaced character stands, in the rotation that begins right after it, at the very end: the words that
differ there share the rest of that rotation, so they fill the prefix range of it. A word without that
character has that same prefix as a whole rotation, so insertions and deletions fall in the same range. So every
word files the prefix of each rotation that leaves out the character at its end, and all its whole rotations;
a scan over the sorted prefixes meets every pair of near words.

A range holds one whole word at most and one word per character of the alphabet, so its size is bounded
whatever the input. Pairs are not written out: a member learns from the scan how many others
are near to it and which of them is the most frequent one. Deleting any of a run of equal
characters gives the same word, so only the first of the run meets the whole word: every pair meets in one range.

Words: maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` with A-Z in lower case; of the run's occurrences in a document whose
crc32 of ``<key>:<run>`` is divisible by 199, the character at that crc32 modulo the length is left out. Those of
six characters and five occurrences, over all documents, are compared. Tasks count into a bounded table
before anything is shuffled.

Forms: the most frequent near word (of equally frequent ones the first) if it is five times as frequent. Frequencies rise
along forms, so they lead to a root, which pointer jumping over tables finds.

Defined results: null and empty texts have no words; a null key is written as the empty text in the hash; repeated
rows count each time; an empty table gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import stored, text_of
from orderflow.llm.neardup import pointed

LETTERS, OCCURRENCES, TIMES = 6, 5, 5
DROPPED = 199
END = "$"
#: Distinct words that a task counts before it hands them on.
_HELD = 500_000

_LOWER = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256)
)


def _spoken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n): sums of this task, keyed by the word's Latin-1 bytes while it counts."""
    total: Counter[bytes] = Counter()

    def close() -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in total], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(total.values(), pa.int64())], ["word", "n"])

    for batch in batches:
        for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
            start = zlib.crc32(f"{key}:".encode())
            # Characters beyond Latin-1 become a question mark, which parts words as they do.
            runs = text.encode("latin-1", "replace").translate(_LOWER).split()
            for run, n in Counter(runs).items():
                if len(run) < LETTERS:
                    continue
                mark = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
                if mark % DROPPED == 0:
                    at = mark % len(run)
                    run = run[:at] + run[at + 1 :]
                    if len(run) < LETTERS:
                        continue
                total[run] += n
            if len(total) >= _HELD:
                yield close()
                total.clear()
    yield close()


def count_words(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The words (word, n) that are compared."""
    rows = documents.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), text_of(text).alias("text")
    )
    counted = rows.mapInArrow(_spoken, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= OCCURRENCES)


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, edited, first, word, n): what each word files.

    ``edited`` is the character that the prefix leaves out, null for a whole rotation; ``first`` says that the
    character before it is another one.
    """
    rotated = F.expr(
        f"""flatten(array(
            transform(sequence(1, length(word)), i -> named_struct(
                'prefix', concat(substr(word, i + 1), '{END}', substr(word, 1, i - 1)),
                'edited', substr(word, i, 1),
                'first', i = 1 or substr(word, i, 1) <> substr(word, i - 1, 1))),
            transform(sequence(0, length(word)), i -> named_struct(
                'prefix', concat(substr(word, i + 1), '{END}', substr(word, 1, i)),
                'edited', cast(null as string),
                'first', false))))"""
    )
    return words.select(F.explode(rotated).alias("r"), "word", "n").select("r.*", "word", "n")


def _of_range(words: list[str], counts: list[int], edited: list, first: list[bool], out: list[tuple]) -> None:
    """What the members of one prefix range learn: (word, near words, count of the best, the best)."""
    order = sorted(range(len(words)), key=lambda i: (-counts[i], words[i]))
    longer = [i for i in order if edited[i] is not None]
    firsts = [i for i in longer if first[i]]
    whole = next((i for i in order if edited[i] is None), None)
    if whole is not None and firsts:
        out.append((words[whole], len(firsts), counts[firsts[0]], words[firsts[0]]))
    for i in longer:
        near = len(longer) - 1
        best = longer[1] if i == longer[0] and near else longer[0]
        if whole is not None and first[i]:
            if not near or (-counts[whole], words[whole]) < (-counts[best], words[best]):
                best = whole
            near += 1
        if near:
            out.append((words[i], near, counts[best], words[best]))


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by prefix: every range of more than one member."""
    held: pa.Table | None = None

    def ranges(table: pa.Table, ends: np.ndarray) -> pa.RecordBatch:
        out: list[tuple] = []
        starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
        many = np.flatnonzero(ends - starts > 1)
        columns = [table.column(c).combine_chunks() for c in ("word", "n", "edited", "first")]
        for a, b in zip(starts[many].tolist(), ends[many].tolist(), strict=True):
            _of_range(*(c[a:b].to_pylist() for c in columns), out)
        kinds = (("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string()))
        return pa.RecordBatch.from_arrays(
            [pa.array([row[i] for row in out], kind) for i, (_, kind) in enumerate(kinds)], [name for name, _ in kinds]
        )

    for batch in batches:
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        if table.num_rows < 2:
            held = table
            continue
        prefix = table.column("prefix").combine_chunks()
        ends = 1 + np.flatnonzero(pc.not_equal(prefix[1:], prefix[:-1]).to_numpy(zero_copy_only=False))
        last = int(ends[-1]) if len(ends) else 0
        yield ranges(table, ends)
        held = table.slice(last)
    if held is not None:
        yield ranges(held, np.array([held.num_rows]))


def variants(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per word: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``."""
    words = stored(count_words(documents, key, text), "words")
    filed = rotations(words).repartitionByRange("prefix").sortWithinPartitions("prefix")
    learned = filed.mapInArrow(_scanned, "word string, n_near long, best_n long, best string")
    best = learned.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("n"), "best")).alias("best")
    )
    is_form = -F.col("best.n") >= TIMES * F.col("n")
    near = stored(
        words.join(best, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(is_form, F.col("best.best")).alias("form"),
            F.when(is_form, -F.col("best.n")).alias("form_n"),
        ),
        "near-words",
    )
    roots = pointed(near.filter("form is not null").select(F.col("word").alias("id"), F.col("form").alias("parent")))
    roots = roots.select(F.col("id").alias("word"), "root")
    return near.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
