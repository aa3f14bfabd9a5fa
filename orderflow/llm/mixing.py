"""Mixing sources to target weights by systematic sampling.

The size of a document is its number of words. Sources weigh 1, 2, 3, 1, 2, 3, ... in code-point
order (null last) and share out the words of all documents by weight; a target stops at three
times its source's words and what it leaves is shared by the others, by weight. Every document of
a source expects the same number of copies, target / words of the source. The expected copies are
summed up along the documents of a source, one random offset per source is added, and a document
is emitted once for each integer that the sum crosses: so a document is taken as often as
expected, give or take less than one, and never more than three times.

Along a source, documents lie by size class, so that every part of the size distribution is
sampled in proportion and the taken words come near the target. No task sees a whole source: the
order is cut into cells (source, size class, block), the running total over cells comes from their
counts, and within a cell from a window over sizes and hashes of keys, without the texts. All sums are exact integers.

Defined results: null text has size 0; a document of size 0 may be taken any of 0 to 3 times and
adds nothing; a source of size 0 has target 0 and takes nothing; null is a source of its own;
repeated rows are documents of their own; rows of equal source, size and key may swap places; an
empty table gives an empty table; other columns are carried unchanged whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderflow.llm.common import packed, stored, text_of, words_of

MOST = 3
#: Documents of a block, about; a block is a fixed share of all documents, chosen by hash.
BLOCK_ROWS = 100_000


def _below(fraction_of: str, text: str) -> str:
    """A number from 0 to below ``fraction_of``, drawn from the hash of ``text``."""
    return (
        f"cast((cast(conv(substr(md5({text}), 1, 8), 16, 10) as decimal(20,0)) * {fraction_of})"
        " div 4294967296 as decimal(38,0))"
    )


def source_targets(sizes: DataFrame, seed: str) -> DataFrame:
    """Per source: words, target and the exact rate ``num / den`` of expected copies.

    ``sizes`` has source_key, source, size. Sources are names, so their list is small and one
    task may order it; the documents are summed up before that.
    """
    sources = (
        sizes.groupBy("source_key")
        .agg(
            F.first("source").alias("source"),
            F.sum("size").alias("source_size"),
            F.count(F.lit(1)).alias("n"),
        )
        .withColumn(
            "weight",
            F.pmod(F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(3)) + 1,
        )
    )
    everything = W.partitionBy()
    # Sources meet their limit in the order of words per weight; 6 / weight is whole.
    filling = W.orderBy((F.col("source_size") * (F.lit(6) / F.col("weight")).cast("long")), "source_key")
    before = filling.rowsBetween(W.unboundedPreceding, -1)
    from_here = filling.rowsBetween(W.currentRow, W.unboundedFollowing)
    dec = "decimal(38,0)"
    left = sources.select(
        "*",
        (
            F.sum("source_size").over(everything)
            - MOST * F.coalesce(F.sum("source_size").over(before), F.lit(0))
        ).cast(dec).alias("words_left"),
        F.sum("weight").over(from_here).alias("weight_left"),
        F.sum("n").over(everything).alias("n_all"),
    ).withColumn(
        "full",
        F.expr(f"cast({MOST} * source_size as {dec}) * weight_left <= weight * words_left"),
    )
    free = F.row_number().over(filling)
    first = F.min(F.when(~F.col("full"), F.struct("place", "words_left", "weight_left"))).over(everything)
    level = left.withColumn("place", free).withColumn("level", first)
    rated = level.selectExpr(
        "source_key",
        "source_size",
        "n_all",
        f"""if(full, cast({MOST} * source_size as double),
               cast(weight * level.words_left as double) / level.weight_left) as target""",
        f"cast(if(full, {MOST} * source_size, weight * level.words_left) as {dec}) as num",
        f"cast(if(full, source_size, level.weight_left * source_size) as {dec}) as den",
    )
    return rated.withColumn("shift", F.expr(_below("den", f"concat('{seed}', source_key)")))


def mix(
    documents: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    text: str | None = "text",
    size: Column | None = None,
    seed: str = "mix",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per document: ``row`` (its columns), ``size``, ``source_size``, ``target``, ``copies``.

    ``size`` may give the size where the text was not kept. Two passes read the rows: the first stores source,
    size and hash of the key, from which alone sums and places are found; the second moves the rows once, by
    the hash, to their places. What a source is given comes by cells, never by source. A task that holds texts
    holds its even share of all rows, whatever the sizes of sources and cells.
    """
    row = F.col("row")
    size = size if size is not None else F.size(words_of(text_of(row[text]))).cast("long")
    sized = packed(documents).select(
        "row",
        size.alias("size"),
        F.when(row[source].isNull(), "n").otherwise(F.concat(F.lit("s"), row[source])).alias("source_key"),
        row[source].alias("source"),
        F.md5(F.concat_ws(" ", F.lit(seed), row[key].cast("string"))).alias("hash"),
    )
    narrow = stored(sized.drop("row"), "sizes")
    targets = stored(source_targets(narrow, seed), "targets")
    n_all = targets.agg(F.max("n_all")).first()[0] or 0
    bits = "length(bin(size))"
    placed = (
        narrow.drop("source")
        .withColumn("class", F.expr(f"{bits} * 8 + (shiftright(size * 16, {bits}) & 7)"))
        .withColumn(
            "block",
            F.expr(f"pmod(cast(conv(substr(hash, 9, 7), 16, 10) as bigint), 1 + {n_all} div {block_rows})"),
        )
    )
    cell = ["source_key", "class", "block"]
    cells = placed.groupBy(*cell).agg(F.count(F.lit(1)).alias("n_cell"))
    earlier = (
        W.partitionBy("source_key").orderBy("class", "block").rowsBetween(W.unboundedPreceding, -1)
    )
    starts = cells.select(*cell, F.coalesce(F.sum("n_cell").over(earlier), F.lit(0)).alias("start"))
    starts = stored(starts.join(targets.drop("n_all"), "source_key"), "cells")
    order = W.partitionBy(*cell).orderBy("size", "hash")
    # Rows that are the same in these columns lie side by side; the rank is the place of the first.
    same = ["source_key", "size", "hash"]
    firsts = (
        placed.join(starts, cell)
        .withColumn("first", F.col("start") + F.rank().over(order))
        .drop("class", "block", "start")
        .dropDuplicates(same)
    )
    # Numbered before the join, rows are moved and sorted for both at once.
    nth = F.row_number().over(W.partitionBy(*same).orderBy("hash"))
    ranked = (
        sized.drop("source")
        .withColumn("nth", nth)
        .join(firsts, same)
        .withColumn("k", F.col("first") + F.col("nth") - 1)
    )
    dec = "cast({} as decimal(38,0))"
    upto = "({} * num + shift) div den"
    copies = f"""if(den = 0, 0, cast({upto.format(dec.format("k"))} as bigint)
                 - cast({upto.format(dec.format("(k - 1)"))} as bigint))"""
    return ranked.select("row", "size", "source_size", "target", F.expr(copies).alias("copies"))


def emit(mixed: DataFrame) -> DataFrame:
    """Each document as often as it was taken, with its columns as they were."""
    return mixed.filter("copies > 0").select(
        "row", F.explode(F.expr("sequence(1, cast(copies as int))")).alias("copy")
    ).select("row.*")
