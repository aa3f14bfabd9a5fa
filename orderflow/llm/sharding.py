"""A uniform shuffle into shards of exact sizes.

The rows are dealt into source blocks by a hash. How many rows of each block go to each shard is
drawn exactly: the counts of a uniform shuffle of all rows follow the multivariate hypergeometric
distribution, given the block sizes and the shard sizes. Each block permutes its rows and deals
them out by its row of that communication matrix; each shard permutes what it got. So shard
sizes differ by at most one row and every arrangement is as likely as any other, up to the
quality of the hash.

The second permutation does not sort a whole shard in one task: a row draws one of many cells of its
shard, cells are numbered one after the other, and only rows of one cell are sorted. Both
permutations follow from the row and the seed, so reruns and recomputed tasks agree. The matrix is
blocks x shards counts, drawn on the driver from the block sizes alone.

Defined results: a null text has size 1 and checksum 0; repeated rows are rows of their own, and rows
equal in key and text may swap places; an empty table gives an empty table; other columns are not
looked at.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderflow.llm.common import packed, text_of

#: Rows of a source block and of a cell of a shard, about.
BLOCK_ROWS = 100_000
LEAST_BLOCKS = 64


def hypergeometric(rng: random.Random, good: int, bad: int, drawn: int) -> int:
    """How many of ``drawn`` out of ``good + bad`` items are good.

    Inversion that walks outward from the mode, about one standard deviation of steps: neighbouring
    probabilities are ratios of small terms, so totals beyond 2**53 rows would be needed to lose
    exactness that matters.
    """
    low, high = max(0, drawn - bad), min(drawn, good)
    if low == high:
        return low
    mode = min(max((drawn + 1) * (good + 1) // (good + bad + 2), low), high)

    def log_choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    peak = math.exp(
        log_choose(good, mode) + log_choose(bad, drawn - mode) - log_choose(good + bad, drawn)
    )
    left = rng.random() - peak
    up, down, p_up, p_down = mode, mode, peak, peak
    while left > 0 and (up < high or down > low):
        if up < high:
            p_up *= (good - up) * (drawn - up) / ((up + 1) * (bad - drawn + up + 1))
            up += 1
            left -= p_up
            if left <= 0:
                return up
        if down > low:
            p_down *= down * (bad - drawn + down) / ((good - down + 1) * (drawn - down + 1))
            down -= 1
            left -= p_down
            if left <= 0:
                return down
    return mode


def communication_matrix(blocks: list[int], shards: list[int], seed: int) -> list[list[int]]:
    """Rows of each block for each shard: row sums are the blocks, column sums the shards."""
    rng, room, matrix = random.Random(seed), list(shards), []
    for rows in blocks:
        dealt, rest, behind = [], rows, sum(room)
        for free in room:
            behind -= free
            got = hypergeometric(rng, free, behind, rest)
            dealt.append(got)
            rest -= got
        matrix.append(dealt)
        room = [free - got for free, got in zip(room, dealt, strict=True)]
    return matrix


def shard_rows(
    documents: DataFrame,
    shards: int = 16,
    key: str = "doc_id",
    text: str = "text",
    seed: int = 7,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per document: ``row`` (its columns), ``size``, ``text_crc32``, ``shard``, ``slot``.

    Blocks and cells are at least 64, and more so that none holds much over ``block_rows`` rows.
    """
    spark = documents.sparkSession
    total = documents.count()
    parts = max(LEAST_BLOCKS, -(-total // block_rows))

    def draw(purpose: str):
        return F.xxhash64(F.lit(f"{purpose} {seed}"), "key", "text_crc32", "size")

    row, body = F.col("row"), F.encode(text_of(F.col("row")[text]), "UTF-8")
    rows = (
        packed(documents)
        .select(
            "row",
            row[key].alias("key"),
            (F.octet_length(body) + 1).cast("long").alias("size"),
            F.crc32(body).alias("text_crc32"),
        )
        .withColumn("block", F.pmod(draw("block"), F.lit(parts)).cast("int"))
    )
    counted = {r.block: r.n for r in rows.groupBy("block").agg(F.count(F.lit(1)).alias("n")).collect()}
    blocks = [counted.get(b, 0) for b in range(parts)]
    sizes = [total // shards + (s < total % shards) for s in range(shards)]
    matrix = communication_matrix(blocks, sizes, seed)
    ends = []
    for b, dealt in enumerate(matrix):
        reached = 0
        upto = []
        for n in dealt:
            reached += n
            upto.append(reached)
        ends.append((b, upto))
    bounds = spark.createDataFrame(ends, "block int, ends array<bigint>")
    local = W.partitionBy("block").orderBy(draw("permute"), "key", "text_crc32", "size")
    dealt = (
        rows.withColumn("place", F.row_number().over(local))
        .join(bounds, "block")
        .withColumn("shard", F.expr("size(filter(ends, e -> e < place))"))
        .withColumn("cell", F.pmod(draw("cell"), F.lit(parts)).cast("int"))
        .select("row", "key", "size", "text_crc32", "shard", "cell")
    )
    cells = dealt.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("shard").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    starts = cells.select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inner = W.partitionBy("shard", "cell").orderBy(draw("again"), "key", "text_crc32", "size")
    return (
        dealt.join(starts, ["shard", "cell"])
        .withColumn("slot", F.col("start") + F.row_number().over(inner) - 1)
        .select("row", "size", "text_crc32", "shard", "slot")
    )
