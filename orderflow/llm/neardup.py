"""Near-duplicate documents by a chosen-path set similarity join on minwise tokens.

A document's set is its distinct runs of ``shingle`` words, with A-Z in lower case; two documents are
linked if the Jaccard similarity of their sets is 0.8 or more. Documents of equal sets are one class.
The join is between classes, each with a number of its own: whatever ids the documents of a class have, and
however many classes an id is in. Only at the end a component is named by its smallest id.

The join. A set is embedded as 128 minwise tokens; two sets agree in each with their similarity as
probability. Each of 12 trees starts with all documents in its root. A node chooses one or two of
the 128 places, 1 / 0.8 on average, by a hash of the path that leads to it, so all its documents choose
alike; a document goes to the child of each chosen token that it has. So a pair at the threshold is
expected to share one path per level, and paths are shared exactly where tokens agree. Nodes of at
most ``small`` documents are compared exhaustively and end there; larger ones branch on, up to
``depth`` levels. At the threshold a pair with an average number of agreeing tokens meets in one tree of
depth 5 with probability over 0.5, in 12 trees with over 0.9995; pairs above it, and
all pairs in nodes that become small early, meet more often.

Comparisons. In a small node all pairs are compared by their sketches, 4 bits of each token; pairs
whose agreement is over 4.5 standard deviations below that of the threshold are dropped. A node still
large at the last level holds documents that share a whole path; there each document is compared
with its next ones in a hash order, and after the first linking all documents outside the node's main component
with all that are not in their component, so no link between components is given up.

Confirming. Links are confirmed on the full sets. Since only components are asked for, a small node first
names one candidate for each of its documents, the best among smaller ids, and each document
confirms the best of these; the confirmed links form a forest. Then nodes that have candidates and documents of
several trees are compared again, for candidates between trees alone, which are confirmed; last come those that join
components in large nodes. A candidate inside one tree can't change the result and is not named, so a group of near copies gives
rows in proportion to its documents, not to its pairs. Components are found by hooking and pointer jumping over
tables; nothing of the documents reaches the driver.

Defined results: null and empty texts have an empty set, are linked with nothing and kept; a text of
fewer words than a shingle is one shingle; rows of one id with different texts are documents of their own, each with
the component of its text; a null id is one like another and stands before all, and so do rows with it; repeated
rows of a component's first document are all marked as kept, while ``keep_first`` keeps one row of a component; an empty table gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import packed, stored, text_of
from orderflow.llm.wordhash import mix, run_hashes, word_hashes

TOKENS = 128
_NULL_ID = -(1 << 62)
_U = np.uint64
_FACTORS = np.random.Generator(np.random.PCG64(77)).integers(0, 2**63, TOKENS, dtype=np.uint64) * _U(2) + _U(1)


@dataclass(frozen=True)
class Join:
    shingle: int = 2
    percent: int = 80
    trees: int = 12
    depth: int = 5
    small: int = 16
    #: Documents that each document of a large last node is compared with at first.
    ring: int = 4
    #: Documents of a slot, in the exhaustive comparison of large last nodes.
    cell: int = 4096

    @property
    def agreement(self) -> int:
        """Agreeing 4-bit tokens that a candidate must have."""
        share = self.percent / 100 + (1 - self.percent / 100) / 16
        return int(TOKENS * share - 4.5 * (TOKENS * share * (1 - share)) ** 0.5)


def shingle_set(data: bytes, size: int) -> np.ndarray:
    """The distinct shingles of a text as sorted numbers."""
    words = word_hashes(data.lower())
    if 0 < len(words) < size:
        return run_hashes(words, len(words)) + _U(1)
    return np.unique(run_hashes(words, size))


def minwise(shingles: np.ndarray) -> np.ndarray:
    """The minwise tokens of a set that is not empty, 32 bits each."""
    least = np.full(TOKENS, np.iinfo(np.uint64).max, np.uint64)
    for begin in range(0, len(shingles), 2048):
        part = shingles[begin : begin + 2048]
        for f in range(0, TOKENS, 32):
            hashed = part[None, :] * _FACTORS[f : f + 32, None]
            hashed ^= hashed >> _U(32)
            hashed *= _U(0x9E3779B97F4A7C15)
            np.minimum(least[f : f + 32], hashed.min(axis=1), out=least[f : f + 32])
    return (least >> _U(32)).astype(np.uint32)


def children(nodes: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The children that documents go to: (row, child). Row i is node i with the tokens of its document."""
    rows, found = [], []
    for choice in (1, 2):
        drawn = mix(nodes + _U(choice * 0x51ED27))
        chosen = np.arange(len(nodes)) if choice == 1 else np.flatnonzero(drawn >> _U(62) == 0)
        place = (drawn[chosen] & _U(TOKENS - 1)).astype(np.int64)
        token = tokens[chosen, place].astype(np.uint64)
        rows.append(chosen)
        found.append(mix(nodes[chosen] + mix(token * _U(TOKENS) + place.astype(np.uint64))))
    return np.concatenate(rows), np.concatenate(found)


def _lists(sizes: np.ndarray, flat: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(flat.view(np.int64), pa.int64()))


def _survey(join: Join):
    roots = mix(np.arange(1, join.trees + 1, dtype=np.uint64))

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, tokens = [], [], []
            for value in batch.column("text").cast(pa.binary()):
                shingles = shingle_set(value.as_py() or b"", join.shingle)
                counts.append(len(shingles))
                digests.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                tokens.append(minwise(shingles) if len(shingles) else None)
            full = [k for k, t in enumerate(tokens) if t is not None]
            sizes, nodes = np.zeros(len(tokens), np.int64), np.zeros(0, np.uint64)
            if full:
                table = np.stack([tokens[k] for k in full])
                at = np.repeat(np.arange(len(full)), join.trees)
                rows, found = children(np.tile(roots, len(full)), table[at])
                order = np.argsort(at[rows], kind="stable")
                nodes = found[order]
                sizes[full] = np.bincount(at[rows], minlength=len(full))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(counts, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array([None if t is None else t.tobytes() for t in tokens], pa.binary()),
                    _lists(sizes, nodes),
                ],
                ["n_shingles", "class", "tokens", "nodes"],
            )

    return survey


def _branch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("id").to_numpy(zero_copy_only=False)
        lists = batch.column("nodes").to_pylist()
        sizes = np.array([len(x) for x in lists], np.int64)
        if not len(ids) or not sizes.sum():
            continue
        nodes = np.array([n for x in lists for n in x], np.int64).view(np.uint64)
        table = np.stack([np.frombuffer(t.as_py(), np.uint32) for t in batch.column("tokens")])
        at = np.repeat(np.arange(len(ids)), sizes)
        rows, found = children(nodes, table[at])
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[at[rows]], pa.int64()), pa.array(found.view(np.int64), pa.int64())], ["id", "node"]
        )


def _nibbles(tokens: list[bytes]) -> np.ndarray:
    return np.stack([np.frombuffer(t, np.uint32) & np.uint32(15) for t in tokens]).astype(np.uint8)


def _close_pairs(ids: list[int], tokens: list[bytes], least: int) -> Iterator[tuple[int, int, int]]:
    """(a, b, agree) of the pairs that may be linked, a < b."""
    order = np.argsort(np.array(ids), kind="stable")
    ids, sketches = np.array(ids)[order], _nibbles([tokens[i] for i in order])
    for k in range(1, len(ids)):
        agree = (sketches[:-k] == sketches[k:]).sum(axis=1)
        for i in np.flatnonzero(agree >= least).tolist():
            yield int(ids[i]), int(ids[i + k]), int(agree[i])


def _best(node: int, ids: list[int], tokens: list[bytes], join: Join) -> Iterator[tuple]:
    """One candidate of each document, other documents that have some, and the node itself if there are any."""
    best: dict[int, tuple[int, int]] = {}
    least = set()
    for a, b, agree in _close_pairs(ids, tokens, join.agreement):
        least.add(a)
        best[b] = max(best.get(b, (0, 0)), (agree, -a))
    for b, (agree, a) in best.items():
        yield -a, b, agree, None
    for a in least - best.keys():
        yield None, a, None, None
    if best:
        yield None, None, None, node


def _crossing(node: int, ids: list[int], tokens: list[bytes], roots: list[int], join: Join) -> Iterator[tuple]:
    """All candidates between documents of different roots."""
    root = dict(zip(ids, roots, strict=True))
    for a, b, agree in _close_pairs(ids, tokens, join.agreement):
        if root[a] != root[b]:
            yield a, b, agree, None


def _compare_small(join: Join, crossing: bool = False):
    """Rows sorted by node: the candidates that each node names."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("id", "tokens", "root") if crossing else ("id", "tokens")
        find = _crossing if crossing else _best
        node, held = None, []
        out: list[tuple] = []

        def close() -> None:
            if len(held) > 1:
                out.extend(find(node, *(list(x) for x in zip(*held, strict=True)), join))

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("node", *names)]
            for own, *row in zip(*columns, strict=True):
                if own != node:
                    close()
                    node, held = own, []
                held.append(row)
            yield _named(out)
            out.clear()
        close()
        yield _named(out)

    return compare


def _named(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b", "agree", "node"])


def _pairs(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    flat = np.array(rows, np.int64).reshape(-1, 3)
    return pa.RecordBatch.from_arrays([pa.array(flat[:, i]) for i in range(3)], ["a", "b", "agree"])


def _agreeing(join: Join):
    """Keeps pairs whose sketches agree enough."""

    def agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                one, other = (_nibbles(batch.column(c).to_pylist()) for c in ("tokens_a", "tokens_b"))
                agree = (one == other).sum(axis=1)
                keep = agree >= join.agreement
                a, b = (batch.column(c).to_numpy()[keep] for c in "ab")
                yield _pairs(list(zip(np.minimum(a, b), np.maximum(a, b), agree[keep], strict=True)))

    return agreeing


def _confirming(join: Join):
    def confirming(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, other in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                x, y = (np.frombuffer(s.as_py(), np.uint64) for s in (one, other))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= join.percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return confirming


def _sets(size: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(t.as_py(), size).tobytes() for t in batch.column("text").cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.binary())], ["id", "set"])

    return sets


def pointed(forest: DataFrame) -> DataFrame:
    """(id, root) of a table (id, parent) in which parents are smaller: pointer jumping.

    A round doubles how far a pointer reaches; it ends when no parent has a parent.
    """
    forest = stored(forest, "forest")
    while True:
        above = forest.select(F.col("id").alias("parent"), F.col("parent").alias("grand"))
        jumped = stored(
            forest.join(above, "parent", "left").select(
                "id", F.coalesce("grand", "parent").alias("parent"), F.col("grand").isNotNull().alias("moved")
            ),
            "forest",
        )
        forest = jumped.select("id", "parent")
        if jumped.filter("moved").isEmpty():
            return forest.select("id", F.col("parent").alias("root"))


def components(links: DataFrame) -> DataFrame:
    """(id, root) for every id of ``links`` (a, b) that is not the smallest of its component.

    Each id hooks onto its smallest neighbour if that is smaller, trees are contracted, and links between
    different roots go into the next round. Every round with links left merges roots, and at least
    halves the roots that have links.
    """
    links = stored(links.select("a", "b").filter("a <> b"), "links")
    labels = None
    while not links.isEmpty():
        both = links.select(F.col("a").alias("id"), F.col("b").alias("to")).unionByName(
            links.select(F.col("b").alias("id"), F.col("a").alias("to"))
        )
        hooks = both.groupBy("id").agg(F.min("to").alias("parent")).filter("parent < id")
        roots = pointed(hooks)
        links = stored(relabelled(links, roots).filter("a <> b").distinct(), "links")
        if labels is None:
            labels = roots
        else:
            moved = labels.join(roots.select(F.col("id").alias("root"), F.col("root").alias("new")), "root", "left")
            labels = stored(
                moved.select("id", F.coalesce("new", "root").alias("root")).unionByName(roots), "labels"
            )
    return labels if labels is not None else links.select(F.col("a").alias("id"), F.col("b").alias("root"))


def relabelled(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """``pairs`` with both ends replaced by their roots; other columns stay."""
    for end in ("a", "b"):
        own = roots.select(F.col("id").alias(end), F.col("root").alias("new"))
        rest = [c for c in pairs.columns if c != end]
        pairs = pairs.join(own, end, "left").select(F.coalesce("new", end).alias(end), *rest)
    return pairs


def branches(leaders: DataFrame, join: Join) -> tuple[list[DataFrame], DataFrame | None]:
    """The small nodes of every level as rows (node, id), and the large ones of the last level."""
    small = []
    tokens = leaders.select("id", "tokens")
    rows = leaders.select("id", F.explode(F.array_distinct("nodes")).alias("node"))
    for level in range(1, join.depth + 1):
        counts = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        shared = stored(rows.join(counts, "node"), f"level-{level}")
        small.append(shared.filter(F.col("n") <= join.small).select("node", "id"))
        large = shared.filter(F.col("n") > join.small).select("node", "id")
        if level == join.depth:
            return small, large
        if large.isEmpty():
            return small, None
        going = large.groupBy("id").agg(F.collect_list("node").alias("nodes"))
        rows = going.join(tokens, "id").mapInArrow(_branch, "id long, node long").distinct()
    return small, None


def compared(rows: DataFrame, tokens: DataFrame, join: Join, roots: DataFrame | None = None) -> DataFrame:
    """What the small nodes (node, id) name: candidates (a, b, agree), a < b, and the nodes that have some.

    Without ``roots`` a node names one candidate per document; with them, all between different roots.
    """
    if roots is not None:
        rows = rows.join(roots, "id", "left").select("node", "id", F.coalesce("root", "id").alias("root"))
        several = rows.groupBy("node").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x < y")
        rows = rows.join(several.select("node"), "node", "left_semi")
    return (
        rows.join(tokens, "id")
        .repartition("node")
        .sortWithinPartitions("node")
        .mapInArrow(_compare_small(join, roots is not None), "a long, b long, agree long, node long")
    )


def _with_tokens(pairs: DataFrame, tokens: DataFrame, join: Join) -> DataFrame:
    for end in ("a", "b"):
        own = tokens.select(F.col("id").alias(end), F.col("tokens").alias(f"tokens_{end}"))
        pairs = pairs.join(own, end)
    return pairs.mapInArrow(_agreeing(join), "a long, b long, agree long")


def ring(large: DataFrame, tokens: DataFrame, join: Join) -> DataFrame:
    """Candidates of large last nodes: each document with a few that its hash picks out of the node.

    The documents of a node are dealt into slots by hash, about one per slot; a document meets those
    in its slot's successors. The slots split a node of any size.
    """
    sizes = large.groupBy("node").agg(F.count(F.lit(1)).alias("n"))
    slotted = large.join(sizes, "node").withColumn("slot", F.pmod(F.xxhash64("node", "id"), F.col("n")))
    to = slotted.select("node", F.col("id").alias("b"), "slot")
    reach = F.explode(F.sequence(F.lit(0), F.lit(join.ring - 1)))
    start = slotted.select("node", F.col("id").alias("a"), "n", "slot", reach.alias("step")).select(
        "node", "a", F.pmod(F.col("slot") + F.col("step"), F.col("n")).alias("slot")
    )
    pairs = start.join(to, ["node", "slot"]).filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return _with_tokens(pairs.distinct(), tokens, join)


def _compare_cells(join: Join):
    """Rows sorted by node and cell: confirmed links between components, enough to join them."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, []
        for batch in batches:
            names = ("node", "one", "other", "slot", "id", "root", "main", "nodes", "tokens", "set")
            for row in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if row[:3] != cell:
                    yield _ends(_joining(cell, held, join))
                    cell, held = row[:3], []
                held.append(row[3:])
        yield _ends(_joining(cell, held, join))

    return compare


def _joining(cell: tuple | None, rows: list[tuple], join: Join) -> list[tuple[int, int]]:
    """Links found in a cell: all pairs from slot one to slot other, unless they are joined already.

    A pair that shares several nodes is compared in the one of the smallest number.
    """
    if cell is None or len({r[2] for r in rows}) < 2:
        return []
    node, one, other = cell
    slots, roots = np.array([r[0] for r in rows]), [r[2] for r in rows]
    sketches, nodes = _nibbles([r[5] for r in rows]), [frozenset(r[4]) for r in rows]
    outside = np.array([r[2] != r[3] for r in rows])
    rooted = np.array(roots, np.int64)
    top = {r: r for r in roots}

    def find(x: int) -> int:
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    found = []
    for i in np.flatnonzero(outside).tolist():
        to = (slots == (other if slots[i] == one else one)) & (rooted != rooted[i])
        near = np.flatnonzero(to & ((sketches == sketches[i]).sum(axis=1) >= join.agreement))
        for k in near.tolist():
            if find(roots[i]) != find(roots[k]) and min(nodes[i] & nodes[k]) == node:
                x, y = (np.frombuffer(rows[j][6], np.uint64) for j in (i, k))
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= join.percent * (len(x) + len(y) - both):
                    found.append((rows[i][1], rows[k][1]))
                    top[find(roots[i])] = find(roots[k])
    return found


def _ends(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    flat = np.array(pairs, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], ["a", "b"])


def across(large: DataFrame, roots: DataFrame, tokens: DataFrame, sets: DataFrame, join: Join) -> DataFrame:
    """Confirmed links (a, b) between components that share a large last node.

    Nodes of one component need nothing. In the others the documents are dealt into slots of about
    ``cell`` and each pair of slots is compared in blocks, so no task holds more than two slots.
    Of a pair, one is outside the main component of the node, which has most of its documents.
    """
    labelled = large.join(roots, "id", "left").select("node", "id", F.coalesce("root", "id").alias("root"))
    counts = labelled.groupBy("node", "root").agg(F.count(F.lit(1)).alias("n"))
    main = counts.groupBy("node").agg(
        F.max_by("root", F.struct("n", "root")).alias("main"),
        F.count(F.lit(1)).alias("parts"),
        (1 + F.sum("n") / join.cell).cast("int").alias("slots"),
    )
    mixed = stored(labelled.join(main.filter("parts > 1"), "node"), "mixed")
    own = mixed.groupBy("id").agg(F.collect_list("node").alias("nodes"))
    carried = own.join(tokens, "id").join(sets, "id")
    cells = (
        mixed.withColumn("slot", F.pmod(F.xxhash64("node", "id"), F.col("slots")).cast("int"))
        .withColumn("met", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)))
        .withColumn("one", F.least("slot", "met"))
        .withColumn("other", F.greatest("slot", "met"))
        .join(carried, "id")
    )
    return (
        cells.select("node", "one", "other", "slot", "id", "root", "main", "nodes", "tokens", "set")
        .repartition("node", "one", "other")
        .sortWithinPartitions("node", "one", "other")
        .mapInArrow(_compare_cells(join), "a long, b long")
    )


def confirmed(pairs: DataFrame, sets: DataFrame, join: Join) -> DataFrame:
    """The pairs (a, b) that are linked, by their full sets."""
    for end in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("id").alias(end), F.col("set").alias(f"set_{end}")), end)
    return pairs.mapInArrow(_confirming(join), "a long, b long")


def links(documents: DataFrame, leaders: DataFrame, join: Join) -> DataFrame:
    """(id, root) of the leaders that are linked with a smaller one, directly or by others."""
    tokens = leaders.select("id", "tokens")
    small, large = branches(leaders, join)
    rows = functools.reduce(DataFrame.unionByName, small)
    named = stored(compared(rows, tokens, join), "named")
    found, met = named.filter("a is not null").drop("node"), named.filter("node is not null").select("node")
    if large is not None:
        found = found.unionByName(ring(large, tokens, join))
    # One row per document; all other candidates are met again between the trees that these give.
    best = found.groupBy("b").agg(F.max_by("a", F.struct("agree", -F.col("a"))).alias("a")).select("a", "b")
    best = stored(best, "candidates")
    ends = best.select(F.col("a").alias("id")).unionByName(best.select(F.col("b").alias("id")))
    ends = ends.unionByName(named.filter("b is not null").select(F.col("b").alias("id")))
    several = stored(rows.join(met, "node", "left_semi"), "several")
    if large is not None:
        ends = ends.unionByName(large.select("id"))
    # A class has the set of its first document; rows repeated of that give it again.
    wanted = leaders.select("id", "doc", "tag").join(ends.distinct(), "id", "left_semi")
    wanted = documents.select("doc", "tag", "text").join(wanted, ["doc", "tag"]).select("id", "text")
    sets = stored(wanted.mapInArrow(_sets(join.shingle), "id long, set binary").distinct(), "sets")
    forest = confirmed(best, sets, join).select(F.col("b").alias("id"), F.col("a").alias("parent"))
    roots = pointed(forest)
    left = compared(several, tokens, join, roots).select("a", "b").distinct()
    roots = joined_by(stored(left, "crossing"), roots, sets, join)
    if large is not None:
        roots = merged(roots, across(large, roots, tokens, sets, join))
    return roots


def joined_by(pairs: DataFrame, roots: DataFrame, sets: DataFrame, join: Join) -> DataFrame:
    """``roots`` after confirming those of ``pairs`` that lead from one component to another."""
    ends = pairs.select("a", "b", F.col("a").alias("x"), F.col("b").alias("y"))
    crossing = relabelled(ends, roots).filter("a <> b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    return merged(roots, confirmed(crossing.distinct(), sets, join))


def merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` after joining the components that confirmed links lead between."""
    tops = components(relabelled(links, roots))
    moved = roots.join(tops.select(F.col("id").alias("root"), F.col("root").alias("new")), "root", "left")
    return stored(moved.select("id", F.coalesce("new", "root").alias("root")).unionByName(tops), "roots")


def near_duplicates(
    documents: DataFrame, key: str = "doc_id", text: str = "text", join: Join | None = None
) -> DataFrame:
    """One row per row: the key, ``n_shingles``, ``component_id`` and ``kept``, true if that is the key's own."""
    join = join or Join()
    found = verdicts(_keyed(documents, F.col(key), text_of(text)), join)

    def outside(c: str):
        return F.expr(f"nullif({c}, {_NULL_ID})")

    kept = F.col("doc") == F.col("component")
    return found.select(
        outside("doc").alias(key), "n_shingles", outside("component").alias("component_id"), kept.alias("kept")
    )


def _keyed(documents: DataFrame, key: Column, text: Column, *more: Column) -> DataFrame:
    """``doc`` and ``tag``, the digest of the text, which tell documents apart, then the text."""
    narrow = documents.select(F.coalesce(key.cast("long"), F.lit(_NULL_ID)).alias("doc"), text.alias("text"), *more)
    return narrow.withColumn("tag", F.md5("text"))


def verdicts(narrow: DataFrame, join: Join) -> DataFrame:
    """One row per row of ``narrow`` (doc, tag, text): doc, tag, ``n_shingles``, ``component`` and ``kept``.

    Of a component one row is kept: one of the first doc, tag. Rows are numbered as they are written, so
    equal rows differ in their number only, and the first is found by partial aggregation.
    """
    # The keys go around Python as they are only columns of the row.
    survey = narrow.mapInArrow(
        _tagged(_survey(join)),
        "n_shingles long, class binary, tokens binary, nodes array<long>, doc long, tag string",
    )
    survey = stored(survey.withColumn("row", F.monotonically_increasing_id()), "survey")
    filled = survey.filter("n_shingles > 0")
    first = filled.groupBy("class").agg(F.min(F.struct("doc", "tag", "row")).alias("first"))
    # Classes get a number of their own: a doc may lead several, and digests are longer than a vertex.
    classes = stored(first.withColumn("id", F.monotonically_increasing_id()), "classes")
    own = filled.select("class", "tokens", "nodes").dropDuplicates(["class"])
    leaders = stored(
        own.join(classes, "class").select("id", "first.doc", "first.tag", "tokens", "nodes"), "leaders"
    )
    roots = links(narrow, leaders, join)
    members = classes.join(roots, "id", "left").select("class", F.coalesce("root", "id").alias("root"), "first")
    heads = members.groupBy("root").agg(F.min("first").alias("head"))
    placed = members.join(heads, "root").select("class", "head")
    linked = filled.join(placed, "class").select(
        "doc", "tag", "n_shingles", F.col("head.doc").alias("component"), (F.col("row") == F.col("head.row")).alias("kept")
    )
    bare = survey.filter("n_shingles = 0").select("doc", "tag", "n_shingles", "row")
    alone = bare.groupBy("doc", "tag").agg(F.min("row").alias("row")).select("row", F.lit(True).alias("kept"))
    unlinked = bare.join(alone, "row", "left").select(
        "doc", "tag", "n_shingles", F.col("doc").alias("component"), F.coalesce("kept", F.lit(False)).alias("kept")
    )
    return linked.unionByName(unlinked)


def _tagged(work):
    def tagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for done in work(iter([batch])):
                yield pa.RecordBatch.from_arrays(
                    [*done.columns, batch.column("doc"), batch.column("tag")], [*done.schema.names, "doc", "tag"]
                )

    return tagged


def keep_first(documents: DataFrame, key: str = "doc_id", text: str = "text", join: Join | None = None) -> DataFrame:
    """The documents that stand for their component, one row for each, with their columns as they were.

    Of rows with the same key and text that differ in other columns, the one of the smallest hash stays.
    """
    found = verdicts(_keyed(documents, F.col(key), text_of(text)), join or Join())
    kept = found.filter("kept").select("doc", "tag")
    # Rows that repeat a document meet in partial aggregations, before they are dealt by document.
    rows = packed(documents, F.col(key).alias("key"), text_of(text).alias("text"))
    rows = _keyed(rows, F.col("key"), F.col("text"), F.col("row")).drop("text")
    rows = rows.groupBy("doc", "tag").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
    return rows.join(kept, ["doc", "tag"], "left_semi").select("row.*")
