"""Near duplicates by SimHash: fingerprints, links within a few bits by BK-trees, connected groups.

Fingerprints that differ in at most r of 64 bits agree in all bits of at least k - r of k blocks of bits. So every
fingerprint goes to one shard per choice of k - r blocks, named by their bits, and the shards together show each
linked pair at least once. A shard is a BK-tree that is searched with the shard's own fingerprints, following only
edges within the radius. Where one shard would be large, its fingerprints are dealt to several trees of bounded
size and the shard's fingerprints are sent to each of these trees, in blocks, so that no task holds a whole shard.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelspark.llm.bktree import Forest, Labels
from labelspark.llm.common import cut, keyed, map_text
from labelspark.llm.components import components, sendable

SHINGLE = 4
RADIUS = 4
SEED = 42
#: Rows of one BK-tree of a shard that is split.
TREE_ROWS = 8192
#: Rows that a task gathers before it builds trees.
GATHERED = 65_536
HASHES = 65_536


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of the word shingles of a whole text; zero if it has no word."""
    words = text.encode().lower().split()  # of bytes: only A-Z change, only ASCII blanks part words
    if not words:
        return 0
    line = b" ".join(words)
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32).tolist()
    starts, ends = [0, *(g + 1 for g in gaps)], [*gaps, len(line)]
    ends = ends[shingle - 1 :] or [len(line)]
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(ends), HASHES):
        spans = zip(starts[at : at + HASHES], ends[at : at + HASHES], strict=False)
        found = np.array([digest(line[s:e], SEED) for s, e in spans], np.uint64)
        ones += np.unpackbits(found.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(ends), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, more: bool = False) -> DataFrame:
    """doc_id and fp (the bits as a signed long) of each row; with ``more`` also text_hash, a hash of the text."""
    named = keyed(docs, id_col, text_col)
    kind = named.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, fp bigint" + ", text_hash bigint" * more

    def rows_of(ids: list, texts: list) -> list[list]:
        own = [[xxhash.xxh64(t.encode(), seed=SEED).intdigest() for t in texts]] if more else []
        signed = [np.array(x, np.uint64).view(np.int64) for x in own]
        return [ids, [fingerprint(t, shingle) for t in texts], *signed]

    return map_text(named, schema, rows_of, "doc_id", "text")


def masks(radius: int, blocks: int) -> list[int]:
    """For each choice of ``blocks - radius`` blocks of bits, a signed long that has these bits set."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    block = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    return [int(np.uint64(sum(c)).view(np.int64)) for c in combinations(block, blocks - radius)]


def blocks_for(rows: int, radius: int) -> int:
    """The fewest blocks with which shards of evenly spread fingerprints hold some tens of rows."""
    blocks = radius + 1
    while blocks < 2 * radius and rows >> (64 * (blocks - radius) // blocks) > 16:
        blocks += 1
    return blocks


def linked(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Stars that join what is linked within each tree; rows come by tree, its own points before other queries."""
    held: list[np.ndarray] = []

    def found(rows: np.ndarray) -> pa.RecordBatch:
        tree, fp, role = rows
        points = role != 1
        order = np.flatnonzero(points)
        forest = Forest(tree[order], fp[order].view(np.uint64))
        asks = np.flatnonzero(role != 2)
        names, at = np.unique(fp, return_inverse=True)
        sets = Labels(len(names))
        for query, point in forest.within(tree[asks], fp[asks].view(np.uint64), radius):
            sets.unite(at[asks[query]], at[order[point]])
        joined = np.flatnonzero(sets.of != np.arange(len(names)))
        return pa.RecordBatch.from_pydict({"a": names[joined], "b": names[sets.of[joined]]})

    for batch in batches:
        held.append(np.array([batch.column(i).to_numpy() for i in range(3)]))
        if sum(h.shape[1] for h in held) < GATHERED:
            continue
        rows = np.concatenate(held, axis=1)
        last = np.searchsorted(rows[0] == rows[0, -1], True)  # of a sorted column: where the last tree begins
        if last:
            yield found(rows[:, :last])
        rest = rows[:, last:]
        if rest.shape[1] >= GATHERED:  # a tree with many queries: go on with its points alone
            yield found(rest)
            rest = rest[:, rest[2] != 1].copy()
            rest[2] = 2
        held = [rest]
    if held:
        yield found(np.concatenate(held, axis=1))


def links(points: DataFrame, *, radius: int = RADIUS, blocks: int | None = None, tree_rows: int = TREE_ROWS) -> DataFrame:
    """Links ``a``, ``b`` that join the same fingerprints as all pairs at most ``radius`` bits apart would.

    ``points`` has distinct ``fp``. At most one link per fingerprint, tree and batch is made, never all pairs of a group.
    """
    blocks = blocks or blocks_for(points.count(), radius)
    choices = F.array(*[F.struct(F.lit(i).alias("choice"), F.lit(m).alias("mask")) for i, m in enumerate(masks(radius, blocks))])
    dealt = points.select("fp", F.explode(choices).alias("m")).select(
        F.xxhash64("m.choice", F.col("fp").bitwiseAND(F.col("m.mask"))).alias("shard"), "fp"
    )
    # Unlike bits with a like hash only share a tree; distances decide.
    large = cut(dealt.groupBy("shard").count().filter(F.col("count") > tree_rows))
    if large.isEmpty():
        trees = dealt.select(F.col("shard").alias("tree"), "fp", F.lit(0).alias("role"))
    else:
        trees = split(dealt, large, tree_rows)
    trees = trees.repartition("tree").sortWithinPartitions("tree", "role")
    pairs = trees.select("tree", "fp", F.col("role").cast("bigint").alias("role")).mapInArrow(
        lambda batches: linked(batches, radius), "a bigint, b bigint"
    )
    return pairs


def split(dealt: DataFrame, large: DataFrame, tree_rows: int) -> DataFrame:
    """Deal the fingerprints of large shards to trees; each asks its own tree and the half of the others after it."""
    trees = F.ceil(F.col("count") / tree_rows).cast("int")
    own = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("trees")).cast("int")
    rows = dealt.join(large.withColumn("trees", trees).drop("count"), "shard", "left").withColumns(
        {"trees": F.coalesce("trees", F.lit(1)), "own": F.coalesce(own, F.lit(0))}
    )
    asked = rows.withColumn("step", F.explode(F.sequence(F.lit(0), F.floor(F.col("trees") / 2).cast("int"))))
    tree = F.when(F.col("trees") == 1, F.col("shard")).otherwise(
        F.xxhash64("shard", F.pmod(F.col("own") + F.col("step"), F.col("trees")))
    )
    return asked.select(tree.alias("tree"), "fp", F.when(F.col("step") == 0, 0).otherwise(1).alias("role"))


def grouped(prints: DataFrame, pick: Column, *, radius: int = RADIUS) -> DataFrame:
    """fp, picked: the least ``pick`` among the rows whose fingerprints can be reached by links.

    ``prints`` is read several times; give it with its lineage cut. Null picks come last.
    """
    points = prints.groupBy("fp").agg(F.min(pick).alias("least"))
    roots, rows = components(links(points.select("fp"), radius=radius))
    roots = sendable(roots, rows)
    joined = points.join(roots, points["fp"] == roots["node"], "left").withColumn("root", F.coalesce("root", "fp"))
    # Only linked fingerprints share; their roots hold one row each.
    linked_roots = roots.select("root").distinct()
    of_root = joined.join(sendable(linked_roots, rows), "root", "left_semi").groupBy("root").agg(F.min("least").alias("shared"))
    found = joined.join(sendable(of_root, rows), "root", "left")
    return cut(found.select("fp", F.coalesce("shared", "least").alias("picked")))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest id in its group) for each row.

    Null and empty texts have the fingerprint zero and are linked like any other. Repeated rows stay; a null id gets
    the smallest id of its group, null if there is none. An empty table gives no rows.
    """
    prints = cut(fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle))
    groups = grouped(prints, F.col("doc_id"), radius=radius)
    return prints.join(groups, "fp").select(
        "doc_id", hex16(F.col("fp")).alias("fingerprint"), F.col("picked").alias("component_id")
    )


def deduplicated(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of each group of near duplicates, with all its columns: that of the smallest id, null ids last.

    Of rows that repeat id and text one stays, an arbitrary one if their other columns differ.
    """
    prints = cut(fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle, more=True))
    pick = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    groups = grouped(prints, pick, radius=radius).select("picked.doc_id", "picked.text_hash").distinct()
    same = prints.groupBy("doc_id", "text_hash").count()
    keep = cut(
        groups.alias("g")
        .join(same.alias("s"), F.col("g.text_hash").eqNullSafe(F.col("s.text_hash")) & F.col("g.doc_id").eqNullSafe(F.col("s.doc_id")))
        .select(F.col("g.doc_id").alias("kept_id"), F.col("g.text_hash").alias("kept_hash"), "count")
    )
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col(f"`{id_col}`").alias("own_id"),
        F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("own_hash"),
    )
    found = rows.join(keep, F.col("own_id").eqNullSafe(F.col("kept_id")) & (F.col("own_hash") == F.col("kept_hash")))
    single = found.filter("count = 1").select("row.*")
    if keep.filter("count > 1").isEmpty():
        return single
    repeated = found.filter("count > 1").groupBy("kept_id", "kept_hash").agg(F.first("row").alias("row"))
    return single.unionByName(repeated.select("row.*"))


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
