"""Document fingerprints by winnowing.

Every run of ``gram`` code points is hashed by a rolling polynomial. Of each window of ``window`` hashes in a row the least is
kept, of equal ones the rightmost, with its position. Two texts that share a passage of at least
``window + gram - 1`` code points therefore keep at least one common hash, and the positions show where.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelspark.llm.common import keyed, map_text, slices

GRAM = 16
WINDOW = 16
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
MIX = np.uint64(0xBF58476D1CE4E5B9)
#: Blocks of ids; the driver holds one id per block. More rows make longer blocks, which are sorted on disk where need be.
MOST_BLOCKS = 4096


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def rolled(points: np.ndarray, gram: int) -> np.ndarray:
    """Hash of every run of ``gram`` code points; of the whole text if that is shorter.

    Runs are put together from runs of half the length, h(i, a + b) = h(i, a) * B^b + h(i + a, b), modulo 2^64.
    """
    gram = min(gram, len(points))
    if not gram:
        return np.zeros(0, np.uint64)
    whole, length, power = points.astype(np.uint64) + np.uint64(1), 1, BASE
    for bit in bin(gram)[3:]:
        whole = whole[:-length] * power + whole[length:]
        length, power = 2 * length, power * power
        if bit == "1":
            whole = whole[:-1] * BASE + points[length:].astype(np.uint64) + np.uint64(1)
            length, power = length + 1, power * BASE
    whole = (whole ^ (whole >> np.uint64(31))) * MIX
    return whole ^ (whole >> np.uint64(29))


def least(hashes: np.ndarray, window: int) -> np.ndarray:
    """Positions of the least hash of each window, rightmost among equals, each position once."""
    if not len(hashes):
        return np.zeros(0, np.int64)
    window = min(window, len(hashes))
    place, width = np.arange(len(hashes)), 1
    while width < window:
        step = min(width, window - width)
        left, right = place[:-step], place[step:]
        place = np.where(hashes[right] <= hashes[left], right, left)
        width += step
    return place[np.r_[True, place[1:] != place[:-1]]]


def winnow(points: np.ndarray, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Positions (of a run's first code point) and hashes that are kept, in order; none for an empty text."""
    with np.errstate(over="ignore"):
        hashes = rolled(points, gram)
    kept = least(hashes, window)
    return kept, hashes[kept]


def digest(kept: tuple[np.ndarray, np.ndarray]) -> str:
    """32 hex digits of all kept positions and hashes."""
    return xxhash.xxh3_128_hexdigest(kept[0].astype("<i8").tobytes() + kept[1].astype("<u8").tobytes())


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Shared among all distinct hashes, from 0 to 1; two empty fingerprints are alike."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared)


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """doc_id, positions and hashes (arrays of long) of each whole text; null and empty texts have none."""
    named = keyed(docs, id_col, text_col)
    kind = named.schema["doc_id"].dataType.simpleString()

    def rows_of(ids: list, texts: list) -> list[list]:
        kept = [winnow(code_points(t), gram, window) for t in texts]
        return [ids, [k[0] for k in kept], [k[1].view(np.int64) for k in kept]]

    return map_text(named, f"doc_id {kind}, positions array<bigint>, hashes array<bigint>", rows_of, "doc_id", "text")


def place(value: Column, bounds: list[int]) -> Column:
    """How many of the ascending bounds are at most the value, by halving; a null value has place 0."""
    if not bounds:
        return F.lit(0)
    steps = [1 << b for b in reversed(range(len(bounds).bit_length()))]
    table = F.expr(f"array({', '.join(map(str, bounds))})")
    found = F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, step: F.when(F.coalesce(F.get(table, at + step - 1) <= value, F.lit(False)), at + step).otherwise(at),
    )
    return F.coalesce(found, F.lit(0))


def blocks_of(docs: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """The rows with a ``block`` of some ``rows`` ids in order, and those that follow the end of each block.

    The first document of all follows the last block. Where a block starts with several rows of one id, the least by
    length and hash follows. What is read for this are the ids alone, and the texts of one row per block.
    """
    total = docs.count()
    count = min(MOST_BLOCKS, max(1, -(-total // rows)))
    shares = [i / count for i in range(1, count)]
    cuts = docs.agg(F.percentile_approx("doc_id", shares, 100 * count)).first()[0] if shares else None
    cuts = sorted(set(cuts or []))
    placed = docs.withColumn("block", place(F.col("doc_id"), cuts))
    heads = placed.groupBy("block").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("has_id"), "doc_id")).alias("first"))
    heads = sorted((r["block"], r["first"]["doc_id"]) for r in heads.collect()) if total else []
    next_id = {block: heads[(i + 1) % len(heads)][1] for i, (block, _) in enumerate(heads)}
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    after = spark.createDataFrame([(b, i) for b, i in next_id.items()], f"after_block int, after_id {kind}")
    ends = docs.join(F.broadcast(after), F.col("doc_id").eqNullSafe(F.col("after_id")))
    return placed, ends.drop("after_id").withColumnRenamed("after_block", "block").select(*placed.columns)


def compared(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    gram: int = GRAM,
    window: int = WINDOW,
    block_rows: int = 2000,
) -> DataFrame:
    """Each text beside its edited text and beside the next document's, by ascending id.

    The edited text has the last quarter of its code points replaced by as many, or all, of the first ones of the next
    document; the first document follows the last. Rows of one id follow by length and hash of their texts, null ids come
    first; a table of one row follows itself. Texts are shuffled once, to blocks of ids in order.
    """
    named = keyed(docs, id_col, text_col)
    kind = named.schema["doc_id"].dataType.simpleString()
    placed, ends = blocks_of(named, block_rows)
    own = placed.withColumn("is_end", F.lit(0))
    both = own.unionByName(ends.withColumn("is_end", F.lit(1)))
    walk = (
        both.repartition("block")
        .sortWithinPartitions("block", "is_end", "doc_id", F.length("text"), F.xxhash64("text"))
        .select("block", "is_end", "doc_id", "text")
    )

    def row(before: tuple, after: tuple) -> tuple:
        doc_id, points, kept = before
        quarter = len(points) // 4
        edited = np.concatenate([points[: len(points) - quarter], after[1][:quarter]])
        changed = winnow(edited, gram, window)
        marks = np.unique(kept[1])
        return (
            doc_id,
            len(points),
            hashlib.sha256(edited.tobytes().decode("utf-32-le").encode()).hexdigest(),
            digest(kept),
            digest(changed),
            likeness(marks, np.unique(changed[1])),
            likeness(marks, np.unique(after[2][1])),
        )

    schema = f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    names = to_arrow_schema(T._parse_datatype_string(schema))

    def run(batches):
        before, of_block = None, None
        for batch in batches:
            for part in slices(batch, 500):
                out = []
                for block, is_end, doc_id, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    if block != of_block:
                        before, of_block = None, block
                    elif is_end and before is None:
                        continue
                    points = code_points(text)
                    current = (doc_id, points, winnow(points, gram, window))
                    if before is not None:
                        out.append(row(before, current))
                    before = None if is_end else current
                columns = list(zip(*out, strict=True)) if out else [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, names, strict=True)], schema=names)

    return walk.mapInArrow(run, schema)
