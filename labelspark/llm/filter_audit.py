"""How the filters of a corpus act on each other: every order of five filters, audited from one pass over the texts.

What a document adds to an audit hangs on its mask alone: which filters it fails, and whether it is labelled good or toxic.
Each mask is mapped to one big integer with a field of 64 bits for every outcome of all 600 steps (120 orders of five filters).
The integers of a part are added up, a mask that n documents share n times; as no field can exceed the number of documents,
which is below 2**63, no field ever runs over into the next, and the sum is unpacked into the counts of all steps at once.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILTERS = "ABCDE"
ORDERS = ["".join(order) for order in permutations(FILTERS)]
STEPS = [(order, step) for order in ORDERS for step in range(1, len(FILTERS) + 1)]
OUTCOMES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
FIELD = 64

#: Bits of a mask: one per filter failed, then the two labels.
GOOD, TOXIC = 1 << len(FILTERS), 2 << len(FILTERS)
COPY = 1 << FILTERS.index("E")

# The limits of the filters.
LEAST_WORDS, DISTINCT_OF_100, CAPITALS_OF_100 = 200, 50, 3
SIGNS = re.compile(rb"[#$%&*|]")
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
INNER_BYTES = bytes(range(0x80, 0xC0))

SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{o} bigint" for o in (*OUTCOMES, "shapley"))


def failed(text: bytes) -> int:
    """The mask of the filters A to D that a text fails; `bytes.split` parts at the six ASCII blanks."""
    words = text.split()
    few = len(words) < LEAST_WORDS
    repeated = 100 * len(set(words)) < DISTINCT_OF_100 * len(words)
    capitals = len(text) - len(text.translate(None, CAPITALS))
    loud = 100 * capitals > CAPITALS_OF_100 * len(text.translate(None, INNER_BYTES))
    return few | repeated << 1 | loud << 2 | (SIGNS.search(text) is not None) << 3


def outcomes(mask: int) -> Iterator[tuple[int, ...]]:
    """For each of `STEPS`, what a document of this mask adds to each of `OUTCOMES`."""
    fails = mask & (GOOD - 1)
    good, toxic = bool(mask & GOOD), bool(mask & TOXIC)
    for order in ORDERS:
        inside = True
        for name in order:
            bit = 1 << FILTERS.index(name)
            here = inside and bool(fails & bit)
            gone = not inside and bool(fails & bit)
            inside = inside and not here
            yield int(inside), int(here), int(gone), int(fails == bit), int(here and good), int(here and toxic)


def packed(mask: int) -> int:
    """The big integer of a mask: 64 bits for each outcome of each step."""
    fields = np.fromiter((v for step in outcomes(mask) for v in step), "<u8", len(STEPS) * len(OUTCOMES))
    return int.from_bytes(fields.tobytes(), "little")


def unpacked(total: int) -> np.ndarray:
    """One row per step and one column per outcome."""
    size = len(STEPS) * len(OUTCOMES) * FIELD // 8
    return np.frombuffer(total.to_bytes(size, "little"), "<u8").reshape(len(STEPS), len(OUTCOMES)).astype("int64")


def report(part: str, masks: list[int], counts: list[int]) -> pd.DataFrame:
    """All steps of one part, given how many documents have each mask."""
    counted = unpacked(sum(packed(m) * n for m, n in zip(masks, counts, strict=True)))
    rows = pd.DataFrame(STEPS, columns=["filter_order", "step"])
    rows["step"] = rows["step"].astype("int32")
    rows.insert(0, "part", part)
    for i, name in enumerate(OUTCOMES):
        rows[name] = counted[:, i]
    letters = [order[step - 1] for order, step in STEPS]
    rows["shapley"] = rows["removed"].groupby(letters).transform("sum")
    return rows


def masks(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
) -> DataFrame:
    """doc_id, part, mask, n: how many rows of this id and part have this mask.

    Filter E looks for the same text (by a digest of 128 bits) under a smaller id anywhere in the table. Rows are first put together by
    digest and id, then each digest keeps its smallest id; so that copies, however many, are never brought together in one
    place. Rows that share the smallest id are no copies of a smaller one; a row without an id is neither a copy nor an original.
    An id that is labelled more than once is good (toxic) if one of its labels says so.
    """

    def facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2)
            found = ((failed(t), hashlib.blake2b(t, digest_size=16).digest()) for t in (v.as_py() for v in texts))
            mask, digest = zip(*found, strict=True) if batch.num_rows else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(mask, pa.int32()), pa.array(digest, pa.binary())],
                names=["doc_id", "part", "mask", "digest"],
            )

    text = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("text")
    part = F.coalesce(F.col(f"`{part_col}`"), F.lit("")).alias("part")
    named = docs.select(F.col(f"`{id_col}`").alias("doc_id"), part, text)
    kind = named.schema["doc_id"].dataType.simpleString()
    rows = named.mapInArrow(facts, f"doc_id {kind}, part string, mask int, digest binary NOT NULL")
    rows = rows.groupBy("digest", "doc_id", "part", "mask").agg(F.count("*").alias("n"))
    # The smallest row is taken with all its columns and a digest is never null, so that both sides of the join need the same
    # rows and Spark reads the texts and shuffles their facts once for both.
    least = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "part", "mask", "n")))
    first = rows.groupBy("digest").agg(least.alias("least"))
    first = first.select("digest", F.col("least.doc_id").alias("doc_id"), (F.col("least.n") > 0).alias("first"))
    copy = F.col("first").isNull() & F.col("doc_id").isNotNull()
    marked = rows.join(first, ["digest", "doc_id"], "left").withColumn("copy", copy)
    said = labels.groupBy(F.col("doc_id").alias("doc_id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )

    def bit(condition: Column, value: int) -> Column:
        return F.when(condition, value).otherwise(0)

    mask = F.col("mask") + bit(F.col("copy"), COPY) + bit(F.col("good"), GOOD) + bit(F.col("toxic"), TOXIC)
    return marked.join(said, "doc_id", "left").select("doc_id", "part", mask.alias("mask"), "n")


def audit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
) -> DataFrame:
    """One row per part, order of the five filters and step, with what the step did to the documents of the part.

    A part is a value of ``part_col``; null and the empty string are one part, the empty string. A null text is an empty one, which
    fails A only. Repeated rows count as often as they stand there. A table without rows has no parts and so no rows. Other columns of
    either table are not looked at. ``labels`` has doc_id, quality and toxic; a document without labels, or with null ones, is neither good nor toxic.

    Masks are counted before they are shuffled, at most 128 rows per part; the sum of a part's integers is made from these.
    """
    counted = masks(docs, labels, id_col=id_col, text_col=text_col, part_col=part_col)
    few = counted.groupBy("part", "mask").agg(F.sum("n").alias("n"))

    def sums(rows: pd.DataFrame) -> pd.DataFrame:
        return report(rows["part"].iloc[0], rows["mask"].tolist(), rows["n"].tolist())

    return few.groupBy("part").applyInPandas(sums, SCHEMA)


def oracle() -> str:
    """The same in DuckDB: every document at every step of every order."""
    words = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"
    fails = " UNION ALL ".join(f"SELECT doc_id, part, good, toxic, '{f}' AS filter FROM d WHERE {f.lower()}" for f in FILTERS)
    return f"""WITH RECURSIVE t AS (
      SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
    w AS (SELECT *, {words} AS words FROM t),
    l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY 1),
    f AS (SELECT text, min(doc_id) AS least FROM t GROUP BY 1),
    d AS (SELECT w.doc_id, part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
        len(words) < {LEAST_WORDS} AS a, 100 * list_unique(words) < {DISTINCT_OF_100} * len(words) AS b,
        100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > {CAPITALS_OF_100} * length(text) AS c,
        regexp_matches(text, '[#$%&*|]') AS d, coalesce(w.doc_id > least, false) AS e
      FROM w JOIN f USING (text) LEFT JOIN l ON w.doc_id = l.doc_id),
    o AS (SELECT '' AS filter_order UNION ALL
      SELECT filter_order || x FROM o, unnest(['A', 'B', 'C', 'D', 'E']) u(x) WHERE NOT contains(filter_order, x)),
    s AS (SELECT filter_order, step::INT AS step, substr(filter_order, step::INT, 1) AS filter
      FROM o, range(1, 6) r(step) WHERE length(filter_order) = 5),
    x AS ({fails}),
    m AS (SELECT part, good, toxic, coalesce(string_agg(filter, '' ORDER BY filter), '') AS mask FROM (
        SELECT d.*, x.filter FROM d LEFT JOIN x ON d.doc_id = x.doc_id) GROUP BY doc_id, part, good, toxic),
    n AS (SELECT part, good, toxic, mask, count(*) AS n FROM m GROUP BY ALL),
    h AS (SELECT part, filter_order, step, filter, good, toxic, n, mask, contains(mask, filter) AS fails,
        len(list_filter(string_split(substr(filter_order, 1, step - 1), ''), lambda f: f <> '' AND contains(mask, f))) > 0 AS gone
      FROM n, s),
    r AS (SELECT part, filter_order, step, filter,
        coalesce(sum(n) FILTER (WHERE NOT gone AND NOT fails), 0)::BIGINT AS kept,
        coalesce(sum(n) FILTER (WHERE NOT gone AND fails), 0)::BIGINT AS removed,
        coalesce(sum(n) FILTER (WHERE gone AND fails), 0)::BIGINT AS redundant,
        coalesce(sum(n) FILTER (WHERE mask = filter), 0)::BIGINT AS unique_fails,
        coalesce(sum(n) FILTER (WHERE NOT gone AND fails AND good = 1), 0)::BIGINT AS good_lost,
        coalesce(sum(n) FILTER (WHERE NOT gone AND fails AND toxic = 1), 0)::BIGINT AS toxic_lost
      FROM h GROUP BY ALL)
    SELECT * EXCLUDE (filter), (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley FROM r"""
