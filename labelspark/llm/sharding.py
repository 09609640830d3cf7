"""Shards of bounded size by extendible hashing.

Documents are hashed to 60 bits. A bucket is a prefix of these bits; it starts as the empty prefix, and only a bucket over the
byte limit splits on its next bit. The shards are the buckets that are left, and the directory maps each prefix of
the greatest depth to its shard. Sizes of all prefixes come from one aggregation over cells that are far smaller than a
shard, so no splitting step reads the documents anew.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelspark.llm.common import cut

BITS = 60
#: Cells per expected shard, as a power of two; more bits are looked at where they don't do.
FINER = 6
LIMIT = 1 << 20


def sized(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n_bytes, copy, h: rows that repeat id and size are counted, numbered and so hashed apart."""
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.coalesce(F.octet_length(F.col(f"`{text_col}`")), F.lit(0)).cast("bigint").alias("n_bytes"),
    )
    numbered = rows.groupBy("doc_id", "n_bytes").count().withColumn("copy", F.explode(F.expr("sequence(1L, count)"))).drop("count")
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "n_bytes", "copy")
    return numbered.withColumn("h", F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("bigint"))


def prefix(h: Column, depth: Column | int, of: int = BITS) -> Column:
    """The first ``depth`` of the ``of`` bits of h, as a number."""
    return F.call_function("shiftright", h, (F.lit(of) - depth).cast("int"))


def assign(docs: DataFrame, *, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, copy, shard (its bits as text), depth, shard_bytes, shard_docs for each row.

    A shard has at most ``limit`` bytes of text, or one document that is larger. Null texts have no bytes; rows that repeat
    an id are numbered by ``copy`` and may part. An empty table has no shards.
    """
    rows = cut(sized(docs, id_col, text_col))
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    low, high, done = 0, min(BITS, max(0, math.ceil(math.log2(max(1, total) / limit))) + FINER), []
    while True:
        cells = rows.groupBy(prefix(F.col("h"), high).alias("cell")).agg(F.sum("n_bytes").alias("b"), F.count("*").alias("n"))
        by_depth = (
            cells.withColumn("depth", F.explode(F.sequence(F.lit(low), F.lit(high))))
            .groupBy("depth", prefix(F.col("cell"), F.col("depth"), high).alias("bits"))
            .agg(F.sum("b").alias("shard_bytes"), F.sum("n").alias("shard_docs"))
        )
        fits = (F.col("shard_bytes") <= limit) | (F.col("shard_docs") == 1) | (F.col("depth") == BITS)
        buckets = cut(by_depth.withColumn("fits", fits))
        over = buckets.filter(~F.col("fits"))
        parents = over.select((F.col("depth") + 1).alias("depth"), F.col("bits").alias("parent"))
        leaves = (
            buckets.filter("fits AND depth > 0")
            .withColumn("parent", F.shiftright("bits", 1))
            .join(parents, ["depth", "parent"], "left_semi")
            .select("depth", "bits", "shard_bytes", "shard_docs")
        )
        if low == 0:
            leaves = leaves.unionByName(buckets.filter("fits AND depth = 0").select(*leaves.columns))
        ways = (
            cells.select("cell", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth"))
            .withColumn("bits", prefix(F.col("cell"), F.col("depth"), high))
            .join(leaves, ["depth", "bits"])
        )
        shard = F.when(F.col("depth") == 0, "").otherwise(F.expr("lpad(bin(bits), depth, '0')"))
        placed = rows.withColumn("cell", prefix(F.col("h"), high)).join(cut(ways), "cell")
        done.append(placed.select("doc_id", "n_bytes", "copy", shard.alias("shard"), "depth", "shard_bytes", "shard_docs"))
        deeper = over.filter(F.col("depth") == high).select(F.col("bits").alias("cell"))
        if deeper.isEmpty():
            break
        rows = cut(rows.withColumn("cell", prefix(F.col("h"), high)).join(deeper, "cell", "left_semi").drop("cell"))
        low, high = high, min(BITS, high + 8)
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    return found


def directory(assigned: DataFrame) -> DataFrame:
    """shard, depth, first and last: the range of global-depth prefixes (as numbers) that lead to each shard."""
    shards = assigned.select("shard", "depth").distinct()
    deepest = shards.agg(F.max("depth")).first()[0] or 0
    own = F.coalesce(F.conv(F.col("shard"), 2, 10).cast("bigint"), F.lit(0))
    first = F.call_function("shiftleft", own, (F.lit(deepest) - F.col("depth")).cast("int"))
    width = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.lit(deepest) - F.col("depth")).cast("int"))
    return shards.select("shard", "depth", first.alias("first"), (first + width - 1).alias("last"))


def write(docs: DataFrame, assigned: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> None:
    """The documents, with all their columns, as Parquet below ``path`` with one folder per shard."""
    from pyspark.sql import Window

    size = F.coalesce(F.octet_length(F.col(f"row.`{text_col}`")), F.lit(0)).cast("bigint")
    rows = docs.select(F.struct("*").alias("row")).select("row", F.col(f"row.`{id_col}`").alias("own_id"), size.alias("own_size"))
    numbered = rows.withColumn("own_copy", F.row_number().over(Window.partitionBy("own_id", "own_size").orderBy("own_id")))
    same = (
        F.col("own_id").eqNullSafe(F.col("doc_id"))
        & (F.col("own_size") == F.col("n_bytes"))
        & (F.col("own_copy") == F.col("copy"))
    )
    placed = numbered.join(assigned.select("doc_id", "n_bytes", "copy", F.col("shard").alias("shard_bits")), same)
    out = placed.select("row", F.concat(F.lit("b"), "shard_bits").alias("shard_folder")).repartition("shard_folder")
    out.write.partitionBy("shard_folder").parquet(path)


def oracle(limit: int = LIMIT) -> str:
    """DuckDB's form of the registered query."""
    return f"""
WITH rows_ AS (
    SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes FROM documents
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id, n_bytes) AS copy FROM rows_
), hashed AS (
    SELECT *, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || n_bytes || ':' || copy), 1, 15) AS BIGINT) AS h
    FROM numbered
), bucket AS (
    SELECT depth, h >> ({BITS} - depth) AS bits, sum(n_bytes) AS shard_bytes, count(*) AS shard_docs
    FROM hashed, (SELECT unnest(range(0, 41))::INT AS depth) GROUP BY 1, 2
), fitting AS (
    SELECT r.doc_id, r.n_bytes, r.copy, b.*, row_number() OVER (PARTITION BY r.doc_id, r.n_bytes, r.copy ORDER BY b.depth) AS place
    FROM hashed r JOIN bucket b ON r.h >> ({BITS} - b.depth) = b.bits
    WHERE b.shard_bytes <= {limit} OR b.shard_docs = 1
)
SELECT doc_id, n_bytes, copy, depth, CAST(shard_bytes AS BIGINT) AS shard_bytes, shard_docs,
    CASE WHEN depth = 0 THEN '' ELSE lpad(bin(bits), depth, '0') END AS shard
FROM fitting WHERE place = 1
"""
