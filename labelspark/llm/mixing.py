"""Mixing sources to target weights by Poisson replication.

A source's rate is the mean number of times that each of its documents should occur, so that the mixture has
the target weights. Each document gets a number of copies from the Poisson distribution of that mean, by inverting the
distribution at a number in [0, 1) hashed from seed and id: the same on every run and for every partitioning.
The copies are dealt out by a second hash, which shuffles them globally.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelspark.llm.common import cut

SEED = 17
#: Greatest mean that is inverted at once; a greater one is the sum of independent equal parts.
MEAN = 8.0
TERMS = 64
#: Greatest rate by default: a document's copies come out of its own row, so their number has to stay that of a row's work.
MOST_COPIES = 100_000.0
#: Source tables up to so many rows are sent to all tasks; a row has at most some 600 bytes.
BROADCAST_ROWS = 50_000


def hashed(*parts: Column | str | int) -> Column:
    """32 hex digits of the parts."""
    texts = [F.lit(str(p)) if isinstance(p, (str, int)) else F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.md5(F.concat_ws(":", *texts))


def uniform(digits: Column) -> Column:
    """A number in [0, 1) of the first 52 bits."""
    return F.conv(F.substring(digits, 1, 13), 16, 10).cast("double") / float(1 << 52)


def rates(docs: DataFrame, weights: dict | None, *, source_col: str, text_col: str, total: float | None, most_copies: float = MOST_COPIES) -> DataFrame:
    """source, parts, cdf: mean copies of a source's documents as ``parts`` equal means with their distribution function."""
    source = F.col(f"`{source_col}`").alias("source")
    size = F.length(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))) + 1
    sizes = docs.groupBy(source).agg(F.sum(size).cast("double").alias("size"))
    if weights is None:
        weighted = sizes.withColumn("weight", F.lit(1.0))
    else:
        own = F.lit(0.0)
        for name, weight in weights.items():
            own = F.when(F.col("source").eqNullSafe(F.lit(name)), float(weight)).otherwise(own)
        weighted = sizes.withColumn("weight", own)
    weighted = cut(weighted)
    sums = weighted.agg(F.sum("size").alias("size"), F.sum("weight").alias("weight")).first()
    target = float(total if total is not None else sums["size"] or 0.0)
    rate = F.col("weight") * target / float(sums["weight"] or 1.0) / F.col("size")
    high = weighted.agg(F.max(rate).alias("rate")).first()["rate"]
    if high is not None and high > most_copies:
        raise ValueError(f"a source would be repeated {high:.0f} times on average, and most_copies is {most_copies:.0f}")
    parts = F.greatest(F.ceil(F.col("rate") / MEAN), F.lit(1)).cast("int")
    begin = F.struct(F.exp(-F.col("mean")).alias("p"), F.exp(-F.col("mean")).alias("sum"), F.array(F.exp(-F.col("mean"))).alias("cdf"))
    grown = F.aggregate(
        F.sequence(F.lit(1), F.lit(TERMS)),
        begin,
        lambda s, k: F.struct(
            (s["p"] * F.col("mean") / k).alias("p"),
            (s["sum"] + s["p"] * F.col("mean") / k).alias("sum"),
            F.concat(s["cdf"], F.array(s["sum"] + s["p"] * F.col("mean") / k)).alias("cdf"),
        ),
        lambda s: s["cdf"],
    )
    means = weighted.withColumn("rate", rate).withColumn("parts", parts).withColumn("mean", F.col("rate") / F.col("parts"))
    return means.select("source", "parts", grown.alias("cdf"))


def copies(id_col: Column, seed: int) -> Column:
    """The copies of a document, from the columns ``parts`` and ``cdf`` of its source."""
    one = lambda j: F.size(F.filter("cdf", lambda c: c <= uniform(hashed(seed, id_col, j))))
    more = F.aggregate(F.sequence(F.lit(1), F.col("parts") - 1), F.lit(0), lambda n, j: n + one(j))
    return F.when(F.col("parts") > 1, more).otherwise(0) + F.size(
        F.filter("cdf", lambda c: c <= F.col("u"))
    )


def mixed(
    docs: DataFrame,
    weights: dict | None = None,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    total: float | None = None,
    seed: int = SEED,
    keep_text: bool = True,
    most_copies: float = MOST_COPIES,
) -> DataFrame:
    """The documents, each repeated by its number of copies and all of them shuffled.

    Returns the struct ``row`` with all columns (without the text unless ``keep_text``), ``copy`` (from 1) and
    ``shuffle_key``. ``weights`` are by source and need not add up to 1 (none: all sources alike; not named:
    0); ``total`` is the size aimed at in characters, each document counting one more (none: that of the input).
    Null sources are one source, null texts are empty; rows that repeat an id repeat its number of copies. Weights by which the
    documents of a source would be repeated more than ``most_copies`` times on average are refused: ask for a smaller ``total``, or weigh it less.
    """
    table = cut(rates(docs, weights, source_col=source_col, text_col=text_col, total=total, most_copies=most_copies))
    table = table.withColumnRenamed("source", "rate_source")
    if table.count() <= BROADCAST_ROWS:
        table = F.broadcast(table)
    kept = [F.col(f"`{c}`") for c in docs.columns if keep_text or c != text_col]
    rows = docs.select(F.struct(*kept).alias("row"))
    own = F.col(f"row.`{id_col}`")
    joined = rows.join(table, F.col(f"row.`{source_col}`").eqNullSafe(F.col("rate_source")))
    drawn = joined.withColumn("u", uniform(hashed(seed, own, 0))).withColumn("n", copies(own, seed))
    repeated = drawn.filter("n > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"))
    return (
        repeated.withColumn("shuffle_key", hashed(seed, own, "order", F.col("copy")))
        .repartition("shuffle_key")
        .sortWithinPartitions("shuffle_key")
    )


def sampled_rows(docs: DataFrame, weights: dict | None = None, **options) -> DataFrame:
    """Of `mixed`, the rows as they were, with all columns of ``docs``."""
    return mixed(docs, weights, **options).select("row.*")


def oracle(weights: None = None, seed: int = SEED) -> str:
    """DuckDB's form of the registered query."""
    unit = 1 << 52
    return f"""
WITH sized AS (
    SELECT source, CAST(sum(length(coalesce(text, '')) + 1) AS DOUBLE) AS size FROM documents GROUP BY source
), rate AS (
    SELECT source, 1.0::DOUBLE * (SELECT sum(size) FROM sized) / (SELECT CAST(count(*) AS DOUBLE) FROM sized) / size AS rate
    FROM sized
), part AS (
    SELECT source, greatest(CAST(ceil(rate / {MEAN}) AS INT), 1) AS parts, rate / greatest(ceil(rate / {MEAN}), 1) AS mean FROM rate
), term AS (
    SELECT source, parts, k,
        exp(-mean) * mean ** k / CAST(factorial(k) AS DOUBLE) AS p
    FROM part, (SELECT unnest(range(0, 30))::INT AS k)
), cdf AS (
    SELECT source, parts, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM term
), draw AS (
    SELECT d.doc_id, d.source, p.j,
        CAST('0x' || substr(md5('{seed}:' || coalesce(CAST(d.doc_id AS VARCHAR), '') || ':' || p.j), 1, 13) AS BIGINT) / {unit}.0 AS u
    FROM documents d JOIN (SELECT source, unnest(range(0, parts)) AS j FROM part) p ON d.source IS NOT DISTINCT FROM p.source
), drawn AS (
    SELECT doc_id, w.source, sum((SELECT count(*) FROM cdf WHERE cdf.source IS NOT DISTINCT FROM w.source AND cdf.c <= w.u)) AS n
    FROM draw w GROUP BY doc_id, w.source
)
SELECT doc_id, source, copy, md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':order:' || copy) AS shuffle_key
FROM (SELECT doc_id, source, CAST(unnest(range(1, CAST(n AS BIGINT) + 1)) AS INT) AS copy FROM drawn)
"""
