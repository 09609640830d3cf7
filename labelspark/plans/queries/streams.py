"""The streaming jobs, run once over the whole event table."""

from __future__ import annotations

from dataclasses import replace

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from labelspark.functions import labels as L
from labelspark.functions.steps import SAMPLES_PER_CHUNK
from labelspark.operators.projection import with_text
from labelspark.plans.queries.discovery import ANNOUNCED, SQL_ANNOUNCED
from labelspark.plans.queries.ranges import SERIES, SQL_CHUNKS, samples_text
from labelspark.plans.queries.requests import NOT_VIEW, SQL_NOT_VIEW, federation, flat, stored
from labelspark.plans.registry import query
from labelspark.plans.tables import DAY, DROPPED, END, EXTERNAL_NAMES, FINAL_TEXT, SQL_EXTERNAL, SQL_VALUES, START, Tables
from labelspark.sources.folders import remove, shared_dir
from labelspark.streaming.attach import attached, stream_attach
from labelspark.streaming.chunks import chunk_log, chunks_of, merge_chunks
from labelspark.streaming.expiry import STATE_STORE, living, living_log, stream_living
from labelspark.streaming.latest import latest_log, latest_samples, stream_latest
from labelspark.streaming.refresh import announced_at, announced_log, refresh_announced, stream_announced
from labelspark.streaming.versions import VersionedTable


class Arriving(Tables):
    """The same tables, read as streams."""

    def load(self, name):
        schema = super().load(name).schema
        return self.spark.readStream.schema(schema).parquet(f"{self.sf_dir}/{name}*.parquet")


@query(f"WITH {SQL_VALUES}, " + SQL_ANNOUNCED.format(by="source,", where=""))
def stream_announce(t):
    place = shared_dir(t.spark)
    table = VersionedTable(t.spark, f"{place}/announced")
    arriving = Arriving(t.spark, t.sf_dir).values()
    stream_announced(arriving, ANNOUNCED, table, f"{place}/checkpoint", once=True).awaitTermination()
    return announced_at(table.current(), END, 0, "source").select("source", "labels_s")


@query(
    f"WITH {SQL_VALUES}, {SQL_EXTERNAL} SELECT event_id, source, {FINAL_TEXT} AS labels_s, ts_ms, value "
    f"FROM s JOIN x USING (source) WHERE {SQL_NOT_VIEW}"
)
def stream_label(t):
    place = shared_dir(t.spark)
    sources = VersionedTable(t.spark, f"{place}/sources")
    arriving = Arriving(t.spark, t.sf_dir).values()
    stream_attach(
        arriving,
        sources,
        NOT_VIEW,
        f"{place}/out",
        f"{place}/checkpoint",
        read_sources=t.sources,
        dropped=DROPPED,
        external_names=EXTERNAL_NAMES,
        once=True,
    ).awaitTermination()
    return with_text(attached(t.spark, f"{place}/out").current()).select("event_id", "source", "labels_s", "ts_ms", "value")


@query(f"WITH {SQL_VALUES}, " + SQL_ANNOUNCED.format(by="source,", where=""))
def stream_resume(t):
    """A second run with a checkpoint of its own goes on where the first one ended."""
    place = shared_dir(t.spark)
    table = VersionedTable(t.spark, f"{place}/announced")
    early = F.col("event_type").isin("click", "view")
    for run, part in enumerate((early, ~early)):
        arriving = Arriving(t.spark, t.sf_dir).values().filter(part)
        stream_announced(arriving, ANNOUNCED, table, f"{place}/checkpoint-{run}", once=True).awaitTermination()
    return announced_at(table.current(), END, 0, "source").select("source", "labels_s")


@query(
    f"WITH {SQL_VALUES}, "
    + SQL_ANNOUNCED.format(by="source,", where=f"WHERE source <> 'src-2' AND ts_ms BETWEEN {END - 10 * DAY} AND {END}")
)
def refresh_partial(t):
    """One of four sources fails; the labels of the others are there all the same."""
    table = VersionedTable(t.spark, f"{shared_dir(t.spark)}/announced")

    def read(name):
        samples = t.values().filter(F.col("source") == name)
        return samples.withColumn("ts_ms", F.when(F.lit(name) == "src-2", F.raise_error(F.lit("gone"))).otherwise(F.col("ts_ms")))

    readers = {name: (lambda n=name: read(n)) for name in ("src-0", "src-1", "src-2", "src-3")}
    refresh_announced(readers, ANNOUNCED, table, END, 10 * DAY, seconds=600)
    return announced_at(table.current(), END, 10 * DAY, "source").select("source", "labels_s")


# -- batches that come one after the other, run again, or are killed


def landed(t, samples, place, files):
    """Samples as so many files of a landing folder, in the order of their days."""
    samples.repartitionByRange(files, "ts_ms", "event_id").write.mode("append").parquet(place)


def arriving(t, place, per_batch=1):
    schema = t.spark.read.parquet(place).schema
    return t.spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(place)


SQL_ALL_ANNOUNCED = f"WITH {SQL_VALUES}, " + SQL_ANNOUNCED.format(by="source,", where="")


@query(SQL_ALL_ANNOUNCED)
def stream_compact(t):
    """Seven batches into a log that merges its parts by twos, then all of them."""
    place = shared_dir(t.spark)
    landed(t, t.values(), f"{place}/in", 7)
    table = announced_log(t.spark, f"{place}/announced", fan=2)
    stream_announced(arriving(t, f"{place}/in"), ANNOUNCED, table, f"{place}/checkpoint", once=True).awaitTermination()
    table.compact()
    return announced_at(table.current(), END, 0, "source").select("source", "labels_s")


@query(SQL_ALL_ANNOUNCED)
def stream_rerun(t):
    """The last batch runs again after it was committed, and can't be read then: the table stays as it was."""
    place = shared_dir(t.spark)
    tables = announced_log(t.spark, f"{place}/log"), VersionedTable(t.spark, f"{place}/versions")
    told = []
    for number, table in enumerate(tables):
        checkpoint = f"{place}/checkpoint-{number}"
        whole = Arriving(t.spark, t.sf_dir).values()
        gone = whole.withColumn("ts_ms", F.raise_error(F.lit("gone")).cast("bigint"))
        for samples in (whole, gone):
            stream_announced(samples, ANNOUNCED, table, checkpoint, once=True).awaitTermination()
            remove(t.spark, f"{checkpoint}/commits")
        told.append(announced_at(table.current(), END, 0, "source").select("source", "labels_s"))
    return told[0].intersect(told[1])


LOOKBACK_DAYS = 3


@query(
    f"""WITH {SQL_VALUES}, e AS (SELECT source, ts_ms, unnest(['event_type', 'user']) AS label, unnest([event_type, usr]) AS value FROM s),
    m AS (SELECT source, label, value, max(ts_ms) AS last FROM e GROUP BY ALL)
    SELECT source, '{{' || label || '="' || value || '"}}' AS labels_s FROM m
    WHERE last + {LOOKBACK_DAYS * DAY} >= (SELECT max(ts_ms) FROM s)"""
)
def stream_expiry(t):
    """Labels leave when their lookback ends: two triggers, the second with samples that come too late."""
    place, middle = shared_dir(t.spark), START + 20 * DAY
    table = living_log(t.spark, f"{place}/living")
    early, late = F.col("ts_ms") < middle, F.col("ts_ms") < START + 2 * DAY
    kept = t.spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    t.spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    try:
        for part in (early, ~early | late):
            landed(t, t.values().filter(part), f"{place}/in", 1)
            samples = arriving(t, f"{place}/in")
            stream_living(samples, ["event_type", "user"], LOOKBACK_DAYS * DAY, table, f"{place}/checkpoint", once=True).awaitTermination()
    finally:
        t.spark.conf.set("spark.sql.streaming.stateStore.providerClass", kept)
    return living(table, "source").select("source", "labels_s")


@query(
    f"WITH {SQL_VALUES}, {SQL_EXTERNAL} SELECT event_id, source, {FINAL_TEXT} AS labels_s, ts_ms, value "
    f"FROM s JOIN x USING (source) WHERE {SQL_NOT_VIEW}"
)
def stream_label_resume(t):
    """A batch is killed half way and runs again, the last one runs twice; every row is there once, in days."""
    place = shared_dir(t.spark)
    sources = VersionedTable(t.spark, f"{place}/sources")
    landed(t, t.values(), f"{place}/in", 4)
    killed = F.when(F.col("event_id") % 1000 == 7, F.raise_error(F.lit("killed")).cast("double")).otherwise(F.col("value"))
    out = attached(t.spark, f"{place}/out", fan=3)
    for samples in (arriving(t, f"{place}/in").withColumn("value", killed), arriving(t, f"{place}/in"), arriving(t, f"{place}/in")):
        try:
            stream_attach(
                samples, sources, NOT_VIEW, f"{place}/out", f"{place}/checkpoint",
                read_sources=t.sources, dropped=DROPPED, external_names=EXTERNAL_NAMES, once=True,
            ).awaitTermination()
            remove(t.spark, f"{place}/checkpoint/commits/3")
        except StreamingQueryException:
            continue
    out.compact()
    return with_text(out.current()).select("event_id", "source", "labels_s", "ts_ms", "value")


@query(
    f"""WITH {SQL_VALUES}, {SQL_EXTERNAL}, i AS (
      SELECT {SERIES}, ext_prom, ext_region, arg_max(value, ts_ms) AS value FROM s JOIN x USING (source)
      WHERE {SQL_NOT_VIEW} AND ts_ms > {END - 31 * DAY} AND ts_ms <= {END} GROUP BY ALL)
    SELECT source, {FINAL_TEXT} AS labels_s, CAST({END} AS BIGINT) AS ts_ms, value FROM i"""
)
def instant_latest(t):
    """An instant query at the present from the latest samples, kept by batches whose samples come in no order."""
    place = shared_dir(t.spark)
    t.values().repartition(3, "event_id").write.parquet(f"{place}/in")
    table = latest_log(t.spark, f"{place}/latest", fan=2)
    stream_latest(arriving(t, f"{place}/in"), table, f"{place}/checkpoint", once=True).awaitTermination()
    samples, series = stored(t)
    fed = replace(federation(t, samples=samples), series=series, latest=latest_samples(table))
    return flat(fed.query(NOT_VIEW, END // 1000, 31 * DAY), "ts_ms", "value")


@query(
    f"""WITH {SQL_VALUES.replace("s AS (", "a AS (", 1)},
    s AS (SELECT source, event_type, ts_ms, 0 AS event_id,
        arg_max(value, CASE WHEN event_id % 3 = 0 THEN 1000000000 ELSE 0 END + event_id) AS value FROM a GROUP BY ALL),
    c AS (SELECT *, (row_number() OVER (PARTITION BY source, event_type ORDER BY ts_ms) - 1) // {SAMPLES_PER_CHUNK} AS chunk FROM s) {SQL_CHUNKS}"""
)
def chunks_merged(t):
    """Two thirds of the samples are chunked, the others come later and all over: the chunks are those of all at once."""
    table = chunk_log(t.spark, f"{shared_dir(t.spark)}/chunks")
    samples = t.by_type().drop("labels_c")
    late = F.col("event_id") % 3 == 0
    for part in (samples.filter(~late), samples.filter(late)):
        merge_chunks(table, part, tiebreak="event_id")
    chunks = chunks_of(table)
    shown = chunks.select("source", L.text(F.col("labels")).alias("labels_s"), "chunk", "min_time", "max_time", "samples")
    return shown.select(
        "source", "labels_s", "chunk", "min_time", "max_time", F.size("samples").cast("bigint").alias("n"), samples_text().alias("samples_s")
    )
