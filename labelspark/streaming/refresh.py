"""Keeping the announced label sets and the external labels up to date."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial
from itertools import islice
from threading import Event
from time import monotonic
from uuid import uuid4

from pyspark import InheritableThread
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from labelspark.operators.catalog import announced_pairs, as_label_sets, check_names, lookback_range, within_lookback
from labelspark.sources.config import split_tenants
from labelspark.sources.folders import remove
from labelspark.streaming.versions import LogTable, VersionedTable, run_of

# How often the two are refreshed.
ANNOUNCED_EVERY = "1 minute"
EXTERNAL_EVERY = "30 seconds"
#: A source is read by a whole Spark job, so its limit is that of a job, not that of one fetch.
SECONDS_PER_SOURCE = 600.0

#: How long a source that is given up may take to leave its cores.
SECONDS_TO_STOP = 30.0

SEEN = "label string, value string, last_seen bigint, source string"


class AllSourcesFailed(RuntimeError):
    def __init__(self, failures: Sequence[tuple[str, str]]) -> None:
        super().__init__(
            "no source could tell its labels: " + "; ".join(f"{name}: {error}" for name, error in failures)
        )
        self.failures = list(failures)


#: How often running sources are looked at.
POLL_SECONDS = 0.2


@dataclass
class Asked:
    """A source that is being read: where its answer goes, and the tag of its jobs."""

    name: str
    place: int
    part: str
    tag: str
    begun: float = field(default_factory=monotonic)
    error: str | None = None
    answered: Event = field(default_factory=Event)
    given_up: Event = field(default_factory=Event)
    thread: InheritableThread | None = None


def give_up(spark: SparkSession, asked: Asked) -> None:
    """Cancel the jobs of a source until none is left; a reader that hangs outside of Spark starts none when it comes back."""
    asked.given_up.set()
    until = monotonic() + SECONDS_TO_STOP
    while True:
        spark.sparkContext.cancelJobsWithTag(asked.tag)
        if asked.answered.wait(POLL_SECONDS) or not running_jobs(spark, asked.tag) or monotonic() > until:
            return


def running_jobs(spark: SparkSession, tag: str) -> list[int]:
    """The jobs with a tag that are not done."""
    tracker = spark.sparkContext.statusTracker()
    known = spark.sparkContext._jsc.sc().statusTracker().getJobIdsForTag(tag)
    return [job for job in known if (told := tracker.getJobInfo(job)) is not None and told.status == "RUNNING"]


def last_seen(samples: DataFrame, names: Sequence[str]) -> DataFrame:
    """Per source, label and value the time of the last sample."""
    return announced_pairs(samples, names, "source", "ts_ms").groupBy("source", "label", "value").agg(
        F.max("ts_ms").alias("last_seen")
    )


#: What is known of an announced label: its source, name and value, and when it was last seen.
SEEN_KEYS = ("source", "label", "value")


def announced_log(spark: SparkSession, path: str, **settings) -> LogTable:
    """The announced labels as a log of batches, merged to the time each was last seen."""
    return LogTable(spark, path, SEEN_KEYS, {"last_seen": F.max("last_seen")}, **settings)


def stream_announced(
    samples: DataFrame,
    names: Sequence[str],
    table: VersionedTable | LogTable,
    checkpoint: str,
    *,
    once: bool = False,
    every: str = ANNOUNCED_EVERY,
) -> StreamingQuery:
    """Follow a stream of samples and keep the announced labels in a table.

    An `announced_log` takes in what each batch has seen, and no more is written; a versioned table is
    written anew.  A batch that runs again after it was committed changes nothing; a run with a new checkpoint goes on
    after the last version.  Late samples do no harm, as only the latest time counts.
    """
    check_names(names)

    def merge(batch: DataFrame, batch_id: int) -> None:
        table.absorb(last_seen(batch, names), list(SEEN_KEYS), run_of(table.spark, checkpoint), batch_id)

    return started(samples.writeStream.foreachBatch(merge), checkpoint, once, every)


def started(writer, checkpoint: str, once: bool, every: str) -> StreamingQuery:
    trigger = {"availableNow": True} if once else {"processingTime": every}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def announced_at(seen: DataFrame, now_ms: int, lookback_ms: int = 0, *by: str) -> DataFrame:
    """The label sets seen since the lookback began, distinct and sorted by text.

    A label is known by its last time only, so one that has also been seen after ``now`` stays.
    """
    bounds = lookback_range(now_ms, lookback_ms)
    if bounds is not None:
        seen = seen.filter(F.col("last_seen") >= bounds[0])
    sets = as_label_sets(seen.select(*by, "label", "value").distinct())
    return sets.select(*by, "labels", "labels_s").orderBy("labels_s", *by)


def refresh_announced(
    readers: Mapping[str, Callable[[], DataFrame]],
    names: Sequence[str],
    table: VersionedTable,
    now_ms: int,
    lookback_ms: int = 0,
    *,
    at_once: int = 4,
    seconds: float = SECONDS_PER_SOURCE,
) -> list[tuple[str, str]]:
    """Read the announced labels of separate sources anew and replace the table.

    A source that fails, or takes longer than ``seconds`` from its own start, is left out and
    reported as ``(source, error)``; one given up no longer counts among the ``at_once``, and its Spark jobs are
    cancelled, so that it holds no cores.  If all fail the table stays as it was and `AllSourcesFailed` is
    raised.  Each source is written for itself first, so that its failure shows there.
    A first load without any label is refused.
    """
    if not readers:
        raise ValueError("there is no source to ask for its labels")
    if at_once < 1:
        raise ValueError("at least one source must be read at a time")
    lookback_range(now_ms, lookback_ms)
    version = table.last_version()
    version = 0 if version is None else version + 1

    turn = uuid4().hex
    context = table.spark.sparkContext

    def read_one(asked: Asked) -> None:
        context.addJobTag(asked.tag)
        try:
            check_names(names)
            recent = within_lookback(readers[asked.name](), now_ms, lookback_ms)
            seen = announced_pairs(recent, names, "ts_ms").groupBy("label", "value")
            told = seen.agg(F.max("ts_ms").alias("last_seen")).withColumn("source", F.lit(asked.name))
            if not asked.given_up.is_set():
                told.write.mode("overwrite").parquet(asked.part)
        except Exception as error:  # any failure of one source is reported, not raised
            asked.error = str(error)
        finally:
            asked.answered.set()

    waiting = iter(enumerate(readers))
    running: list[Asked] = []
    ended: dict[int, tuple[str, str, str | None]] = {}
    while len(ended) < len(readers):
        for place, name in islice(waiting, at_once - len(running)):
            asked = Asked(name, place, f"{table.path}/parts/v{version}/{turn}-{place}", f"refresh-{turn}-{place}")
            asked.thread = InheritableThread(target=read_one, args=(asked,), daemon=True)
            asked.thread.start()
            running.append(asked)
        running[0].answered.wait(POLL_SECONDS)
        for asked in list(running):
            late = monotonic() - asked.begun >= seconds
            if asked.answered.is_set() or late:
                running.remove(asked)
                if not asked.answered.is_set():
                    give_up(table.spark, asked)
                    asked.error = f"no answer within {seconds:g} s"
                ended[asked.place] = (asked.name, asked.part, asked.error)
    done = [ended[place] for place in range(len(readers))]
    failures = [(name, error) for name, _, error in done if error is not None]
    parts = [part for _, part, error in done if error is None]
    if not parts:
        raise AllSourcesFailed(failures)
    found = table.spark.read.schema(SEEN).parquet(*parts)
    if version == 0 and found.isEmpty():
        raise ValueError("the first load found no label at all")
    table.write(found, version)
    for part in parts:
        remove(table.spark, part)
    return failures


def tenant_readers(
    fields: DataFrame, read: Callable[[str], DataFrame], field: str = "tenant_field"
) -> dict[str, Callable[[], DataFrame]]:
    """A reader per tenant of a ``a|b`` field, for `refresh_announced`; no tenant, one default source.

    ``read`` gives the samples of a tenant.  Tenants are configured, so there are few.
    """
    tenants = split_tenants(fields, field).select("tenant").distinct().orderBy("tenant").collect()
    return {row["tenant"]: partial(read, row["tenant"]) for row in tenants}


def refresh_external(table: VersionedTable, read: Callable[[], DataFrame]) -> str | None:
    """Read the source table anew; on failure keep the last good one and return the error.

    A first load without any external label is refused.
    """
    try:
        found = read()
        if table.last_version() is None and found.filter(F.size("external_labels") > 0).isEmpty():
            raise ValueError("the first load found no external labels")
        table.replace(found)
    except Exception as error:  # the former version stays current
        if table.last_version() is None:
            raise
        return str(error)
    return None
