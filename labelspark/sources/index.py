"""An inverted index of labels: which values a label has, and which series have a value.

Kept beside the samples by their writer, from the rows of the series table.  Two
tables, both by source and day:

``values(source, day, label, value, value_id, n)``
    the dictionary: each value once per source and day, with its number of series;
``postings(source, day, label, value_id, block, ids)``
    the sorted ids of the series that have a value, cut into blocks of the id space,
    so that no list grows with the table.  A label ``""`` lists all series.

and one by label only:

``grams(label, gram, value_id)``
    the runs of three characters of each value, by which a regular expression with fixed parts is
    looked up.

Label names and values are read off the dictionary.  A selector is resolved by its
postings: each matcher becomes the value ids it asks for or forbids, and the ids of series
are added up as bits, so that lists are intersected and subtracted without being held.
Neither samples nor label maps are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelspark.functions import labels as L
from labelspark.functions.times import days
from labelspark.operators.matchers import Matcher, Selector
from labelspark.operators.routing import attach_external, routed
from labelspark.sources.folders import remove, shared_dir
from labelspark.sources.store import SERIES_ID, add_series, clean_samples, series_rows, stored, write_clean, writer

#: The id space of a (source, day) is cut into this many blocks, a power of two; 4,096 ids a block at 4 million series.
BLOCKS = 1024

#: One task lists so many series; those of a (source, day) may go to 2 to the power of PART_BITS tasks, by their block.
TASK_SERIES = 100_000
PART_BITS = 7

#: Up to so many value ids stand in the filter of the scan; more are joined.
LISTED = 1_000

#: The label under which all series of a source and day are listed.
ALL = ""

#: A bit of a 64-bit number stands for each matcher.
MOST_MATCHERS = 60

GRAM = 3
_CLASSES = "dDsSwWbB"
_FLAGS = re.compile(r"\\[QE]|\(\?[a-zA-Z-]+[:)]")


def value_id(label: Column, value: Column) -> Column:
    return F.xxhash64(label, value)


def grams_of(text: Column) -> Column:
    """The distinct runs of three characters of a text."""
    last = F.char_length(text) - (GRAM - 1)
    places = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, lambda i: F.substring(text, i, F.lit(GRAM))))


def write_index(series: DataFrame, path: str, *, mode: str = "append", blocks: int = BLOCKS) -> None:
    """Index rows of a series table, those that a write has just added.

    All writes of one index must name the same number of blocks.  Two values of a label with one id are
    refused before anything is written.  Rows indexed twice do no harm to answers, so a
    write that failed may be repeated.
    """
    if blocks < 1 or blocks & (blocks - 1):
        raise ValueError("the number of blocks must be a power of two")
    spark = series.sparkSession
    pairs = F.explode(F.map_entries("labels")).alias("pair")
    told = series.select("source", "day", *SERIES_ID, pairs).select(
        "source", "day", *SERIES_ID, F.col("pair.key").alias("label"), F.col("pair.value").alias("value")
    )
    values = told.groupBy("source", "day", "label", "value").agg(F.count("*").alias("n"))
    values = values.withColumn("value_id", value_id(F.col("label"), F.col("value")))
    known = stored(spark, f"{path}/grams")
    _refuse_clashes(values, None if known is None or mode == "all" else stored(spark, f"{path}/values"))
    postings = _postings(series, blocks)
    writer(_ordered(values, "label", "value"), mode).partitionBy("source", "day").parquet(f"{path}/values")
    writer(postings, mode).partitionBy("source", "day").parquet(f"{path}/postings")
    grams = values.select("label", "value_id", "value").distinct()
    grams = grams.select("label", F.explode(grams_of(F.col("value"))).alias("gram"), "value_id")
    if known is not None and mode == "append":
        grams = grams.join(known, ["label", "gram", "value_id"], "left_anti")
    spread = grams.repartitionByRange("label", "gram").sortWithinPartitions("label", "gram", "value_id")
    # Of replaced days the grams stay: a gram too many only means one value more to look at.
    writer(spread, "append" if mode == "partitions" else mode).parquet(f"{path}/grams")


def _postings(series: DataFrame, blocks: int) -> DataFrame:
    """The lists of ids, in the order in which they are written.

    Series are sent with their value ids, once, to the task that holds their part of the id space; the lists are made
    and sorted there, and no posting is shuffled.
    """
    block = F.shiftrightunsigned("id_hi", 64 - blocks.bit_length() + 1).cast("int") if blocks > 1 else F.lit(0)

    def held(label: Column, value: Column) -> Column:
        return F.struct(label.alias("label"), value_id(label, value).alias("value_id"))

    own = F.transform(F.map_entries("labels"), lambda pair: held(pair["key"], pair["value"]))
    told = series.select(
        "source", "day", *SERIES_ID, block.alias("block"), F.concat(F.array(held(F.lit(ALL), F.lit(ALL))), own).alias("held")
    )
    told = told.withColumn("part", F.shiftright("block", max(blocks.bit_length() - 1 - PART_BITS, 0)))
    tasks = max(1, -(-series.count() // TASK_SERIES))
    spread = told.repartitionByRange(tasks, "source", "day", "part")
    listed = spread.select("source", "day", "part", "block", *SERIES_ID, F.inline("held"))
    lists = listed.groupBy("source", "day", "part", "label", "value_id", "block").agg(
        F.sort_array(F.collect_list(F.struct(*SERIES_ID))).alias("ids")
    )
    lists = lists.select("source", "day", "label", "value_id", "block", "ids")
    return lists.sortWithinPartitions("source", "day", "label", "value_id", "block")


def write_store(
    samples: DataFrame, path: str, hot: Sequence[str] = (L.METRIC_NAME,), *, mode: str = "append", blocks: int = BLOCKS
) -> None:
    """Write samples, their series table and their label index below one folder: ``samples``, ``series``, ``index``.

    Samples and series are worked out once and kept in a folder of their own until all three are written.  What can be
    refused is refused before the samples are there to be seen.
    """
    spark, part = samples.sparkSession, shared_dir(samples.sparkSession)
    clean_samples(samples, hot).write.parquet(f"{part}/samples")
    clean = spark.read.parquet(f"{part}/samples")
    series_rows(clean).write.parquet(f"{part}/series")
    rows = spark.read.parquet(f"{part}/series")
    write_index(rows, f"{path}/index", mode=mode, blocks=blocks)
    add_series(rows, f"{path}/series", mode=mode)
    write_clean(clean, f"{path}/samples", hot, mode=mode)
    remove(spark, part)


def _ordered(df: DataFrame, *columns: str) -> DataFrame:
    return df.hint("rebalance", "source", "day").sortWithinPartitions("source", "day", *columns)


def _refuse_clashes(values: DataFrame, stored: DataFrame | None) -> None:
    """Fails if an id stands for two values of a label, among the new ones or beside stored ones."""
    new = values.select("label", "value_id", "value").distinct()
    pairs = new.groupBy("label", "value_id").agg(F.min("value").alias("value"), F.count("*").alias("many"))
    clash = pairs.filter("many > 1").select("label", "value_id")
    if stored is not None:
        old = stored.select("label", "value_id", F.col("value").alias("other"))
        clash = clash.union(
            pairs.join(old, ["label", "value_id"]).filter("value <> other").select("label", "value_id")
        )
    found = clash.take(1)
    if found:
        raise ValueError(f"two values of a label share an id: {found[0]}")


def fixed_parts(pattern: str) -> list[str]:
    """Strings that every match of a whole-value pattern holds; none where that is not plain to see.

    Only literal characters outside of groups, classes and alternatives count.
    """
    if _FLAGS.search(pattern):
        return []
    parts, run, depth, i = [], "", 0, 0

    def end() -> None:
        nonlocal run
        if len(run) >= GRAM:
            parts.append(run)
        run = ""

    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            i += 1
            if i == len(pattern) or pattern[i].isalnum() and pattern[i] not in _CLASSES:
                return []
            if pattern[i].isalnum():
                end()
            elif depth == 0:
                run += pattern[i]
        elif c == "[":
            closed = re.compile(r"\[\^?\]?(?:\\.|[^\]\\\[])*\]").match(pattern, i)
            if not closed:
                return []
            end()
            i = closed.end() - 1
        elif c == "(":
            depth += 1
            end()
        elif c == ")":
            depth -= 1
            end()
        elif c in "?*{":
            run = run[:-1]
            end()
            if c == "{":
                i = pattern.find("}", i)
                if i < 0:
                    return []
        elif c in "+.^$":
            end()
        elif c == "|":
            if depth == 0:
                return []
        elif depth == 0:
            run += c
        i += 1
    end()
    return parts if depth == 0 else []


@dataclass(frozen=True)
class Term:
    """A matcher as the values it asks for, or forbids where a series without the label fits as well."""

    matcher: Matcher
    forbids: bool

    def wanted(self, value: Column) -> Column:
        fits = self.matcher.accepts(value)
        return ~fits if self.forbids else fits

    def pattern(self) -> str | None:
        """The regular expression that the wanted values match, if there is one."""
        positive = self.matcher.op == ("!~" if self.forbids else "=~")
        return self.matcher.value if positive else None


def _terms(spark: SparkSession, chosen: Iterable[Matcher]) -> list[Term]:
    """Whether a matcher fits an absent label is asked of Spark, whose expressions decide the rest as well."""
    matchers = list(chosen)
    if not matchers:
        return []
    absent = spark.sql("SELECT 1").select(*(m.accepts(F.lit(None).cast("string")).alias(f"m{i}") for i, m in enumerate(matchers)))
    return [Term(m, bool(fits)) for m, fits in zip(matchers, absent.first(), strict=True)]


@dataclass(frozen=True)
class LabelIndex:
    """The three tables of an index."""

    values: DataFrame
    postings: DataFrame
    grams: DataFrame

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> LabelIndex:
        return cls(*(spark.read.parquet(f"{path}/{name}") for name in ("values", "postings", "grams")))

    def between(self, start: int | None, end: int | None) -> LabelIndex:
        """The days that a range touches."""
        inside = days(start, end)
        if not inside:
            return self
        keep = reduce(Column.__and__, inside)
        return LabelIndex(self.values.filter(keep), self.postings.filter(keep), self.grams)

    # -- the dictionary

    def matching_values(self, label: str, term: Term) -> DataFrame:
        """label, value, value_id of the values of one label that a matcher asks for (forbids), each once.

        A pattern with fixed parts is tried on the values only that hold all of their grams.
        """
        values = self.values.filter(F.col("label") == label).select("label", "value", "value_id")
        pattern = term.pattern()
        parts = fixed_parts(pattern) if pattern else []
        needed = sorted({part[i : i + GRAM] for part in parts for i in range(len(part) - GRAM + 1)})
        if needed:
            hits = self.grams.filter((F.col("label") == label) & F.col("gram").isin(needed))
            held = hits.groupBy("value_id").agg(F.count_distinct("gram").alias("many")).filter(F.col("many") == len(needed))
            values = values.join(held.select("value_id"), "value_id", "left_semi")
        return values.select("label", "value", "value_id").distinct().filter(term.wanted(F.col("value")))

    # -- resolving

    def resolve(
        self,
        sources: DataFrame,
        chosen: Selector,
        *,
        owned: Iterable[str] = (),
        on_empty: str = "all",
        small: bool | None = None,
    ) -> DataFrame:
        """source, day, id_hi, id_lo of the series of the routed sources that fit the selector.

        ``owned`` are the label names that some source owns.  A matcher on such a label has been decided by routing
        for the sources that do, and is left out for them.  A source left with no matcher is read whole
        (``on_empty="no filter"``) or for all its named series (``"all"``).
        """
        spark = self.postings.sparkSession
        terms = _terms(spark, dict.fromkeys(chosen))
        if len(terms) > MOST_MATCHERS:
            raise ValueError(f"a selector has at most {MOST_MATCHERS} different matchers")
        owned = set(owned)
        wanted = [self._ids_of(t, 1 << i) for i, t in enumerate(terms)]
        # Without a matcher that each source must answer by its own labels, the metric name stands in, or all series do.
        bare = all(t.matcher.name in owned for t in terms)
        if bare and on_empty == "all":
            wanted.append(self._ids_of(Term(Matcher("=~", L.METRIC_NAME, ".+"), False), 1 << len(terms)))
        parts = []
        if wanted:
            needed = reduce(DataFrame.unionByName, wanted).groupBy("label", "value_id").agg(F.bit_or("bits").alias("bits"))
            parts.append(self._listed(needed).select("source", "day", F.inline("ids"), "bits"))
        if all(t.forbids or t.matcher.name in owned for t in terms):
            whole = self.postings.filter(F.col("label") == ALL)
            parts.append(whole.select("source", "day", F.inline("ids"), F.lit(0).cast("bigint").alias("bits")))
        found = reduce(DataFrame.unionByName, parts)
        bits = found.groupBy("source", "day", *SERIES_ID).agg(F.bit_or("bits").alias("bits"))
        joined = attach_external(bits, routed(sources, chosen), small=small)
        return joined.filter(self._fits(terms, on_empty)).select("source", "day", *SERIES_ID)

    def _fits(self, terms: list[Term], on_empty: str) -> Column:
        """By source: the bits that a series must have and must not have."""
        external = F.col("external_labels")
        ask = forbid = F.lit(0).cast("bigint")
        all_owned = F.lit(True)
        for i, term in enumerate(terms):
            own = F.coalesce(external[term.matcher.name], F.lit("")) != ""
            bit = F.when(own, 0).otherwise(1 << i).cast("bigint")
            if term.forbids:
                forbid = forbid.bitwiseOR(bit)
            else:
                ask = ask.bitwiseOR(bit)
            all_owned = all_owned & own
        bits = F.col("bits")
        fits = (bits.bitwiseAND(ask) == ask) & (bits.bitwiseAND(forbid) == 0)
        if on_empty == "all":
            fits &= ~all_owned | (bits.bitwiseAND(F.lit(1 << len(terms)).cast("bigint")) != 0)
        return fits

    def _ids_of(self, term: Term, bit: int) -> DataFrame:
        found = self.matching_values(term.matcher.name, term)
        return found.select("label", "value_id", F.lit(bit).cast("bigint").alias("bits"))

    def _listed(self, needed: DataFrame) -> DataFrame:
        """Postings of the value ids needed, with their bits; few ids stand in the filter of the scan."""
        few = needed.limit(LISTED + 1).collect()
        if len(few) > LISTED:
            return self.postings.join(needed, ["label", "value_id"])
        if not few:
            return self.postings.limit(0).withColumn("bits", F.lit(0).cast("bigint"))
        here = self.postings.filter(F.col("label").isin(sorted({r.label for r in few})))
        here = here.filter(F.col("value_id").isin(sorted({r.value_id for r in few})))
        known = self.postings.sparkSession.createDataFrame(few, needed.schema)
        return here.join(F.broadcast(known), ["label", "value_id"])

    # -- answers

    def names(self, ids: DataFrame | None) -> DataFrame:
        """source, label: the label names of the series found, or of all."""
        if ids is None:
            return self.values.select("source", "label").distinct()
        told = self.postings.filter(F.col("label") != ALL).select("source", "day", "label", F.inline("ids"))
        return told.join(ids, ["source", "day", *SERIES_ID], "left_semi").select("source", "label").distinct()

    def values_of(self, label: str, ids: DataFrame | None) -> DataFrame:
        """source, value: the values of one label among the series found, or among all."""
        values = self.values.filter(F.col("label") == label)
        if ids is None:
            return values.select("source", "value").distinct()
        told = self.postings.filter(F.col("label") == label).select("source", "day", "value_id", F.inline("ids"))
        hit = told.join(ids, ["source", "day", *SERIES_ID], "left_semi").select("source", "day", "value_id").distinct()
        return values.join(hit, ["source", "day", "value_id"], "left_semi").select("source", "value").distinct()

