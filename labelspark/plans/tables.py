"""Samples and sources out of the driver's tables, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelspark.functions import labels as L
from labelspark.functions.times import to_millis
from labelspark.operators.series import with_identity
from labelspark.sources.config import literal_sources
from labelspark.sources.store import samples_from

START = 1_704_067_200_000  # 2024-01-01
END = 1_706_659_200_000  # 2024-01-31
DAY = 86_400_000

SOURCES = {
    "src-0": {"prometheus": "prom-0", "region": "eu"},
    "src-1": {"prometheus": "prom-1", "region": "us"},
    "src-2": {"region": "eu"},
    "src-3": {},
}
EXTERNAL_NAMES = frozenset({"prometheus", "region"})
DROPPED = ("__tenant_id__", "replica")


class Tables:
    """The tables of one scale factor as samples and sources."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self._read: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self.load(name)
        return self._read[name]

    def load(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def sources(self) -> DataFrame:
        return literal_sources(self.spark, SOURCES)

    def event_labels(self, metric: str | None, *, replica: bool = True) -> Column:
        user = F.col("user_id")
        labels = {
            "__tenant_id__": F.concat(F.lit("tenant-"), user % 2),
            "event_type": F.col("event_type"),
            "user": F.concat(F.lit("u"), user),
        }
        if metric:
            labels[L.METRIC_NAME] = F.lit(metric)
        if replica:
            labels["replica"] = F.when(F.col("event_id") % 2 == 0, "a").otherwise("b")
        stored_prometheus = labels | {"prometheus": F.lit("from-backend")}
        return F.when((user % 4).isin(0, 3), L.label_map(stored_prometheus)).otherwise(L.label_map(labels))

    def _event_samples(self, metric: str, value: Column, replica: bool) -> DataFrame:
        return samples_from(
            self.table("events"),
            source=F.concat(F.lit("src-"), F.col("user_id") % 4),
            labels=self.event_labels(metric, replica=replica),
            ts_ms=to_millis(F.col("ts")),
            value=value,
            promoted={L.METRIC_NAME: F.lit(metric), "event_type": F.col("event_type")},
            carry=["event_id", "ts"],
        )

    def values(self) -> DataFrame:
        """The gauge ``event_value``."""
        return self._event_samples("event_value", F.col("value"), True)

    def totals(self) -> DataFrame:
        """The counter ``events_total``, which starts anew every 997 events."""
        return self._event_samples("events_total", F.col("event_id") % 997, False)

    def samples(self) -> DataFrame:
        """Both metrics."""
        return self.values().unionByName(self.totals())

    def values_partly_named(self) -> DataFrame:
        """The gauge, where errors have no metric name."""
        labels = F.when(F.col("event_type") == "error", self.event_labels(None)).otherwise(
            self.event_labels("event_value")
        )
        return samples_from(
            self.table("events"),
            source=F.concat(F.lit("src-"), F.col("user_id") % 4),
            labels=labels,
            ts_ms=to_millis(F.col("ts")),
            value=F.col("value"),
            carry=["event_id", "ts"],
        )

    def by_type(self) -> DataFrame:
        """Few long series: the gauge by source and event type only."""
        long_series = samples_from(
            self.table("events"),
            source=F.concat(F.lit("src-"), F.col("user_id") % 4),
            labels=L.label_map({L.METRIC_NAME: F.lit("event_value"), "event_type": F.col("event_type")}),
            ts_ms=to_millis(F.col("ts")),
            value=F.col("value"),
            carry=["event_id", "ts"],
        )
        return with_identity(long_series)

    def suppliers(self) -> DataFrame:
        """Suppliers as sources: nation and region are their external labels.

        A supplier in debt has no external labels configured (null).
        """
        nations = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        placed = self.table("supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        return placed.select(
            F.concat(F.lit("sup-"), "s_suppkey").alias("source"),
            F.when(
                F.col("s_acctbal") >= 0,
                L.label_map({"nation": F.col("n_name"), "region": F.col("r_name")}),
            ).alias("external_labels"),
            "s_suppkey",
        )

    def shipments(self) -> DataFrame:
        """Line items as samples of their supplier."""
        return samples_from(
            self.table("lineitem"),
            source=F.concat(F.lit("sup-"), "l_suppkey"),
            labels=L.label_map(
                {
                    L.METRIC_NAME: F.lit("shipment_price"),
                    "flag": F.col("l_returnflag"),
                    "part": F.concat(F.lit("p"), "l_partkey"),
                    "status": F.col("l_linestatus"),
                }
            ),
            ts_ms=to_millis(F.col("l_shipdate")),
            value=F.col("l_extendedprice"),
            promoted={"flag": F.col("l_returnflag"), "status": F.col("l_linestatus")},
            carry=["l_orderkey", "l_linenumber", F.col("l_shipdate").alias("ts")],
        )

    def order_totals(self) -> DataFrame:
        """Orders as samples, a second table beside events."""
        return samples_from(
            self.table("orders"),
            source=F.concat(F.lit("src-"), F.col("o_custkey") % 4),
            labels=L.label_map(
                {
                    L.METRIC_NAME: F.lit("order_price"),
                    "event_type": F.col("o_orderstatus"),
                    "replica": F.when(F.col("o_orderkey") % 2 == 0, "a").otherwise("b"),
                    "user": F.concat(F.lit("c"), "o_custkey"),
                }
            ),
            ts_ms=to_millis(F.col("o_orderdate")),
            value=F.col("o_totalprice"),
            carry=[F.col("o_orderdate").alias("ts")],
        )


# -- SQL twins -------------------------------------------------------------


def sql_text(*pairs: tuple[str, str]) -> str:
    """SQL for the text of a label set; a null value leaves its label out."""
    cells = ", ".join(f"""'{name}="' || {value} || '"'""" for name, value in sorted(pairs))
    return f"('{{' || concat_ws(', ', {cells}) || '}}')"


SQL_VALUES = """s AS (
  SELECT event_id, user_id, 'src-' || (user_id % 4) AS source, event_type, 'event_value' AS metric,
         'u' || user_id AS usr, 'tenant-' || (user_id % 2) AS tenant,
         CASE WHEN event_id % 2 = 0 THEN 'a' ELSE 'b' END AS replica,
         CASE WHEN user_id % 4 IN (0, 3) THEN 'from-backend' END AS prom,
         epoch_us(ts) // 1000 AS ts_ms, value
  FROM events)"""

SQL_TOTALS = """s AS (
  SELECT event_id, user_id, 'src-' || (user_id % 4) AS source, event_type, 'events_total' AS metric,
         'u' || user_id AS usr, 'tenant-' || (user_id % 2) AS tenant,
         CAST(NULL AS VARCHAR) AS replica,
         CASE WHEN user_id % 4 IN (0, 3) THEN 'from-backend' END AS prom,
         epoch_us(ts) // 1000 AS ts_ms, CAST(event_id % 997 AS DOUBLE) AS value
  FROM events)"""

SQL_BOTH = (
    SQL_VALUES.replace("s AS (", "v AS (", 1)
    + ", "
    + SQL_TOTALS.replace("s AS (", "c AS (", 1)
    + ", s AS (SELECT * FROM v UNION ALL SELECT * FROM c)"
)

# External labels of the four sources, by column.
SQL_EXTERNAL = """x AS (
  SELECT * FROM (VALUES ('src-0', 'prom-0', 'eu'), ('src-1', 'prom-1', 'us'),
                        ('src-2', NULL, 'eu'), ('src-3', NULL, NULL)) t(source, ext_prom, ext_region))"""

SQL_SUPPLIERS = """u AS (
  SELECT 'sup-' || s_suppkey AS source, s_suppkey,
         CASE WHEN s_acctbal >= 0 THEN n_name END AS nation,
         CASE WHEN s_acctbal >= 0 THEN r_name END AS region
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

STORED_TEXT = sql_text(
    ("__name__", "metric"),
    ("__tenant_id__", "tenant"),
    ("event_type", "event_type"),
    ("prometheus", "prom"),
    ("replica", "replica"),
    ("user", "usr"),
)
OVERLAID_TEXT = sql_text(
    ("__name__", "metric"),
    ("__tenant_id__", "tenant"),
    ("event_type", "event_type"),
    ("prometheus", "coalesce(ext_prom, prom)"),
    ("region", "ext_region"),
    ("replica", "replica"),
    ("user", "usr"),
)
FINAL_TEXT = sql_text(
    ("__name__", "metric"),
    ("event_type", "event_type"),
    ("prometheus", "coalesce(ext_prom, prom)"),
    ("region", "ext_region"),
    ("user", "usr"),
)
QUERY_TEXT = sql_text(
    ("__name__", "metric"),
    ("event_type", "event_type"),
    ("prometheus", "coalesce(ext_prom, prom)"),
    ("region", "ext_region"),
    ("replica", "replica"),
    ("user", "usr"),
)
SUPPLIER_TEXT = sql_text(("nation", "nation"), ("region", "region"))
