from __future__ import annotations

from pyspark.sql import functions as F

from labelspark.operators.series import with_identity

SAMPLES = "source string, labels map<string,string>, ts_ms bigint, value double"


def samples(spark, rows):
    """``rows`` of (source, labels, ts_ms, value)."""
    return spark.createDataFrame([(s, l, t, float(v)) for s, l, t, v in rows], SAMPLES)


def identified(spark, rows):
    return with_identity(samples(spark, rows))


def sources(spark, named):
    return spark.createDataFrame(list(named.items()), "source string, external_labels map<string,string>")


def one(spark, column):
    """The value of a column that needs no table."""
    return spark.range(1).select(column.alias("c")).first()[0]


def label_sets(df, column="labels"):
    return [r[0] for r in df.select(column).collect()]


def expr_map(**labels):
    if not labels:
        return F.expr("cast(map() as map<string,string>)")
    return F.create_map(*[F.lit(x) for pair in sorted(labels.items()) for x in pair])
