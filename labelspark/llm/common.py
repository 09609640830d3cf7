"""Helpers that several operators share: inputs, text batches, cut lineage, span lists."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelspark.sources.folders import shared_base

#: White space between words: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed(df: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """Id and text under the names ``doc_id`` and ``text``; columns not named here are left behind,
    so that they cannot clash with what an operator adds. A null text is an empty one."""
    kept = [F.col(f"`{c}`") for c in more]
    return df.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"), *kept
    )


def map_text(df: DataFrame, schema: str, rows_of: Callable[[list, list], list[list]], id_col: str, text_col: str) -> DataFrame:
    """One output row per input row, made of the id and the whole text in Arrow batches.

    ``rows_of`` gets the ids and the texts of some rows and returns one list for each column of
    ``schema``. At most some megabytes of text are held as Python strings at a time.
    """
    kinds = T._parse_datatype_string(schema)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                columns = rows_of(part.column(0).to_pylist(), part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow
                )

    return df.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).mapInArrow(run, kinds)


def slices(batch: pa.RecordBatch, rows: int = 1000) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Where that is unset, as in tests, it is one below the warehouse; a local warehouse is refused on a cluster.
    """
    return shared_base(spark) + ("" if spark.conf.get("spark.checkpoint.dir", None) else "/_shared")


def cut(df: DataFrame) -> DataFrame:
    """The same rows, written once to the shared folder, with their lineage cut."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, also inside the lambda functions of ``use``."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def hex_digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of an ordered array of structs, comma-joined."""
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )
