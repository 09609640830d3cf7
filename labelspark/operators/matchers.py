"""Label matchers and selectors as filter conditions."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelspark.functions.labels import METRIC_NAME

OPS = ("=", "!=", "=~", "!~")
_LITERALS = re.compile(r"[\w :/-]+(\|[\w :/-]+)*", re.ASCII)


@dataclass(frozen=True)
class Matcher:
    """One condition on one label.  An absent label has the value ``""``."""

    op: str
    name: str
    value: str

    def __post_init__(self) -> None:
        if self.op not in OPS:
            raise ValueError(f"unknown matcher type {self.op!r}")

    def __str__(self) -> str:
        escaped = self.value.replace("\\", "\\\\").replace('"', '\\"').replace("\n", "\\n")
        return f'{self.name}{self.op}"{escaped}"'

    def accepts(self, value: Column) -> Column:
        """The condition on a label column in which null means absent.

        Written so that on a plain column the filter reaches the scan: no
        wrapper around the column, and a regular expression that only lists
        words becomes an IN.
        """
        wanted, negated = self.value, self.op[0] == "!"
        if self.op in ("=", "!="):
            if wanted == "":
                return value != "" if negated else value.isNull() | (value == "")
            return value.isNull() | (value != wanted) if negated else value == wanted
        if wanted == ".*":
            return F.lit(not negated)
        if wanted == ".+":
            return value.isNull() | (value == "") if negated else value != ""
        if _LITERALS.fullmatch(wanted):
            listed = value.isin(wanted.split("|"))
            return value.isNull() | ~listed if negated else listed
        whole = F.coalesce(value, F.lit("")).rlike(rf"(?s)\A(?:{wanted})\z")
        return ~whole if negated else whole


class Selector(tuple):
    """Matchers that must all hold.  Without any it means every named series."""

    def __new__(cls, *matchers: Matcher) -> Selector:
        return super().__new__(cls, matchers)

    def __str__(self) -> str:
        shown = self if self else (Matcher("=~", METRIC_NAME, ".+"),)
        return "{" + ", ".join(str(m) for m in shown) + "}"

    def merge(self, extra: Iterable[Matcher]) -> Selector:
        """Add filters that are not there yet, in order."""
        return Selector(*dict.fromkeys((*self, *extra)))

    def names(self) -> set[str]:
        return {m.name for m in self}


def selector(*conditions: tuple[str, str, str]) -> Selector:
    """``selector(("__name__", "=", "up"), ("job", "=~", "api|worker"))``"""
    return Selector(*(Matcher(op, name, value) for name, op, value in conditions))


def stored_column(df: DataFrame, name: str) -> Column:
    """A stored label: its promoted column when the table has one, else the map entry.

    ``name`` holds the metric name, ``label_<x>`` the label ``x``.
    """
    promoted = "name" if name == METRIC_NAME else f"label_{name}"
    return F.col(promoted) if promoted in df.columns else F.col("labels")[name]


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(and_, conditions, F.lit(True))


def matching(df: DataFrame, chosen: Selector, *, on_empty: str = "all") -> DataFrame:
    """Keep the rows whose stored labels fit the selector.

    With ``on_empty="all"`` an empty selector keeps every named series; with
    ``"no filter"`` (label discovery) it filters nothing.
    """
    if not chosen:
        if on_empty == "no filter":
            return df
        chosen = selector((METRIC_NAME, "=~", ".+"))
    return df.filter(all_of(m.accepts(stored_column(df, m.name)) for m in chosen))
