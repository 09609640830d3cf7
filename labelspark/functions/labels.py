"""Column expressions over label maps.

A label set is a ``MAP<STRING,STRING>``.  A label that is absent and one that
is empty are the same thing.  Maps cannot be compared, so ``canonical`` (the
entries in name order) is the identity and the sort order of a label set.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

LABEL_MAP = "map<string,string>"
METRIC_NAME = "__name__"

# Fixed value: the character rule for a plain label name.
PLAIN_NAME = r"\A[a-zA-Z_][a-zA-Z0-9_]*\z"

# The characters escaped in quoted text; the backslash comes first.
ESCAPES = (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\t", "\\t"), ("\r", "\\r"))


def label_map(pairs: dict[str, Column | str]) -> Column:
    """A label map from names to columns (or literal strings), in name order."""
    if not pairs:
        return no_labels()
    cells = []
    for name in sorted(pairs):
        value = pairs[name]
        cells += [F.lit(name), value if isinstance(value, Column) else F.lit(value)]
    return F.create_map(*cells)


def no_labels() -> Column:
    return F.create_map().cast(LABEL_MAP)


def canonical(labels: Column) -> Column:
    """Entries in name order: the identity and the sort key of a label set."""
    return F.sort_array(F.map_entries(labels))


def normalize(labels: Column) -> Column:
    """Name-ordered map without null or empty values."""
    kept = F.map_filter(labels, lambda _, value: F.coalesce(value, F.lit("")) != "")
    return F.map_from_entries(canonical(F.coalesce(kept, no_labels())))


def stored(labels: Column, name: str) -> Column:
    """The value of one label; null when absent."""
    return labels[name]


def effective(own: Column, external: Column, name: str) -> Column:
    """The value a matcher sees: the external label if set, else the stored one."""
    return F.coalesce(F.nullif(external[name], F.lit("")), own)


def overlay(labels: Column, external: Column) -> Column:
    """Add external labels; they win over stored ones of the same name.

    An external label with an empty value removes the stored label.
    """
    own = F.map_filter(labels, lambda name, _: ~F.map_contains_key(external, name))
    return F.map_concat(own, F.map_filter(external, lambda _, value: value != ""))


def drop(labels: Column, names: Iterable[str]) -> Column:
    """Remove the named labels; empty names in the list are ignored."""
    unwanted = drop_set(names)
    if not unwanted:
        return labels
    return F.map_filter(labels, lambda name, _: ~name.isin(unwanted))


def drop_set(*lists: Iterable[str]) -> list[str]:
    """The union of several name lists without empty names, in name order."""
    return sorted({name for names in lists for name in names if name})


def final(labels: Column, external: Column, dropped: Iterable[str] = ()) -> Column:
    """Overlay, then drop, so that a dropped name is gone wherever it came from."""
    return drop(overlay(labels, external), dropped)


def quoted(value: Column) -> Column:
    escaped = value
    for plain, escape in ESCAPES:
        escaped = F.replace(escaped, F.lit(plain), F.lit(escape))
    return F.concat(F.lit('"'), escaped, F.lit('"'))


def text_of_pairs(pairs: Column) -> Column:
    """``{a="1", b="2"}`` from canonical entries.

    Most label sets hold nothing to escape; one look over all names and values
    then saves the look at each.
    """

    def escaped(pair: Column) -> Column:
        name = F.when(pair["key"].rlike(PLAIN_NAME), pair["key"]).otherwise(quoted(pair["key"]))
        return F.concat(name, F.lit("="), quoted(pair["value"]))

    def simple(pair: Column) -> Column:
        return F.concat(pair["key"], F.lit('="'), pair["value"], F.lit('"'))

    values = F.array_join(pairs["value"], "")
    special = reduce(or_, (F.contains(values, F.lit(plain)) for plain, _ in ESCAPES))
    all_plain = ~special & ~F.exists(pairs, lambda pair: ~pair["key"].rlike(PLAIN_NAME))
    body = F.when(all_plain, F.transform(pairs, simple)).otherwise(F.transform(pairs, escaped))
    return F.concat(F.lit("{"), F.array_join(body, ", "), F.lit("}"))


def text(labels: Column) -> Column:
    """The text form of a label set, names in order."""
    return F.transform(F.array(canonical(labels)), text_of_pairs)[0]


def valid_plain_name(name: Column) -> Column:
    """The strict rule, used for configured external labels."""
    return F.coalesce(name.rlike(PLAIN_NAME), F.lit(False))


def valid_any_name(name: Column) -> Column:
    """The wide rule, used for announced labels: any non-empty UTF-8 text."""
    return F.coalesce((name != "") & F.is_valid_utf8(name), F.lit(False))
