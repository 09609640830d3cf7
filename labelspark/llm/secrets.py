"""Secrets in texts: three fixed patterns, and strings whose characters are spread too evenly for words.

Everything is made of Spark's own functions. A candidate string is a long run of letters, digits and ``+/_=-``. A window
slides over it one character at a time; the counts of the window's characters are kept up by adding the
character that enters and taking off the one that leaves, and the entropy with them. What counts as evenly spread hangs on the class of the
window's characters: random hex digits spread less than random letters and digits. Windows that reach into a part with a word of the allow-list
are passed over.
"""

from __future__ import annotations

import math
from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelspark.llm.common import keyed, let, spans_text

# The patterns, their order and their least lengths.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
ASSIGN_LEAST = 8

KINDS = ("assign", "access", "hex", "entropy")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
HEX_DIGITS = "0123456789abcdefABCDEF"
WINDOW = 20
#: Bits per character by which a window may stay below what that many random draws from its class's alphabet have on average.
MARGIN = 0.36


def expected_bits(letters: int) -> float:
    """The mean entropy per character of a window of random draws from so many letters."""
    some = range(2, WINDOW + 1)
    one = sum(comb(WINDOW, c) / letters**c * (1 - 1 / letters) ** (WINDOW - c) * c * math.log2(c) for c in some)
    return math.log2(WINDOW) - letters * one / WINDOW


#: Classes of windows: hex digits and dashes, small letters and digits, capitals and digits, letters of both cases, letters of both
#: cases and digits with few separators; each with the least bits of its alphabet. A window of any characters with a digit needs 3.9.
LEAST_BITS = {name: expected_bits(n) - MARGIN for name, n in (("hex", 16), ("lower", 36), ("upper", 32), ("letters", 52), ("mixed", 64))}
LEAST_BITS["any"] = 3.9
#: The part between separators that holds one of these is no secret: alphabets, placeholders.
ALLOWED = ("abcdefghij", "0123456789", "example", "placeholder", "changeme")
#: Whole numbers stand for c * log2(c) so that sums do not depend on their order.
UNIT = 1 << 20


def located(text: Column, pattern: str, kind: str) -> Column:
    """Leftmost matches without overlap, as an array of (start, kind, end, value) in code points."""
    empty = F.expr("cast(array() as array<struct<start: int, kind: string, end: int, value: string>>)")

    def walked(both: Column) -> Column:
        def step(done: Column, i: Column) -> Column:
            start = done["at"] + F.length(F.get(both["gaps"], i))
            value = F.get(both["found"], i)
            end = start + F.length(value)
            match = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), value.alias("value"))
            return F.struct(end.alias("at"), F.concat(done["spans"], F.array(match)).alias("spans"))

        every = F.sequence(F.lit(0), F.size(both["found"]) - 1)
        return F.aggregate(every, F.struct(F.lit(0).alias("at"), empty.alias("spans")), step, lambda done: done["spans"])

    def of(found: Column) -> Column:
        both = F.struct(found.alias("found"), F.split(text, pattern, -1).alias("gaps"))
        return F.when(F.size(found) > 0, let(both, walked)).otherwise(empty)

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), of)


def _xlog(count: int) -> int:
    return round(count * math.log2(count) * UNIT) if count else 0


def _most(bits: float) -> int:
    """The greatest sum of c * log2(c) over a window with at least so many bits per character."""
    return int((math.log2(WINDOW) - bits) * WINDOW * UNIT)


def least_of(c: dict[str, str]) -> list[tuple[str, str]]:
    """The classes and their conditions on a window's counts of digits (d), small letters (l), capitals (u), separators (s) and
    characters other than hex digits and dashes (x), given what these are called."""
    return [
        ("hex", f"{c['x']} = 0 AND {c['d']} > 0 AND {c['l']} + {c['u']} > 0"),
        ("lower", f"{c['u']} + {c['s']} = 0 AND {c['d']} >= 2 AND {c['l']} > 0"),
        ("upper", f"{c['l']} + {c['s']} = 0 AND {c['d']} >= 1 AND {c['u']} > 0"),
        ("letters", f"{c['d']} + {c['s']} = 0 AND {c['l']} >= 4 AND {c['u']} >= 4"),
        ("mixed", f"{c['s']} <= 3 AND {c['d']} >= 1 AND {c['l']} >= 2 AND {c['u']} >= 2"),
        ("any", f"{c['d']} >= 1"),
    ]


def evenly_spread(c: dict[str, str], total: str) -> str:
    """SQL for a window that is suspect by one of the classes."""
    return " OR ".join(f"({total} <= {_most(LEAST_BITS[name])} AND {fits})" for name, fits in least_of(c))


def passed_over(value: Column, allowed: tuple[str, ...]) -> Column:
    """(start, end) of the parts between separators that hold a word of the allow-list."""
    words = "(?i)" + "|".join(allowed)

    def part(s: Column) -> Column:
        before = F.regexp_extract(F.reverse(F.substring(value, F.lit(1), s["start"])), "^[A-Za-z0-9]*", 0)
        after = F.regexp_extract(F.substring(value, s["end"] + 1, F.length(value)), "^[A-Za-z0-9]*", 0)
        return F.struct((s["start"] - F.length(before)).alias("start"), (s["end"] + F.length(after)).alias("end"))

    none = F.expr("cast(array() as array<struct<start: int, end: int>>)")
    return F.when(value.rlike(words), F.transform(located(value, words, ""), part)).otherwise(none) if allowed else none


def suspect(value: Column, allowed: tuple[str, ...]) -> Column:
    """(first, last) of each stretch of suspect windows of a candidate that meet: from the first one's start to the last one's end."""
    sums = F.array(*[F.lit(_xlog(c)).cast("bigint") for c in range(WINDOW + 1)])
    codes = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    kinds = "".join("u" if c.isupper() else "l" if c.islower() else "d" if c.isdigit() else "s" for c in ALPHABET)
    hexes = "".join("h" if c in HEX_DIGITS + "-" else "x" for c in ALPHABET)
    none = F.expr("cast(array() as array<struct<first: int, last: int>>)")
    start = F.struct(
        F.array_repeat(F.lit(0), len(ALPHABET)).alias("counts"),
        F.lit(0).cast("bigint").alias("total"),
        *[F.lit(0).alias(k) for k in "dlusx"],
        F.lit(-1).alias("first"),
        F.lit(-1).alias("last"),
        none.alias("spans"),
    )

    def stretch(s: Column) -> Column:
        return F.array(F.struct(s["first"].alias("first"), s["last"].alias("last")))

    def walked(both: Column) -> Column:
        def moved(s: Column, i: Column) -> Column:
            """The counts and their sum with the window one character on."""
            codes = both["codes"]
            return let(
                F.struct(F.get(codes, i).alias("new"), F.coalesce(F.get(codes, i - WINDOW), F.lit(-1)).alias("old")),
                lambda x: F.struct(
                    F.transform(
                        s["counts"], lambda c, k: c + (k == x["new"]).cast("int") - (k == x["old"]).cast("int")
                    ).alias("counts"),
                    F.when(x["new"] == x["old"], s["total"])
                    .otherwise(
                        s["total"]
                        + let(F.get(s["counts"], x["new"]), lambda n: F.get(sums, n + 1) - F.get(sums, n))
                        + F.coalesce(let(F.get(s["counts"], x["old"]), lambda n: F.get(sums, n - 1) - F.get(sums, n)), F.lit(0))
                    )
                    .alias("total"),
                    *[(s[k] + one_of(table, k, x["new"]) - one_of(table, k, x["old"])).alias(k) for k, table in tables],
                ),
            )

        def judged(s: Column, i: Column, x: Column) -> Column:
            begin = i - (WINDOW - 1)
            even = F.lit(False)
            for name, fits in least_of({k: k for k in "dlusx"}):
                even = even | ((x["total"] <= _most(LEAST_BITS[name])) & conditions(fits, x))
            clear = ~F.exists(both["passed"], lambda p: (p["start"] <= i) & (p["end"] > begin))
            return let(
                F.struct(((begin >= 0) & even & clear).alias("hot"), begin.alias("begin")),
                lambda h: F.struct(
                    *[x[name].alias(name) for name in ("counts", "total", *"dlusx")],
                    F.when(~h["hot"], s["first"]).when((s["first"] < 0) | (h["begin"] > s["last"]), h["begin"]).otherwise(s["first"]).alias("first"),
                    F.when(h["hot"], i + 1).otherwise(s["last"]).alias("last"),
                    F.when(h["hot"] & (s["first"] >= 0) & (h["begin"] > s["last"]), F.concat(s["spans"], stretch(s)))
                    .otherwise(s["spans"])
                    .alias("spans"),
                ),
            )

        return F.aggregate(
            F.sequence(F.lit(0), F.size(both["codes"]) - 1),
            start,
            lambda s, i: let(moved(s, i), lambda x: judged(s, i, x)),
            lambda s: F.when(s["first"] < 0, s["spans"]).otherwise(F.concat(s["spans"], stretch(s))),
        )

    tables = [*((k, kinds) for k in "dlus"), ("x", hexes)]
    return let(F.struct(codes.alias("codes"), passed_over(value, allowed).alias("passed")), walked)


def one_of(table: str, kind: str, code: Column) -> Column:
    """1 if the character of a code is of a kind, else 0; none for a code below 0."""
    return (F.substring(F.lit(table), code + 1, F.lit(1)) == kind).cast("int") * (code >= 0).cast("int")


def conditions(text: str, x: Column) -> Column:
    """A conjunction as in `least_of` on the fields of a struct."""
    done = F.lit(True)
    for clause in text.split(" AND "):
        left, sign, right = clause.rsplit(" ", 2)
        value = sum((x[name] for name in left.split(" + ")), F.lit(0))
        done = done & {"=": value == int(right), ">": value > int(right), ">=": value >= int(right), "<=": value <= int(right)}[sign]
    return done


def uneven(text: Column, allowed: tuple[str, ...]) -> Column:
    """Spans of kind ``entropy``."""
    found = located(text, rf"[A-Za-z0-9+/_=-]{{{WINDOW},}}", "entropy")

    def placed(s: Column) -> Column:
        return F.transform(
            suspect(s["value"], allowed),
            lambda h: F.struct(
                (s["start"] + h["first"]).alias("start"), F.lit("entropy").alias("kind"), (s["start"] + h["last"]).alias("end")
            ),
        )

    return F.flatten(F.transform(found, placed))


def ordered(spans: Column) -> Column:
    """By start, then by kind as listed."""
    rank = {k: i for i, k in enumerate(KINDS)}

    def place(s: Column) -> Column:
        at = F.lit(rank[KINDS[0]])
        for kind in KINDS[1:]:
            at = F.when(s["kind"] == kind, rank[kind]).otherwise(at)
        return at

    keyed_spans = F.transform(
        spans, lambda s: F.struct(s["start"].alias("start"), place(s).alias("rank"), s["kind"].alias("kind"), s["end"].alias("end"))
    )
    return F.transform(
        F.array_sort(keyed_spans), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))
    )


def reached(s: Column) -> Column:
    """Up to where the spans of ``base``, which are in order, cover a span from its start without a gap."""
    return F.aggregate(
        "base", s["start"], lambda at, b: F.when(b["start"] <= at, F.greatest(at, b["end"])).otherwise(at)
    )


def with_spans(df: DataFrame, text: Column, *, allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """Adds ``base`` and ``spans``: arrays of (start, kind, end) in order; ``spans`` has the suspect strings, too.

    Suspect strings that lie wholly within base spans are left out, as that secret is found already. One that reaches
    beyond them stays, as it may hold another secret.
    """
    assigned = F.filter(
        located(text, ASSIGN, "assign"), lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 1)) >= ASSIGN_LEAST
    )
    base = F.concat(assigned, located(text, ACCESS, "access"), located(text, HEX, "hex"))
    plain = F.transform(base, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    more = F.filter(uneven(text, allowed), lambda s: reached(s) < s["end"])
    return df.withColumn("base", ordered(plain)).withColumn("spans", ordered(F.concat("base", more)))


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """doc_id, base, spans of each row; null and empty texts have none. Repeated rows give repeated results."""
    return with_spans(keyed(docs, id_col, text_col), F.col("text"), allowed=allowed).select("doc_id", "base", "spans")


def summary(scanned: DataFrame) -> DataFrame:
    """Counts of base spans by kind, their digest, and all spans as text."""

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return scanned.select(
        "doc_id",
        *[count(k) for k in KINDS[:3]],
        F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
    )


def redacted(docs: DataFrame, *, text_col: str = "text", chars_col: str | None = None, mark: str = "[SECRET]", allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """The rows with each stretch of overlapping spans replaced by ``mark``; ``chars_col`` gets the new length.

    Texts without secrets, null ones among them, stay as they are, and so does their ``chars_col``.
    """
    text = F.col(f"row.`{text_col}`")
    packed = docs.select(F.struct("*").alias("row"))
    found = with_spans(packed, F.coalesce(text, F.lit("")), allowed=allowed)
    done = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda s, x: F.struct(
            F.greatest(s["at"], x["end"]).alias("at"),
            F.when(x["start"] < s["at"], s["out"])
            .otherwise(F.concat(s["out"], F.substring(text, s["at"] + 1, x["start"] - s["at"]), F.lit(mark)))
            .alias("out"),
        ),
        lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))),
    )
    held = F.size("spans") > 0
    new = found.select("row", F.when(held, done).otherwise(text).alias("clean"), held.alias("held"))

    def column(name: str) -> Column:
        own = F.col(f"row.`{name}`")
        if name == text_col:
            return F.col("clean").alias(name)
        if name == chars_col:
            return F.when(F.col("held"), F.length("clean").cast(docs.schema[name].dataType)).otherwise(own).alias(name)
        return own.alias(name)

    return new.select(*[column(c) for c in docs.columns])


def oracle() -> str:
    """DuckDB's form of the registered query."""

    def either(word: str) -> str:
        return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)

    inner = ASSIGN.split("(?i:")[1].split(")")[0]
    assign = ASSIGN.replace(f"(?i:{inner})", "(?:" + "|".join(either(w) for w in inner.split("|")) + ")").replace("'", "''")
    listed = "(?i)" + "|".join(ALLOWED)
    tests = {"d": "[^0-9]", "l": "[^a-z]", "u": "[^A-Z]", "s": "[^+/_=-]", "x": "[0-9a-fA-F-]"}  # what is left is counted
    counts = {k: f"length(regexp_replace(part, '{p}', '', 'g'))" for k, p in tests.items()}
    return rf"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS text FROM documents
), found AS (
    SELECT doc_id, 0 AS place, 'assign' AS kind, regexp_extract_all(text, '{assign}') AS hits, string_split_regex(text, '{assign}') AS gaps FROM d
    UNION ALL SELECT doc_id, 1, 'access', regexp_extract_all(text, '{ACCESS}'), string_split_regex(text, '{ACCESS}') FROM d
    UNION ALL SELECT doc_id, 2, 'hex', regexp_extract_all(text, '{HEX}'), string_split_regex(text, '{HEX}') FROM d
    UNION ALL SELECT doc_id, 3, 'entropy', regexp_extract_all(text, '[A-Za-z0-9+/_=-]{{{WINDOW},}}'),
        string_split_regex(text, '[A-Za-z0-9+/_=-]{{{WINDOW},}}') FROM d
), numbered AS (
    SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM found WHERE len(hits) > 0
), placed AS (
    SELECT doc_id, place, kind, hits[i] AS value,
        CAST(list_sum(list_transform(gaps[1:i], lambda g: length(g))) + list_sum(list_transform(hits[1:i], lambda h: length(h)))
            - length(hits[i]) AS BIGINT) AS start
    FROM numbered
), base AS (
    SELECT doc_id, place, kind, start, start + length(value) AS stop FROM placed
    WHERE place < 3 AND (place > 0 OR length(regexp_extract(value, '{assign}', 1)) >= {ASSIGN_LEAST})
), islands AS (
    SELECT doc_id, min(start) AS start, max(stop) AS stop FROM (
        SELECT *, sum(CASE WHEN start <= reach THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY start, place, stop ROWS UNBOUNDED PRECEDING) AS island FROM (
            SELECT *, max(stop) OVER (PARTITION BY doc_id ORDER BY start, place, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM base))
    GROUP BY doc_id, island
), candidates AS (
    SELECT doc_id, start, value, regexp_extract_all(value, '{listed}') AS hits, string_split_regex(value, '{listed}') AS gaps FROM placed WHERE place = 3
), words AS (
    SELECT doc_id, start, value, unnest(range(1, len(hits) + 1)) AS i, hits, gaps FROM candidates WHERE len(hits) > 0
), located AS (
    SELECT doc_id, start, value, length(hits[i]) AS n,
        CAST(list_sum(list_transform(gaps[1:i], lambda g: length(g))) + list_sum(list_transform(hits[1:i], lambda h: length(h)))
            - length(hits[i]) AS BIGINT) AS pos FROM words
), passed AS (
    SELECT doc_id, start, pos - length(regexp_extract(reverse(substr(value, 1, pos)), '^[A-Za-z0-9]*')) AS low,
        pos + n + length(regexp_extract(substr(value, pos + n + 1), '^[A-Za-z0-9]*')) AS high FROM located
), windows AS (
    SELECT doc_id, start, unnest(range(0, length(value) - {WINDOW - 1})) AS k, value FROM candidates
), chars AS (
    SELECT doc_id, start, k, substr(value, k + 1, {WINDOW}) AS part, unnest(string_split(substr(value, k + 1, {WINDOW}), '')) AS c FROM windows
), counts AS (
    SELECT doc_id, start, k, part, c, count(*) AS n FROM chars GROUP BY ALL
), sums AS (
    SELECT doc_id, start, k, part, sum(CAST(round(n * log2(n) * {UNIT}) AS BIGINT)) AS total FROM counts GROUP BY ALL
), even AS (
    SELECT doc_id, start, k FROM sums WHERE ({evenly_spread(counts, "total")})
        AND NOT EXISTS (SELECT 1 FROM passed p WHERE p.doc_id = sums.doc_id AND p.start = sums.start AND p.low < k + {WINDOW} AND p.high > k)
), parted AS (
    SELECT *, start AS parted_start, CASE WHEN k - lag(k) OVER (PARTITION BY doc_id, start ORDER BY k) <= {WINDOW} THEN 0 ELSE 1 END AS fresh FROM even
), hot AS (
    SELECT doc_id, parted_start + min(k) AS start, parted_start + max(k) + {WINDOW} AS stop FROM (
        SELECT doc_id, parted_start, k, sum(fresh) OVER (PARTITION BY doc_id, start ORDER BY k ROWS UNBOUNDED PRECEDING) AS stretch FROM parted)
    GROUP BY doc_id, parted_start, stretch
), spans AS (
    SELECT * FROM base
    UNION ALL
    SELECT doc_id, 3, 'entropy', start, stop FROM hot
    WHERE NOT EXISTS (SELECT 1 FROM islands b WHERE b.doc_id = hot.doc_id AND b.start <= hot.start AND b.stop >= hot.stop)
), shown AS (
    SELECT doc_id, count(*) FILTER (place = 0) AS n_assign, count(*) FILTER (place = 1) AS n_access, count(*) FILTER (place = 2) AS n_hex,
        string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) FILTER (place < 3) AS base_s,
        string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) AS spans
    FROM spans GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    sha256(coalesce(base_s, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN shown USING (doc_id)
"""
