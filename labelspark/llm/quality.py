"""Quality rules in a short-circuit cascade.

Each rule is a condition on a text and its statistics. On a sample, every rule is run alone: its time per row is its cost, its share of
rejected rows its selectivity. Rules are then asked in the order of rejection per cost, and a text that one rule
rejects is shown to no later one. The order only decides how fast the verdict comes, never what it is.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelspark.llm.common import BLANKS, cut, keyed, let

WORD = BLANKS.replace("[", "[^") + "+"
GRAM = 5
SYMBOLS = r"[#*$%&|<>]+"
SAMPLE_ROWS = 1000


@dataclass(frozen=True)
class Rule:
    """``passes`` is SQL over the columns of `statistics` and ``text``; it must not be null."""

    name: str
    passes: str


#: Whole numbers on both sides, so that no verdict hangs on rounding.
RULES = (
    Rule("some_letter", r"text RLIKE r'\p{L}'"),
    Rule("not_all_capitals", r"text RLIKE r'\p{Ll}' OR NOT text RLIKE r'\p{Lu}'"),
    Rule("few_symbols", "n_symbols <= n_words"),
    Rule("few_repeated_lines", "2 * n_dup_lines <= n_lines"),
    Rule("word_length", "word_chars <= 15 * n_words AND 2 * word_chars >= 3 * n_words"),
    Rule(
        "few_cut_lines",
        r"10 * size(regexp_extract_all(text, r'(?m)(\.\.\.|…)[\x20\x09\x0B-\x0D]*$', 0)) <= 3 * n_lines OR n_lines < 4",
    ),
)
#: What the sample run compares a rule with: a condition that costs next to nothing.
NOTHING = Rule("nothing", "n_words IS NOT NULL")


def repeated(words: Column) -> Column:
    """Words that lie in a window of ``GRAM`` words which occurs twice or more, the first one included."""

    def covered(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        same = let(
            pairs,
            lambda p: F.filter(
                p,
                lambda x, k: F.coalesce(F.get(p, k - 1)["h"] == x["h"], F.lit(False))
                | F.coalesce(F.get(p, k + 1)["h"] == x["h"], F.lit(False)),
            ),
        )
        places = F.array_sort(F.transform(same, lambda x: x["i"]))
        counted = F.aggregate(
            places,
            F.struct(F.lit(-GRAM).alias("last"), F.lit(0).alias("n")),
            lambda s, p: F.struct(p.alias("last"), (s["n"] + F.least(F.lit(GRAM), p - s["last"])).alias("n")),
            lambda s: s["n"],
        )
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), counted).otherwise(0)

    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - GRAM), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(GRAM)])
    )
    return F.when(F.size(words) > GRAM, let(windows, covered)).otherwise(0)


def statistics(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words of each whole text.

    ``n_lines`` counts lines with a word. A null text is an empty one, with zeros. Windows of words are compared by 64-bit hashes
    within one text.
    """
    found = keyed(docs, id_col, text_col).withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    found = found.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(BLANKS.replace("[", "[^"))))
    count = {
        "n_words": F.size("words"),
        "word_chars": F.length(F.array_join("words", "")),
        "n_symbols": F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, "")),
        "n_lines": F.size("lines"),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": repeated(F.col("words")),
    }
    return found.select("doc_id", "text", *[c.cast("bigint").alias(n) for n, c in count.items()])


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    seconds: float
    rejected: float

    @property
    def worth(self) -> float:
        return self.rejected / self.seconds


def estimates(stats: DataFrame, rules: tuple[Rule, ...] = RULES) -> list[Estimate]:
    """Cost and selectivity of each rule on the statistics of a sample."""
    sample = cut(stats)

    def run(rule: Rule) -> tuple[float, float]:
        begun = time.perf_counter()
        share = sample.agg(F.avg(F.expr(f"CASE WHEN {rule.passes} THEN 0.0D ELSE 1.0D END"))).first()[0]
        return time.perf_counter() - begun, share or 0.0

    run(NOTHING)
    least = run(NOTHING)[0]
    return [Estimate(rule, max(seconds - least, 1e-3), share) for rule in rules for seconds, share in [run(rule)]]


def ordered(found: list[Estimate]) -> list[Rule]:
    """Rules by rejection per cost; ties and rules that reject nothing by cost."""
    return [e.rule for e in sorted(found, key=lambda e: (-e.worth, e.seconds))]


def verdict(rules: list[Rule]) -> Column:
    """True if all rules pass, asked in order up to the first that fails."""
    asked = None
    for rule in rules:
        fails = ~F.expr(f"({rule.passes})")
        asked = F.when(fails, F.lit(False)) if asked is None else asked.when(fails, F.lit(False))
    return F.lit(True) if asked is None else asked.otherwise(F.lit(True))


def judged(docs: DataFrame, *, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, the statistics, base_failed and kept for each row.

    ``base_failed``: fewer than 10 words, or over a fifth of them in repeated windows. ``kept``: not that, and the cascade's verdict.
    Repeated rows give repeated results, an empty table none.
    """
    named = keyed(docs, id_col, text_col)
    ids = named.select("doc_id").orderBy(F.xxhash64("doc_id")).limit(sample_rows).distinct()
    sample = named.join(F.broadcast(ids), "doc_id", "left_semi").limit(sample_rows)
    order = ordered(estimates(statistics(sample), rules))
    failed = F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words")
    return (
        statistics(named)
        .withColumn("base_failed", failed)
        .withColumn("kept", F.when(F.col("base_failed"), F.lit(False)).otherwise(verdict(order)))
        .drop("text")
    )


def oracle() -> str:
    """DuckDB's form of the registered query."""
    return rf"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS text FROM documents
), w AS (
    SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM d
), win AS (
    SELECT doc_id, i, array_to_string(words[i:i + {GRAM - 1}], ' ') AS gram
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - {GRAM - 2})) AS i FROM w WHERE len(words) > {GRAM})
), often AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM win) WHERE n > 1
), gap AS (
    SELECT doc_id, least({GRAM}, i - coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -{GRAM})) AS more FROM often
), rep AS (
    SELECT doc_id, sum(more) AS n FROM gap GROUP BY doc_id
), s AS (
    SELECT doc_id, text, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
        length(text) - length(regexp_replace(text, '{SYMBOLS}', '', 'g')) AS n_symbols, len(lines) AS n_lines,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
    FROM w LEFT JOIN rep USING (doc_id)
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
    CAST(n_lines AS BIGINT) AS n_lines, CAST(n_dup_lines AS BIGINT) AS n_dup_lines, n_repeat_words,
    n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
        AND regexp_matches(text, '\p{{L}}')
        AND (regexp_matches(text, '\p{{Ll}}') OR NOT regexp_matches(text, '\p{{Lu}}'))
        AND n_symbols <= n_words AND 2 * n_dup_lines <= n_lines
        AND word_chars <= 15 * n_words AND 2 * word_chars >= 3 * n_words
        AND (n_lines < 4 OR 10 * len(list_filter(string_split(text, chr(10)),
            lambda x: regexp_matches(x, '(\.\.\.|\x{{2026}})[\x20\x09\x0B-\x0D]*$'))) <= 3 * n_lines) AS kept
FROM s
"""
