"""Language identification by known words, with a fall back to ever shorter character n-grams.

The model has, per language, the log frequency of known words and of the character n-grams of words.
A known word scores by its frequency; an unseen word is covered by n-grams instead, at each position by
the longest one known (4, 3, 2, then 1 characters). The scores of all words of the whole text are added up.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelspark.llm.common import cut, keyed, map_text, slices

UNKNOWN = "und"
WORDS = re.compile(r"[^\W\d_]+")
LONGEST = 4
#: Words that a task remembers the scores of, besides those of the model.
REMEMBERED = 300_000


def words_of(text: str) -> list[str]:
    """Runs of letters in lower case; a run of signs that only count as letters in part (such as raised digits) is none."""
    found = WORDS.findall(text.lower())
    return found if "".join(found).isalpha() else [w for w in found if any(map(str.isalpha, w))]


def grams_of(word: str) -> list[str]:
    marked = f"^{word}$"
    return [marked[i : i + n] for n in range(1, LONGEST + 1) for i in range(len(marked) - n + 1)]


@dataclass
class Model:
    """Rows of log frequencies by language, each less its mean, so that a row only tells languages apart."""

    langs: list[str]
    words: dict[str, int] = field(default_factory=dict)
    grams: dict[str, int] = field(default_factory=dict)
    scores: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))

    def unseen(self, word: str) -> np.ndarray:
        """Mean over the positions of the longest known n-gram that starts there."""
        marked, rows, grams = f"^{word}$", [], self.grams
        for i in range(len(marked)):
            for n in range(LONGEST, 0, -1):
                row = grams.get(marked[i : i + n])
                if row is not None:
                    rows.append(row)
                    break
        return self.scores[rows].mean(axis=0) if rows else np.zeros(len(self.langs))


class Scorer(dict):
    """Rows of scores by word; a missing word is scored once and remembered, up to a bound."""

    def __init__(self, model: Model) -> None:
        super().__init__(model.words)
        self.model, self.base = model, len(model.scores)
        self.table = np.vstack([model.scores, np.zeros((REMEMBERED, len(model.langs)))])
        self.used = self.base

    def __missing__(self, word: str) -> int:
        row = self.used
        self.table[row] = self.model.unseen(word)
        self[word] = row
        self.used += 1
        return row

    def predict(self, text: str | None) -> tuple[str, float]:
        words = words_of(text) if text else []
        if not words or not self.model.langs:
            return UNKNOWN, 0.0
        total = np.zeros(len(self.model.langs))
        for at in range(0, len(words), 100_000):
            part = words[at : at + 100_000]
            if self.used + len(part) > len(self.table):
                self.clear()
                self.update(self.model.words)
                self.used = self.base
            total += self.table[[self[w] for w in part]].sum(axis=0)
        best = int(total.argmax())
        return self.model.langs[best], float(1 / np.exp(total - total[best]).sum())


def held_out(id_col: Column) -> Column:
    """Whether a document belongs to the fifth that is never learned from; false for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 5 == 0, F.lit(False))


def sampled(docs: DataFrame, rows_per_lang: int, max_langs: int) -> DataFrame:
    """About ``rows_per_lang`` labelled documents of each language outside the held-out fifth, by a hash of the id.

    A document without an id or a language is not among them. More than ``max_langs`` languages are refused.
    """
    labelled = docs.filter("lang IS NOT NULL AND doc_id IS NOT NULL").filter(~held_out(F.col("doc_id")))
    counts = labelled.groupBy("lang").count().orderBy("lang").limit(max_langs + 1).collect()
    if len(counts) > max_langs:
        raise ValueError(f"there are more than {max_langs} languages to learn; max_langs allows for more")
    share = None
    for row in counts:
        part = F.lit(min(1.0, rows_per_lang / row["count"]))
        share = F.when(F.col("lang") == row["lang"], part) if share is None else share.when(F.col("lang") == row["lang"], part)
    if share is None:
        return labelled.limit(0)
    return labelled.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share * (1 << 20))


def fit(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    rows_per_lang: int = 2000,
    max_words: int = 50_000,
    max_grams: int = 50_000,
    max_langs: int = 1000,
) -> Model:
    """Learn from labelled documents outside the held-out fifth.

    ``rows_per_lang`` bounds the labelled sample, ``max_words`` and ``max_grams`` (the most frequent, ties by text) the
    model, which is what is sent to the tasks: at most 100,000 rows of one number per language. All languages are learned; more than
    ``max_langs`` of them are an error. Rows without
    text, language or id teach nothing; without any labelled row the model knows no language.
    """
    named = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang")
    )

    def count(batches):
        for batch in batches:
            seen: Counter = Counter()
            for part in slices(batch):
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    seen.update((lang, word) for word in words_of(text))
            yield counted(seen)

    def spell(batches):
        for batch in batches:
            seen: Counter = Counter()
            for lang, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for gram in grams_of(word):
                    seen[lang, gram] += n
            yield counted(seen)

    def counted(seen: Counter) -> pa.RecordBatch:
        langs, tokens = zip(*seen, strict=True) if seen else ((), ())
        columns = [pa.array(langs, pa.string()), pa.array(tokens, pa.string()), pa.array(list(seen.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["lang", "token", "n"])

    schema = "lang string, token string, n bigint"
    sample = sampled(named, rows_per_lang, max_langs).filter("text IS NOT NULL").select("lang", "text")
    words = cut(sample.mapInArrow(count, schema).groupBy("lang", "token").agg(F.sum("n").alias("n")))
    grams = words.mapInArrow(spell, schema)

    def most(counts: DataFrame, least: int, rows: int) -> list:
        by_token = counts.groupBy("token", "lang").agg(F.sum("n").alias("n")).groupBy("token")
        entries = F.map_from_entries(F.collect_list(F.struct("lang", "n")))
        tokens = by_token.agg(F.sum("n").alias("n"), entries.alias("by_lang")).filter(F.col("n") >= least)
        return tokens.orderBy(F.desc("n"), "token").limit(rows).collect()

    found = {True: most(words, 2, max_words), False: most(grams, 1, max_grams)}
    langs = sorted({lang for rows in found.values() for r in rows for lang in r["by_lang"]})
    model, scores = Model(langs), []
    for kind, rows in found.items():
        n = np.array([[r["by_lang"].get(lang, 0) for lang in langs] for r in rows], dtype=float).reshape(len(rows), len(langs))
        logs = np.log((n + 0.5) / (n.sum(axis=0) + 0.5 * max(1, len(rows))))
        logs -= logs.mean(axis=1, keepdims=True) if langs else 0
        at = sum(map(len, scores))
        (model.words if kind else model.grams).update({r["token"]: at + i for i, r in enumerate(rows)})
        scores.append(logs)
    model.scores = np.vstack(scores)
    return model


def predict(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of each row, from the text alone.

    ``lang_pred`` is ``und`` with score 0 where the text is null or has no letter, or the model knows no
    language; else the language with the greatest sum (ties: the first by name), and ``score`` its posterior
    probability under equal priors. Repeated rows give repeated results; an empty table gives none.
    """
    scorers: list[Scorer] = []

    def rows_of(ids: list, texts: list) -> list[list]:
        if not scorers:
            scorers.append(Scorer(model))
        found = [scorers[0].predict(t) for t in texts]
        return [ids, [f[0] for f in found], [f[1] for f in found]]

    named = keyed(docs, id_col, text_col)
    kind = named.schema["doc_id"].dataType.simpleString()
    return map_text(named, f"doc_id {kind}, lang_pred string, score double", rows_of, "doc_id", "text")


def identify(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **limits) -> DataFrame:
    """doc_id, held_out, lang_pred, score: `predict` with the model of `fit` on the same rows."""
    model = fit(docs, id_col=id_col, text_col=text_col, lang_col=lang_col, **limits)
    found = predict(docs, model, id_col=id_col, text_col=text_col)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def accepted(docs: DataFrame, *, min_score: float = 0.4, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **limits) -> DataFrame:
    """The rows, with all their columns, whose text is in some language with at least ``min_score``.

    The model goes along with the tasks, so rows are filtered where they lie. Rejected: null texts, texts without a letter, and texts
    that fit no language clearly better than the others.
    """
    model = fit(docs, id_col=id_col, text_col=text_col, lang_col=lang_col, **limits)
    scorers: list[Scorer] = []
    at = docs.columns.index(text_col)

    def keep(batches):
        if not scorers:
            scorers.append(Scorer(model))
        for batch in batches:
            for part in slices(batch):
                found = [scorers[0].predict(t) for t in part.column(at).to_pylist()]
                yield part.filter(pa.array([lang != UNKNOWN and score >= min_score for lang, score in found], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
