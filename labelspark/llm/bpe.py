"""Byte-pair encoding and decoding of a public word-end vocabulary.

A text is normalised and cut into words. Each word is encoded with a contiguous array of ranks: the boundaries of
its parts, and beside each part the rank of merging it with the next. The least rank is looked for over and
over (ties: leftmost), its boundary is deleted, and the ranks of the two neighbours are refreshed.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata

import numpy as np
import regex
from pyspark.sql import DataFrame

from labelspark.llm.common import keyed, map_text

# Fixed values of the vocabulary's file: what counts as a word, white space, the end mark.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")
BLANKS = regex.compile(r"\p{White_Space}+")
END = "</w>"
NEVER = 1 << 60
#: Words that a task remembers the ids of.
REMEMBERED = 200_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable bytes for themselves, others from U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class Vocabulary:
    """Ids, texts and merge ranks, read from the JSON file at ``path``."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        ids = given["model"]["vocab"]
        letters = byte_letters()
        self.inner = [ids[c] for c in letters]
        self.final = [ids[c + END] for c in letters]
        self.ranks: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, merge in enumerate(given["model"]["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            self.ranks.setdefault(ids[left] << 32 | ids[right], rank)
            self.merged.append(ids[left + right])
        self.texts = {i: t for t, i in ids.items()}
        self.special = {t["content"]: t["id"] for t in given["added_tokens"]}
        self.texts |= {i: t for t, i in self.special.items()}

    def encode_word(self, word: bytes) -> list[int]:
        parts = [self.inner[b] for b in word[:-1]]
        parts.append(self.final[word[-1]])
        ranks, merged = self.ranks.get, self.merged
        near = [ranks(a << 32 | b, NEVER) for a, b in zip(parts, parts[1:], strict=False)]
        while near:
            least = min(near)
            if least == NEVER:
                break
            at = near.index(least)
            parts[at] = merged[least]
            del parts[at + 1], near[at]
            if at:
                near[at - 1] = ranks(parts[at - 1] << 32 | parts[at], NEVER)
            if at < len(near):
                near[at] = ranks(parts[at] << 32 | parts[at + 1], NEVER)
        return parts

    def encode_long(self, word: bytes) -> list[int]:
        """The same for a long word: a heap of ranks and a linked list, so that no scan goes over the whole word."""
        from heapq import heapify, heappop, heappush

        parts = [self.inner[b] for b in word[:-1]]
        parts.append(self.final[word[-1]])
        n, ranks = len(parts), self.ranks.get
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := ranks(parts[i] << 32 | parts[i + 1])) is not None]
        heapify(heap)
        while heap:
            rank, i, left, right = heappop(heap)
            j = after[i] if alive[i] else n
            if j == n or parts[i] != left or parts[j] != right:
                continue
            parts[i], alive[j], after[i] = self.merged[rank], False, after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (r := ranks(parts[a] << 32 | parts[b])) is not None:
                    heappush(heap, (r, a, parts[a], parts[b]))
        return [p for p, a in zip(parts, alive, strict=True) if a]


#: Bytes from which a word counts as long.
LONG = 512


class Encoder(dict):
    """Ids and decoded text by word; a missing word is encoded once and remembered, up to a bound."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.special = regex.compile("|".join(map(regex.escape, vocabulary.special))) if vocabulary.special else None

    def __missing__(self, word: str) -> tuple[list[int], str]:
        data = word.encode()
        vocabulary = self.vocabulary
        ids = vocabulary.encode_word(data) if len(data) < LONG else vocabulary.encode_long(data)
        found = (ids, " ".join([vocabulary.texts[i] for i in ids]))
        if len(data) < LONG:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = found
        return found

    def words(self, text: str) -> list[str]:
        plain = BLANKS.sub(" ", unicodedata.normalize("NFC", text))
        if "Σ" in plain:  # lower case goes by single characters
            plain = plain.replace("Σ", "σ")
        return WORDS.findall(plain.lower())

    def encode(self, text: str) -> tuple[list[int], str]:
        """The ids of a whole text and the text of these ids."""
        parts: list[tuple[list[int], str]] = []
        at = 0
        for match in self.special.finditer(text) if self.special else ():
            parts += [self[w] for w in self.words(text[at : match.start()])]
            parts.append(([self.vocabulary.special[match[0]]], match[0]))
            at = match.end()
        parts += [self[w] for w in self.words(text[at:])]
        ids: list[int] = []
        for part in parts:
            ids += part[0]
        return ids, " ".join([part[1] for part in parts])


def decode(vocabulary: Vocabulary, ids: list[int]) -> str:
    """The texts of the ids, joined by blanks, as the vocabulary's file names no decoder; unknown ids have none."""
    return " ".join([vocabulary.texts[i] for i in ids if i in vocabulary.texts])


def encode(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array of int), decoded (text of the ids) for each row; a null text is an empty one, which has no ids.

    ``path`` is read on the driver; the vocabulary, whose size is fixed, goes along with the tasks.
    """
    vocabulary = Vocabulary(path)
    return _mapped(docs, vocabulary, id_col, text_col, "ids array<int>, decoded string", lambda ids, text: [ids, text])


def digests(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of what `encode` returns, without moving it out of the tasks."""

    def row(ids: list[int], text: str) -> list:
        return [len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()]

    schema = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return _mapped(docs, Vocabulary(path), id_col, text_col, schema, row)


def _mapped(docs: DataFrame, vocabulary: Vocabulary, id_col: str, text_col: str, schema: str, row) -> DataFrame:
    encoders: list[Encoder] = []

    def rows_of(ids: list, texts: list) -> list[list]:
        if not encoders:
            encoders.append(Encoder(vocabulary))
        found = [row(*encoders[0].encode(t)) for t in texts]
        return [ids, *([f[i] for f in found] for i in range(len(schema.split(", "))))]

    named = keyed(docs, id_col, text_col)
    kind = named.schema["doc_id"].dataType.simpleString()
    return map_text(named, f"doc_id {kind}, {schema}", rows_of, "doc_id", "text")
