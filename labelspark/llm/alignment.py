"""Two tokenizers on the same bytes: which tokens overlap, where both end, and how often ids meet over the corpus.

Texts are taken in batches of some million characters. The tokens of both sides lie one after the other over the bytes of a space and the text, so a
token's start says which token of the other side covers it: `pandas.merge_asof`, keyed by document, finds it for all tokens of a
batch, once from each side. The union of both directions is all pairs of overlapping tokens, as the later start of the
two lies in the other token. Where tokens of both sides end at the same byte, a group ends.

How often two ids meet is counted over the whole corpus without moving a document: each batch hands on its distinct pairs with their counts,
asks for their totals once they are known, and gives them to its documents. What is shuffled are the distinct pairs of batches.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelspark.llm.common import keyed, shared_folder
from labelspark.llm.tokens import ByteLevel

#: Code points after which a batch is full; a longer text is a batch of its own.
BATCH_CHARS = 2_000_000


class Pieces:
    """The piece vocabulary of a SentencePiece model: the bytes of each id, and its encoder, which adds a space itself."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        with open(path, "rb") as file:
            self.model = file.read()
        self._encoder = None
        encoder = sentencepiece.SentencePieceProcessor(model_proto=self.model)
        self.bytes = [self._bytes(encoder.id_to_piece(i)) for i in range(encoder.get_piece_size())]

    @staticmethod
    def _bytes(piece: str) -> bytes:
        if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_encoder": None}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if self._encoder is None:
            import sentencepiece

            self._encoder = sentencepiece.SentencePieceProcessor(model_proto=self.model)
        return [np.array(ids, "int64") for ids in self._encoder.encode(texts, num_threads=1)]


@dataclass
class Side:
    """The tokens of one side in a batch: ids, and documents and bytes over the batch that they lie in."""

    ids: np.ndarray
    doc: np.ndarray
    at: np.ndarray
    until: np.ndarray
    #: Where the tokens of each document begin, and of the last one end.
    first: np.ndarray

    @classmethod
    def of(cls, ids: list[np.ndarray], lengths: np.ndarray) -> Side:
        many = np.array([len(i) for i in ids], "int64")
        flat = np.concatenate([np.empty(0, "int64"), *ids])
        until = np.cumsum(lengths[flat])
        first = np.concatenate([[0], np.cumsum(many)])
        return cls(flat, np.repeat(np.arange(len(ids)), many), until - lengths[flat], until, first)

    def frame(self, name: str) -> pd.DataFrame:
        return pd.DataFrame({"doc": self.doc, "at": self.at, name: np.arange(len(self.ids))})


@dataclass
class Aligned:
    """A batch of texts: both sides, the overlapping pairs as positions of tokens, and the number of each token's group."""

    a: Side
    b: Side
    link_a: np.ndarray
    link_b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    n_groups: np.ndarray

    @property
    def link_doc(self) -> np.ndarray:
        return self.a.doc[self.link_a]


class Aligner:
    """Both vocabularies, and the alignment of texts by them."""

    def __init__(self, byte_path: str, piece_path: str) -> None:
        self.a, self.b = ByteLevel(byte_path), Pieces(piece_path)
        most = max(len(self.a.bytes), len(self.b.bytes))
        self.ends = [f"{i}{mark}" for mark in ",|;" for i in range(most)]
        self.most = most

    def tokens(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both sides; none for an empty text or one whose bytes the tokens of a side do not give back."""
        none = np.empty(0, "int64")
        a_bytes, b_bytes = self.a.bytes.__getitem__, self.b.bytes.__getitem__
        found_a, found_b = [none] * len(texts), self.b.encode(texts)
        for i, text in enumerate(texts):
            data = b" " + text.encode()
            if not text or b"".join(map(b_bytes, found_b[i].tolist())) != data:
                found_b[i] = none
                continue
            found_a[i] = self.a.encode(" " + text)
            if b"".join(map(a_bytes, found_a[i].tolist())) != data:
                found_a[i] = found_b[i] = none
        return found_a, found_b

    def align(self, texts: list[str]) -> Aligned:
        found = self.tokens(texts)
        a, b = (Side.of(ids, np.array([len(t) for t in v.bytes])) for ids, v in zip(found, (self.a, self.b), strict=True))
        frame_a, frame_b = a.frame("a"), b.frame("b")
        over_a = pd.merge_asof(frame_a, frame_b, on="at", by="doc")["b"].to_numpy("int64")
        over_b = pd.merge_asof(frame_b, frame_a, on="at", by="doc")["a"].to_numpy("int64")
        # Tokens that start together are found from both sides and counted once.
        inside = b.at != a.at[over_b]
        link_a = np.concatenate([np.arange(len(a.ids)), over_b[inside]])
        link_b = np.concatenate([over_a, np.flatnonzero(inside)])
        cuts = np.intersect1d(a.until, b.until, assume_unique=True)
        group_a, group_b = np.searchsorted(cuts, a.until), np.searchsorted(cuts, b.until)
        ends = a.doc[np.searchsorted(a.until, cuts)]
        n_groups = np.bincount(ends, minlength=len(texts))
        return Aligned(a, b, link_a, link_b, group_a, group_b, n_groups)

    def group_texts(self, found: Aligned) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` for each text: decimal ids of both sides, group by group."""
        if not len(found.a.ids):
            return [""] * (len(found.a.first) - 1)
        a, b = found.group_a, found.group_b
        place_a = np.arange(len(a)) + np.searchsorted(b, a, "left")
        place_b = np.arange(len(b)) + np.searchsorted(a, b, "right")
        last_a, last_b = np.diff(a, append=a[-1] + 1) > 0, np.diff(b, append=b[-1] + 1) > 0
        items = np.empty(len(a) + len(b), "int64")
        items[place_a] = found.a.ids + self.most * last_a
        items[place_b] = found.b.ids + 2 * self.most * last_b
        cells = np.array(self.ends, object)[items]
        bounds = found.a.first + found.b.first
        return ["".join(cells[s:e].tolist())[:-1] for s, e in zip(bounds, bounds[1:], strict=False)]


def batches_of(batches: Iterator[pa.RecordBatch], chars: int) -> Iterator[tuple[pa.Array, list[str]]]:
    """Ids and texts, some million code points at a time, whatever the batches they come in."""
    ids: list[pa.Array] = []
    texts: list[str] = []
    held = 0

    def full() -> tuple[pa.Array, list[str]]:
        nonlocal texts, held
        done = (pa.concat_arrays(ids), texts)
        ids.clear()
        texts, held = [], 0
        return done

    for batch in batches:
        begun = 0
        for at in range(batch.num_rows):
            text = batch.column(1)[at].as_py()
            if texts and held + len(text) > chars:
                ids.append(batch.column(0).slice(begun, at - begun))
                begun = at
                yield full()
            texts.append(text)
            held += len(text)
        ids.append(batch.column(0).slice(begun))
    if texts:
        yield full()


def packed(values: np.ndarray) -> bytes:
    """Numbers below 2**28, seven bits to a byte, the last byte of each below 128."""
    size = 1 + (values >= 1 << 7) + (values >= 1 << 14) + (values >= 1 << 21)
    begin = np.cumsum(size) - size
    out = np.empty(int(size.sum()), "uint8")
    for k in range(4):
        here = size > k
        out[begin[here] + k] = values[here] >> 7 * k & 127 | (size[here] > k + 1) << 7
    return out.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    cells = np.frombuffer(data, "uint8").astype("int64")
    if not len(cells):
        return cells
    last = np.flatnonzero(cells < 128)
    begin = np.concatenate([[0], last[:-1] + 1])
    place = np.arange(len(cells)) - np.repeat(begin, np.diff(begin, append=len(cells)))
    return np.add.reduceat((cells & 127) << 7 * place, begin)


def aligned(
    docs: DataFrame,
    byte_path: str,
    piece_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    batch_chars: int = BATCH_CHARS,
) -> DataFrame:
    """doc_id, a_ids, b_ids, groups (text) and links (array of positions a, b, by a then b) of each row.

    A text that is null, empty, or not given back by the tokens of a side has no tokens, groups or links.
    """
    aligner = Aligner(byte_path, piece_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in batches_of(batches, batch_chars):
            found = aligner.align(texts)
            order = np.lexsort((found.link_b, found.link_a))
            doc = found.link_doc[order]
            link = pa.StructArray.from_arrays(
                [
                    pa.array((found.link_a[order] - found.a.first[doc]).astype("int32")),
                    pa.array((found.link_b[order] - found.b.first[doc]).astype("int32")),
                ],
                names=["a", "b"],
            )
            bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
            lists = [
                pa.ListArray.from_arrays(pa.array(o.astype("int32")), v)
                for o, v in (
                    (found.a.first, pa.array(found.a.ids.astype("int32"))),
                    (found.b.first, pa.array(found.b.ids.astype("int32"))),
                    (bounds, link),
                )
            ]
            yield pa.RecordBatch.from_arrays(
                [ids, *lists[:2], pa.array(aligner.group_texts(found), pa.string()), lists[2]],
                names=["doc_id", "a_ids", "b_ids", "groups", "links"],
            )

    named = keyed(docs, id_col, text_col)
    kind = named.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, a_ids array<int>, b_ids array<int>, groups string, links array<struct<a:int,b:int>>"
    return named.mapInArrow(run, schema)


def batch_table(docs: DataFrame, aligner: Aligner, id_col: str, text_col: str, batch_chars: int) -> DataFrame:
    """One row per batch: its distinct pairs of ids with their counts, most frequent first, and its documents side by side.

    A pair is ``a * (ids of b) + b``. ``slots`` and ``times`` hold, document by document, which of the batch's pairs it has (differences of
    their numbers in rising order) and how often, see `packed`; ``n_pairs`` says how many of them are a document's.
    """
    wide = len(aligner.b.bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 33
        for number, (ids, texts) in enumerate(batches_of(batches, batch_chars)):
            found = aligner.align(texts)
            pair = found.a.ids[found.link_a] * wide + found.b.ids[found.link_b]
            pairs, slot, times = np.unique(pair, return_inverse=True, return_counts=True)
            often = np.argsort(-times, kind="stable")
            rank = np.empty(len(often), "int64")
            rank[often] = np.arange(len(often))
            width = max(1, len(pairs))
            own, own_times = np.unique(found.link_doc * width + rank[slot], return_counts=True)
            n_pairs = np.bincount(own // width, minlength=len(texts))
            begins = (np.cumsum(n_pairs) - n_pairs)[n_pairs > 0]
            step = np.diff(own % width, prepend=0)
            step[begins] = own[begins] % width
            n_links = np.bincount(found.link_doc, minlength=len(texts))
            digest = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in aligner.group_texts(found)]
            counts = (np.diff(found.a.first), np.diff(found.b.first), found.n_groups, n_links)
            whole = [
                ids,
                *(pa.array(c.astype("int64")) for c in counts),
                pa.array(digest, pa.string()),
                pa.array(n_pairs.astype("int64")),
                pa.array(pairs[often].astype("int64")),
                pa.array(times[often].astype("int64")),
            ]
            lists = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in whole]
            blobs = [pa.array([packed(v)], pa.binary()) for v in (step, own_times)]
            yield pa.RecordBatch.from_arrays([pa.array([task + number], pa.int64()), *lists, *blobs], names=names)

    named = keyed(docs, id_col, text_col)
    kind = named.schema["doc_id"].dataType.simpleString()
    schema = (
        f"batch bigint, doc_id array<{kind}>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, n_links array<bigint>, "
        "groups_sha256 array<string>, n_pairs array<bigint>, pairs array<bigint>, counts array<bigint>, slots binary, times binary"
    )
    names = [c.split(" ")[0] for c in schema.split(", ")]
    return named.mapInArrow(run, schema)


def totals(asked: DataFrame, wide: int) -> DataFrame:
    """pair, total, best: how many links of the corpus hold a pair, and whether no other pair of its b id has more.

    The highest counts by b id are no more rows than the vocabulary has ids, so they are broadcast.
    """
    counted = asked.groupBy("pair").agg(F.sum("times").alias("total")).withColumn("b", F.col("pair") % wide)
    highest = counted.groupBy("b").agg(F.max("total").alias("highest"))
    joined = counted.join(F.broadcast(highest), "b")
    return joined.select("pair", "total", (F.col("total") == F.col("highest")).alias("best"))


def audited(
    docs: DataFrame,
    byte_path: str,
    piece_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    batch_chars: int = BATCH_CHARS,
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each row.

    ``n_best`` counts the links whose pair of ids is the most frequent one of the corpus for its b id, ties included;
    ``count_sum`` adds up the corpus-wide counts of all links. ``groups_sha256`` is the digest of the groups of `aligned`.

    A text that is null, empty, or not given back by the tokens of a side has zeros and an empty digest. Repeated rows are rows of their own and
    count as often as they stand there; a table without rows gives none. Other columns are left behind.

    The batches are written once to the shared folder and read twice: for their pairs, and to be finished.
    """
    aligner = Aligner(byte_path, piece_path)
    wide = len(aligner.b.bytes)
    spark = docs.sparkSession
    path = f"{shared_folder(spark)}/alignment-{uuid.uuid4().hex}"
    batch_table(docs, aligner, id_col, text_col, batch_chars).write.parquet(path)
    table = spark.read.parquet(path)
    pairs = F.posexplode(F.arrays_zip("pairs", "counts")).alias("slot", "p")
    asked = table.select("batch", pairs).select("batch", "slot", F.col("p.pairs").alias("pair"), F.col("p.counts").alias("times"))
    known = asked.join(totals(asked, wide), "pair").select("batch", "slot", "total", "best")
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def finish(batch: pa.Table, answers: pa.Table) -> pa.Table:
        row = {n: batch.column(n)[0] for n in batch.column_names}
        sizes = row["n_pairs"].values.to_numpy()
        doc = np.repeat(np.arange(len(sizes)), sizes)
        slots, times = unpacked(row["slots"].as_py()), unpacked(row["times"].as_py())
        # Back from differences: running sums, less what had run up before the document.
        run = np.cumsum(slots)
        ends = np.cumsum(sizes)
        before = np.concatenate([[0], run])[ends - sizes]
        slots = run - before[doc]
        total, best = np.zeros(answers.num_rows, "int64"), np.zeros(answers.num_rows, bool)
        place = answers.column("slot").to_numpy()
        total[place] = answers.column("total").to_numpy()
        best[place] = answers.column("best").to_numpy()
        count_sum, n_best = np.zeros(len(sizes), "int64"), np.zeros(len(sizes), "int64")
        np.add.at(count_sum, doc, times * total[slots])
        np.add.at(n_best, doc, times * best[slots])
        lists = {n: row[n].values for n in row if n in names} | {"n_best": pa.array(n_best), "count_sum": pa.array(count_sum)}
        return pa.Table.from_arrays([lists[n] for n in names], names=names)

    kind = table.schema["doc_id"].dataType.elementType.simpleString()
    schema = ", ".join(f"{n} {kind if n == 'doc_id' else 'string' if n == 'groups_sha256' else 'bigint'}" for n in names)
    unfinished = spark.read.parquet(path).drop("pairs", "counts").groupBy("batch")
    return unfinished.cogroup(known.groupBy("batch")).applyInArrow(finish, schema)
