"""Conversations as training text: rendered whole, encoded once, with a loss mask on the tokens of the assistant's words.

A turn is rendered as ``### role:``, a line feed, its text, ``</turn>`` and a line feed. Inside roles and texts a backslash takes a
backslash before it, and the strings that the template gives a meaning are broken by one, so that they can't occur: three number signs in a row,
``</turn>``, and the colon and line feeds of a role. Taking one backslash off gives the text back.

The rendered text is encoded once with offsets. Spans of turns and spans of tokens are both sorted, so the tokens of a turn are
found by binary search. A token may reach over the edge of a turn's text (white space after the head is one token with the white space that a
text begins with); it is under the mask, and the spans beside the mask say how far.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelspark.llm.tokens import ByteLevel, code_points

ASSISTANT = "assistant"
#: Code points of whole turns after which a conversation goes on in a further row. No token reaches over the end of a turn, as the word
#: pattern parts its line feed from the number signs that follow; so the rows of a conversation, put together, are its encoding as a whole.
BLOCK_CHARS = 1 << 17

IN_TEXT = re.compile(r"\\|(?<=#)#(?=#)|(?<=<)/(?=turn>)")
IN_ROLE = re.compile(r"[\\:\n]|(?<=#)#(?=#)|(?<=<)/(?=turn>)")
ESCAPED = re.compile(r"\\(.)", re.DOTALL)
TURN = re.compile(r"### ((?:[^\\:]|\\.)*):\n(.*?)</turn>\n", re.DOTALL)

BLOCK = (
    "place bigint, edge boolean, n_turns bigint, text string, ids array<int>, starts array<int>, ends array<int>, "
    "loss array<boolean>, spans array<struct<start:int,end:int>>"
)


def escaped(text: str, controls: re.Pattern = IN_TEXT) -> str:
    return controls.sub(r"\\\g<0>", text)


def unescaped(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def rendered(role: str, text: str) -> tuple[str, str, str]:
    """Head, text and end of a turn."""
    return f"### {escaped(role, IN_ROLE)}:\n", escaped(text), "</turn>\n"


def turns_of(text: str) -> list[tuple[str, str]]:
    """Role and text of each turn, read back."""
    return [(unescaped(m[1]), unescaped(m[2])) for m in TURN.finditer(text)]


def masked(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """True for the tokens that share a code point with a span. Both are sorted, so two binary searches find a span's tokens."""
    mask = np.zeros(len(starts), bool)
    low, high = np.array(spans, "int64").reshape(-1, 2).T
    for a, b in zip(np.searchsorted(ends, low, "right"), np.searchsorted(starts, high, "left"), strict=True):
        mask[a:b] = True
    return mask


def under_mask(text: str, starts: np.ndarray, ends: np.ndarray, loss: np.ndarray, spans: list[tuple[int, int]]) -> list[str]:
    """The text under the mask by span, unescaped: runs of masked tokens, cut to the spans that they meet."""
    step = np.diff(np.concatenate([[False], loss, [False]]).astype("int8"))
    run_starts, run_ends = starts[np.flatnonzero(step == 1)], ends[np.flatnonzero(step == -1) - 1]
    found = []
    for low, high in spans:
        pieces = []
        for i in range(np.searchsorted(run_ends, low, "right"), np.searchsorted(run_starts, high, "left")):
            pieces.append(text[max(low, run_starts[i]) : min(high, run_ends[i])])
        found.append(unescaped("".join(pieces)))
    return found


def lists(arrays: tuple[np.ndarray, ...], kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)]).astype("int32")
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays)).cast(kind))


def in_order(turns: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """conv_id, role, text in the order of conversations and turns, dealt by both, so that one huge conversation is many tasks."""
    named = turns.select(
        F.col(f"`{id_col}`").alias("conv_id"),
        F.col(f"`{turn_col}`").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    ).withColumn("tie", F.xxhash64("role", "text"))
    dealt = named.repartitionByRange("conv_id", "turn", "tie")
    return dealt.sortWithinPartitions("conv_id", "turn", "tie", "role", "text").select("conv_id", "role", "text")


def formatted(
    turns: DataFrame,
    vocabulary: str,
    *,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Conversations as rows of whole turns: rendered text, token ids with their spans of code points, loss mask, loss spans.

    Most conversations are one row. One of more than ``block_chars`` code points, or one that lies across two tasks, is several; ``place`` gives their
    order, ``edge`` is true where a row might not be all of its conversation. Spans count from the start of the row's text.

    Turns that share a number stand by a hash of role and text, then by these; equal rows are all kept. Null turns come first, a null
    role or text is an empty one, rows whose conversation is null are one conversation. Roles other than ``assistant``
    carry no loss, nor does an empty text. An empty table gives no rows, other columns are left behind.

    ``vocabulary`` is the path of a byte-level vocabulary, read on the driver.
    """
    tokens = ByteLevel(vocabulary)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = tokens.lengths()
        place = TaskContext.get().partitionId() << 33
        rows: list[tuple] = []
        parts: list[str] = []
        spans: list[tuple[int, int]] = []
        size = count = held = 0
        first, now, edge = True, None, True

        def encoded() -> tuple:
            text = "".join(parts)
            data = text.encode()
            ids = tokens.encode(text)
            upto = np.cumsum(lengths[ids])
            starts, ends = upto - lengths[ids], upto
            if len(data) != len(text):
                starts, ends = code_points(data, starts, ends)
            return text, ids, starts, ends, masked(starts, ends, spans)

        def close(last: bool) -> None:
            nonlocal size, count, held, place
            text, ids, starts, ends, loss = encoded()
            marks = [{"start": a, "end": b} for a, b in spans]
            rows.append((now, place, edge or last, count, text, ids, starts, ends, loss, marks))
            place, held = place + 1, held + len(text)
            parts.clear(), spans.clear()
            size = count = 0

        def sent() -> pa.RecordBatch:
            nonlocal held
            columns = list(zip(*rows, strict=True))
            rows.clear()
            held = 0
            arrays = [
                lists(c, f.type.value_type) if isinstance(c[0], np.ndarray) else pa.array(c, f.type)
                for c, f in zip(columns, schema, strict=True)
            ]
            return pa.RecordBatch.from_arrays(arrays, schema=schema)

        for batch in batches:
            for conv, role, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if not first and conv != now:
                    if parts:
                        close(False)
                    edge = False
                elif size >= block_chars:
                    close(True)
                    edge = True
                first, now = False, conv
                head, body, end = rendered(role, text)
                if role == ASSISTANT and body:
                    spans.append((size + len(head), size + len(head) + len(body)))
                parts += (head, body, end)
                size += len(head) + len(body) + len(end)
                count += 1
                if held >= block_chars:
                    yield sent()
        if parts:
            close(True)
        if rows:
            yield sent()

    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    ordered = in_order(turns, id_col, turn_col, role_col, text_col)
    kind = f"conv_id {ordered.schema['conv_id'].dataType.simpleString()}, {BLOCK}"
    schema = to_arrow_schema(T._parse_datatype_string(kind))
    return ordered.mapInArrow(blocks, kind)


DIGEST = "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def digests(blocks: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of each conversation, read back from `formatted`.

    A row that is a whole conversation is done at once. The texts of the others are brought to one task per conversation in their order and pass
    through its digests one after the other, so that no more than a row is held.
    """
    kind = blocks.schema["conv_id"].dataType.simpleString()
    own = f"conv_id {kind}, place bigint, {DIGEST}, turns binary, loss_text binary"
    whole = f"conv_id {kind}, {DIGEST}"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[dict] = []
            held = 0
            for at in range(batch.num_rows):
                conv, place, edge, _, text, _, starts, ends, loss, spans = (
                    c[at] if i in (0, 1) else c[at].as_py() if i < 5 else c[at].values
                    for i, c in enumerate(batch.columns)
                )
                turns = turns_of(text)
                told = "".join(f"{role}\n{said}\n" for role, said in turns).encode()
                marks = [(s["start"], s["end"]) for s in spans.to_pylist()]
                bounds = (a.to_numpy().astype("int64") for a in (starts, ends))
                learnt = "".join(under_mask(text, *bounds, loss.to_numpy(zero_copy_only=False), marks))
                row = {
                    "conv_id": conv.as_py(),
                    "place": place.as_py(),
                    "n_turns": len(turns),
                    "turns_sha256": None if edge else hashlib.sha256(told).hexdigest(),
                    "loss_chars": len(learnt),
                    "loss_sha256": None if edge else hashlib.sha256(learnt.encode()).hexdigest(),
                    "formatted_chars": len(text),
                    "turns": told if edge else None,
                    "loss_text": learnt.encode() if edge else None,
                }
                rows.append(row)
                held += len(text) if edge else 0
                if held >= BLOCK_CHARS or at == batch.num_rows - 1:
                    yield pa.RecordBatch.from_pylist(rows, schema=own_schema)
                    rows, held = [], 0

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[dict] = []
        now: dict | None = None
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                if now is None or now["conv_id"] != row["conv_id"]:
                    if now is not None:
                        done.append(now)
                    now = row | {"hashes": (hashlib.sha256(), hashlib.sha256())}
                else:
                    for name in ("n_turns", "loss_chars", "formatted_chars"):
                        now[name] += row[name]
                if row["turns"] is not None:
                    now["hashes"][0].update(row["turns"])
                    now["hashes"][1].update(row["loss_text"])
                    now["turns_sha256"], now["loss_sha256"] = (h.hexdigest() for h in now["hashes"])
            if done:
                yield pa.RecordBatch.from_pylist([{f.name: d[f.name] for f in whole_schema} for d in done], schema=whole_schema)
                done.clear()
        if now is not None:
            yield pa.RecordBatch.from_pylist([{f.name: now[f.name] for f in whole_schema}], schema=whole_schema)

    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    own_schema, whole_schema = (to_arrow_schema(T._parse_datatype_string(k)) for k in (own, whole))
    parts = blocks.mapInArrow(read, own)
    return parts.repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(put_together, whole)
