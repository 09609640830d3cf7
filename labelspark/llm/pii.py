"""Personal data in texts: four fixed patterns, and what a tagger learned from them finds besides.

The tagger is a character-level BiLSTM with CRF transitions. It reads all overlapping windows of a text; their spans are then
reconciled over the whole text: a span that a window's edge cuts is joined with its rest in the next window, and of
spans that overlap the set with the greatest total certainty stays.

It is trained on the matches of the patterns and on changed forms of them that no pattern finds: signs spelt out or in brackets, letters and digits of
other scripts, numbers with other separators or an extension. How certain a span must be is set on windows kept out of the training.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelspark.llm import bilstm
from labelspark.llm.bilstm import KINDS, LABELS
from labelspark.llm.common import cut, hex_digest, keyed, map_text, slices

# The patterns. Possessive and anchored at the start of a run, which finds the same matches in linear time.
EMAIL = regex.compile(r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
NO_DIGIT = re.compile(r"[^0-9]+")

#: Windows share 40 characters with the next one; a span cut by an edge is joined with its rest.
WINDOW, STRIDE = 256, 216
#: Windows that are gathered from texts before they are run through the network.
AT_ONCE = 8192
#: Mean probabilities of a span's labels that are tried as the least, and the share of right spans among those found that one must reach.
SURES = (0.9, 0.93, 0.95, 0.97, 0.98, 0.99)
RIGHT = 0.98

Span = tuple[int, int, int]  # start, number of the kind, end


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Matches of the patterns that hold their conditions, by start, then kind."""
    found: list[Span] = []
    if "@" in text:
        found += [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    if DIGIT.search(text):
        for m in IP.finditer(text):
            parts = [p.lstrip("0") for p in m[0].split(".")]
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                found.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            digits = NO_DIGIT.sub("", m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= len(NO_DIGIT.sub("", m[0])) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


def windows_of(points: np.ndarray) -> np.ndarray:
    """Starts of the windows that hold a digit or an at sign."""
    hits = np.flatnonzero(((points >= 48) & (points <= 57)) | (points == 64))
    if not len(hits):
        return hits
    last = hits // STRIDE * STRIDE
    starts = np.unique(np.concatenate([(last - s)[hits < last - s + WINDOW] for s in range(0, WINDOW, STRIDE)]))
    return starts[(starts >= 0) & ((starts == 0) | (starts + WINDOW - STRIDE < len(points)))]


def all_windows(points: np.ndarray) -> np.ndarray:
    """Starts of the windows that cover a text."""
    starts = np.arange(0, len(points), STRIDE)
    return starts[(starts == 0) | (starts + WINDOW - STRIDE < len(points))]


def cut_out(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Character ids (n, WINDOW) of windows, padded at the text's end; code points are looked up once, not once per window."""
    piece = points[starts[0] : starts[-1] + WINDOW]
    ids = np.zeros(starts[-1] - starts[0] + WINDOW, np.uint8)
    ids[: len(piece)] = bilstm.char_ids(piece)
    return np.lib.stride_tricks.sliding_window_view(ids, WINDOW)[starts - starts[0]]


def spans_in(labels: np.ndarray, sure: np.ndarray, start: int, length: int) -> Iterator[tuple[int, int, int, float, bool, bool]]:
    """Spans of one window in places of the text: start, kind, end, sum of certainties, and whether its edges cut them."""
    at = 0
    n = min(WINDOW, length - start)
    while at < n:
        if not labels[at]:
            at += 1
            continue
        end = at + 1
        while end < n and labels[end] and LABELS[labels[end]][0] == "I":
            end += 1
        kind = (int(labels[at]) - 1) // 2
        yield start + at, kind, start + end, float(sure[at:end].sum()), at == 0 and start > 0, end == WINDOW and start + end < length
        at = end


def reconciled(found: list[tuple[int, int, int, float, bool, bool]]) -> list[tuple[int, int, int, float]]:
    """Spans that do not overlap, with their mean certainty: cut ones joined, then the set of the greatest total."""
    joined: list[list] = []
    for s in sorted(found):
        for old in reversed(joined[-4:]):
            if old[1] == s[1] and s[0] <= old[2] and (old[5] or s[4]):
                mean = max(old[3] / (old[2] - old[0]), s[3] / (s[2] - s[0]))
                end, cut_end = max((old[2], old[5]), (s[2], s[5]))
                old[2], old[5] = end, cut_end
                old[3] = mean * (old[2] - old[0])
                break
        else:
            joined.append(list(s))
    whole = {(s[0], s[1], s[2]): s[3] for s in joined if not s[4] and not s[5]}
    spans = sorted(((*k, v) for k, v in whole.items()), key=lambda s: (s[2], s[0], s[1]))
    best: list[tuple[float, int]] = [(0.0, -1)]  # greatest total of the first spans, and the last one taken
    ends = [s[2] for s in spans]
    from bisect import bisect_right

    for i, s in enumerate(spans):
        before = bisect_right(ends, s[0], 0, i)
        taken = best[before][0] + s[3]
        best.append((taken, i) if taken > best[-1][0] else best[-1])
    out, at = [], len(spans)
    while at > 0 and best[at][1] >= 0:
        s = spans[best[at][1]]
        out.append((s[0], s[1], s[2], s[3] / (s[2] - s[0])))
        at = bisect_right(ends, s[0], 0, best[at][1])
    return out[::-1]


def learned_spans(texts: list[str], params: dict | None) -> list[list[tuple[int, int, int, float]]]:
    """Reconciled spans of each whole text."""
    found: list[list] = [[] for _ in texts]
    if params is None:
        return found
    held, ids = [], []

    def run() -> None:
        labels, sure = bilstm.best_paths(params, np.concatenate(ids))
        for i in np.flatnonzero(labels.any(axis=1)):
            doc, start, length = held[i]
            found[doc] += spans_in(labels[i], sure[i], start, length)
        held.clear()
        ids.clear()

    for doc, text in enumerate(texts):
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        starts = all_windows(points)
        for at in range(0, len(starts), AT_ONCE):
            part = starts[at : at + AT_ONCE]
            ids.append(cut_out(points, part))
            held += [(doc, s, len(points)) for s in part.tolist()]
            if len(held) >= AT_ONCE:
                run()
    if held:
        run()
    longest = params.get("longest", WINDOW)
    return [[s for s in reconciled(f) if s[2] - s[0] <= longest] for f in found]


ACCENTED = str.maketrans("aeiouncyAEIOU", "áéíöüñçýÀÉÎÖÜ")
WIDE_SIGNS = str.maketrans({c: chr(ord(c) + 0xFEE0) for c in "0123456789@.+-"})
OTHER_DIGITS = [str.maketrans("0123456789", "".join(chr(first + i) for i in range(10))) for first in bilstm.DIGITS_FROM[:2]]


def changed_form(kind: int, value: str, draw: random.Random) -> str:
    """A form of a match that people write and no pattern finds."""
    pick = draw.randrange(5)
    if kind == 0:
        local, _, domain = value.partition("@")
        return (
            f"{local} (at) {domain}",
            f"{local}[at]{domain.replace('.', '[dot]')}",
            f"{local} at {domain.replace('.', ' dot ')}",
            f"{local.translate(ACCENTED)}@{domain}",
            value.translate(WIDE_SIGNS),
        )[pick]
    if kind == 1:
        return (value.replace(".", "[.]"), value.replace(".", "(.)"), value.replace(".", " . "), value.translate(WIDE_SIGNS), value.replace(".", "[.]", 1))[pick]
    digits = NO_DIGIT.sub("", value)
    if kind == 2:
        groups = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        return (".".join(groups), "/".join(groups), "  ".join(groups), value.translate(WIDE_SIGNS), value.translate(draw.choice(OTHER_DIGITS)))[pick]
    bare = value.lstrip("+")
    return (f"00{bare}", f"{value} ext. {draw.randrange(10, 9999)}", f"{bare} x{draw.randrange(10, 9999)}", value.translate(WIDE_SIGNS), value.translate(draw.choice(OTHER_DIGITS)))[pick]


def changed(text: str, spans: list[Span], draw: random.Random) -> tuple[str, list[Span]]:
    """The text with each span in a changed form, and where these stand; spans that overlap an earlier one are left out."""
    parts, out, at, size = [], [], 0, 0
    for start, kind, end in spans:
        if start < at:
            continue
        form = changed_form(kind, text[start:end], draw)
        parts += [text[at:start], form]
        size += start - at
        out.append((size, kind, size + len(form)))
        size += len(form)
        at = end
    return "".join([*parts, text[at:]]), out


def labelled_windows(text: str) -> list[tuple[str, bytes, bool, bool]]:
    """All windows with the labels of the base spans, whether they hold a digit or an at sign, and whether they are changed; then
    those windows of the changed text that hold a span."""
    spans = base_spans(text)
    found = [(*w, False) for w in windows_with(text, spans)]
    if spans:
        found += [(*w, True) for w in windows_with(*changed(text, spans, random.Random(crc32(text.encode())))) if any(w[1])]
    return found


def windows_with(text: str, spans: list[Span]) -> list[tuple[str, bytes, bool]]:
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    labels = np.zeros(len(points) + WINDOW, np.uint8)
    for start, kind, end in reversed(spans):
        labels[start:end] = 2 * kind + 2
        labels[start] = 2 * kind + 1
    near = set(windows_of(points).tolist())
    return [(text[s : s + WINDOW], labels[s : s + WINDOW].tobytes(), s in near) for s in all_windows(points).tolist()]


def fit(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    train_docs: int = 2000,
    train_windows: int = 2000,
    epochs: int = 8,
) -> dict | None:
    """Parameters learned from the base spans of at most ``train_docs`` texts with a digit or an at sign, those of the least hashed ids.

    At most ``train_windows`` windows reach the driver: a fifth each with spans, with changed forms of spans, and without a span, and two fifths without a
    digit or an at sign. A fifth of each is kept out and sets ``sure``, the least certainty by which spans are taken: the smallest one that makes `RIGHT` of the
    spans found there right. Spans longer than any that was learned from are never taken. None if there is nothing to learn.
    """
    named = keyed(docs, id_col, text_col)
    ids = named.filter(F.col("text").rlike("[0-9@]")).select("doc_id").orderBy(F.xxhash64("doc_id")).limit(train_docs).distinct()

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                found = [w for t in part.column(0).to_pylist() for w in labelled_windows(t)]
                kinds = (pa.string(), pa.binary(), pa.bool_(), pa.bool_())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w[i] for w in found], kind) for i, kind in enumerate(kinds)], ["chars", "labels", "near", "changed"]
                )

    sample = named.join(F.broadcast(ids), "doc_id", "left_semi").select("text")
    windows = cut(sample.mapInArrow(run, "chars string, labels binary, near boolean, changed boolean").distinct())
    windows = windows.withColumn("some", F.hex("labels").rlike("[1-9]"))
    order = (F.xxhash64("chars"), F.col("chars"), F.col("labels"))
    some, other = F.col("some"), F.col("changed")
    parts = ((some & ~other, 1), (some & other, 1), (~some & F.col("near"), 1), (~some & ~F.col("near"), 2))
    rows = [r for asked, share in parts for r in windows.filter(asked).orderBy(*order).limit(share * train_windows // 5).collect()]
    if not any(r["some"] for r in rows):
        return None
    padded = [np.frombuffer(r["chars"].encode("utf-32-le"), np.uint32) for r in rows]
    chars = bilstm.char_ids(np.array([np.concatenate([p, np.full(WINDOW - len(p), 0xFFFFFFFF, np.uint32)]) for p in padded]))
    gold = np.array([np.frombuffer(bytes(r["labels"]), np.uint8) for r in rows]).astype(np.int64)
    begins = gold.copy()  # a window that begins within a span begins it
    inside = (gold[:, 0] > 0) & (gold[:, 0] % 2 == 0)
    begins[inside, 0] -= 1
    kept = np.arange(len(rows)) % 5 == 4
    params = bilstm.train(chars[~kept], begins[~kept], epochs=epochs)
    told = {"longest": max(e - s for row in begins for s, _, e, *_ in spans_in(row, np.ones(WINDOW), 0, WINDOW + 1))}
    return params | told | {"sure": least_sure(params, chars[kept], begins[kept], [r["chars"] for r, k in zip(rows, kept, strict=True) if k])}


def least_sure(params: dict, chars: np.ndarray, gold: np.ndarray, texts: list[str]) -> float:
    """The smallest of `SURES` by which enough of the spans found beside base spans are right; the greatest if none is."""
    told: list[tuple[float, bool]] = []
    if len(chars):
        labels, sure = bilstm.best_paths(params, chars)
        for i, text in enumerate(texts):
            want = {(s, k, e) for s, k, e, *_ in spans_in(gold[i], sure[i], 0, WINDOW)}
            base = base_spans(text)
            for s, k, e, total, *_ in spans_in(labels[i], sure[i], 0, WINDOW):
                if not within(base, (s, k, e)):
                    told.append((total / (e - s), any(k == x[1] and s < x[2] and x[0] < e for x in want)))
    for least in SURES:
        taken = [right for how_sure, right in told if how_sure >= least]
        if taken and sum(taken) >= RIGHT * len(taken):
            return least
    return SURES[-1]


def within(base: list[Span], span: Span) -> bool:
    """Whether a span lies in a base span of its kind."""
    return any(b[1] == span[1] and b[0] <= span[0] and span[2] <= b[2] for b in base)


def joined(spans: list[Span]) -> str:
    return ",".join([f"{KINDS[k]}:{s}:{e}" for s, k, e in spans])


def merged(base: list[Span], learned: list[tuple[int, int, int, float]], sure: float) -> list[Span]:
    """The base spans and the learned ones that are sure enough and lie in no base span of their kind."""
    return sorted({*base, *(s[:3] for s in learned if s[3] >= sure and not within(base, s[:3]))})


def find(docs: DataFrame, params: dict | None, *, id_col: str = "doc_id", text_col: str = "text", sure: float | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_learned for each row, from the whole text.

    ``sure`` is the least certainty of a learned span, by default the one that `fit` has set. Null and empty texts have no spans. Repeated
    rows give repeated results.
    """
    named = keyed(docs, id_col, text_col)
    kind = named.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_learned bigint"
    least = (params or {}).get("sure", SURES[-1]) if sure is None else sure

    def rows_of(ids: list, texts: list) -> list[list]:
        base = [base_spans(t) for t in texts]
        every = [merged(b, more, least) for b, more in zip(base, learned_spans(texts, params), strict=True)]
        counts = [[sum(s[1] == k for s in b) for b in base] for k in range(len(KINDS))]
        learned = [len(e) - len(b) for e, b in zip(every, base, strict=True)]
        return [ids, *counts, [hex_digest(joined(b)) for b in base], [joined(e) for e in every], learned]

    return map_text(named, schema, rows_of, "doc_id", "text")


def detect(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """`find` with the parameters of `fit` on the same rows."""
    return find(docs, fit(docs, id_col=id_col, text_col=text_col, **limits), id_col=id_col, text_col=text_col)
