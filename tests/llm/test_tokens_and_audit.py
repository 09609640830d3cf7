"""Alignment of tokenizers, chat formatting and the filter audit, against plain Python."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from labelspark.llm import alignment, chat, filter_audit, queries
from labelspark.llm.bpe import byte_letters
from labelspark.llm.tokens import ByteLevel, code_points
from tests.llm.conftest import ODD

BYTES, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
LIBRARY = Tokenizer.from_file(BYTES)
LIBRARY.encode_special_tokens = True
SIGNS = "aZ é ▁ﬁΣß9٣\n\t\r\v#</turn>\\|<|endoftext|>'s \U0001f600中文́‍<0x41>…"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def odd_texts(n, seed=1, most=60):
    rng = random.Random(seed)
    return ["".join(rng.choice(SIGNS) for _ in range(rng.randrange(most))) for _ in range(n)]


# -- byte-level encoding


def test_ids_equal_the_tokenizers_library():
    vocabulary = ByteLevel(BYTES)
    for text in [*odd_texts(2000), "<|endoftext|> a<|endoftext|>", " " * 50_000, "x" + "\n" * 30_000 + "y", "a" * 60_000]:
        assert vocabulary.encode(text).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_offsets_are_the_code_points_that_tokens_touch():
    vocabulary = ByteLevel(BYTES)
    lengths = vocabulary.lengths()
    for text in odd_texts(300, seed=2):
        ids = vocabulary.encode(text)
        if len(ids):
            upto = np.cumsum(lengths[ids])
            starts, ends = code_points(text.encode(), upto - lengths[ids], upto)
            spans = zip(starts.tolist(), ends.tolist(), strict=True)
            for (s, e), token in zip(spans, ids, strict=True):
                # The token's bytes lie within the bytes of the code points that it is said to touch, and no fewer would do.
                assert vocabulary.bytes[token] in text[s:e].encode()
                assert e - s == 1 or vocabulary.bytes[token] not in text[s + 1 : e].encode() + b"\xff" + text[s : e - 1].encode()


# -- alignment


def plain_sides(text):
    """Ids and bytes of both sides, or nothing."""
    letters = {c: i for i, c in enumerate(byte_letters())}
    names = {v: k for k, v in LIBRARY.get_vocab().items()}
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a, b = LIBRARY.encode(" " + text, add_special_tokens=False).ids, model.encode(text)
    a_bytes = [bytes(letters[c] for c in names[i]) for i in a]
    b_bytes = [
        bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()
        for i in b
    ]
    whole = (" " + text).encode()
    if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
        return [], [], [], []
    return a, b, a_bytes, b_bytes


def spans_of(parts):
    ends = np.cumsum([len(p) for p in parts]).tolist()
    return list(zip([0, *ends], ends, strict=False))


def plain_alignment(texts):
    links, groups, sizes, counts = [], [], [], Counter()
    for text in texts:
        a, b, a_bytes, b_bytes = plain_sides(text or "")
        at_a, at_b = spans_of(a_bytes), spans_of(b_bytes)
        links.append([(i, j) for i, s in enumerate(at_a) for j, t in enumerate(at_b) if s[0] < t[1] and t[0] < s[1]])
        counts.update((a[i], b[j]) for i, j in links[-1])
        cuts, said, begun = sorted({e for _, e in at_a} & {e for _, e in at_b}), [], 0
        for cut in cuts:
            inside = [[str(i) for i, s in zip(ids, spans, strict=True) if begun < s[1] <= cut] for ids, spans in ((a, at_a), (b, at_b))]
            said.append("|".join(",".join(side) for side in inside))
            begun = cut
        groups.append(";".join(said))
        sizes.append((a, b, len(cuts)))
    best = defaultdict(int)
    for (_, j), n in counts.items():
        best[j] = max(best[j], n)
    rows = []
    for (a, b, n), pairs, said in zip(sizes, links, groups, strict=True):
        ids = [(a[i], b[j]) for i, j in pairs]
        many = (sum(counts[p] == best[p[1]] for p in ids), sum(counts[p] for p in ids))
        rows.append((len(a), len(b), n, len(ids), *many, sha(said) if said else ""))
    return rows, links, groups


ALIGNED = [
    *[t for t in ODD if t is None or len(t) < 1000], "The cat sat on the mat.", "The cat sat on the mat.", "naïve café 中文字 <s> </s> <unk>",
    "a ▁ b", "<0x41> and <|endoftext|>", " leading", "trailing ", "two  spaces", "tab\tand\nline", "ﬁne print", *odd_texts(40, seed=3),
]


@pytest.mark.parametrize("chars", [1, 300, 2_000_000])
def test_alignment_matches_plain_search(spark, documents, chars):
    want, links, groups = plain_alignment(ALIGNED)
    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    docs = documents(ALIGNED).withColumn("batch", F.lit("x")).withColumn("pairs", F.lit("x")).withColumn("n_a", F.lit("x"))
    got = {r.doc_id: tuple(r[c] for c in columns) for r in alignment.audited(docs, BYTES, PIECES, batch_chars=chars).collect()}
    assert [got[i] for i in range(len(ALIGNED))] == want
    rows = {r.doc_id: r for r in alignment.aligned(docs, BYTES, PIECES, batch_chars=chars).collect()}
    assert [[tuple(p) for p in rows[i].links] for i in range(len(ALIGNED))] == links
    assert [rows[i].groups for i in range(len(ALIGNED))] == groups
    assert [len(rows[i].a_ids) for i in range(len(ALIGNED))] == [w[0] for w in want]


def test_alignment_of_nothing_of_repeated_rows_and_of_a_long_text(spark, documents):
    assert alignment.audited(documents([]), BYTES, PIECES).collect() == []
    twice = documents([(1, "same words here", "en", "s"), (1, "same words here", "en", "s"), (None, "same", "en", "s")])
    rows = alignment.audited(twice, BYTES, PIECES).orderBy("doc_id").collect()
    assert [r.doc_id for r in rows] == [None, 1, 1] and rows[1] == rows[2] and rows[1].count_sum >= 2 * rows[1].n_links
    long = alignment.audited(documents(["word " * 400_000, "x" * 70_000, " " * 100_000]), BYTES, PIECES).orderBy("doc_id").collect()
    assert long[0].n_links >= 400_000 and all(r.n_links >= max(r.n_a, r.n_b) for r in long)


def test_numbers_are_packed_and_back():
    values = np.array([0, 1, 127, 128, 16_383, 16_384, 2_097_151, 2_097_152, 2**28 - 1, 5], "int64")
    assert alignment.unpacked(alignment.packed(values)).tolist() == values.tolist()
    assert alignment.unpacked(alignment.packed(values[:0])).tolist() == []


# -- chat formatting

TALKS = {
    1: [("system", "be ### brief"), ("user", r"\### Assistant: </turn> ok"), ("assistant", r"\### Assistant: </turn> ok")],
    2: [("assistant", None), ("assistant", ""), ("assistant", "\n\n  spaced out \n"), ("user", "é中\U0001f600"), ("assistant", "é中\U0001f600́")],
    3: [("user", "#" * 9 + "\\" * 3 + "</turn></turn><\\/turn>\n### user:\n"), ("assistant", "####</turn>\n### user:\n\\\\#")],
    4: [("we\nird: ### role\\", "x"), (None, "y"), ("user", "z")],
    5: [("assistant", t) for t in odd_texts(60, seed=4)],
    None: [("user", "no id"), ("assistant", "none")],
    6: [("assistant", "long " * 60_000), ("user", "?"), ("assistant", "q" * 70_000)],
}
CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string"


def plain_digest(turns):
    said = [(role or "", text or "") for role, text in turns]
    learnt = "".join(text for role, text in said if role == "assistant")
    told = "".join(f"{role}\n{text}\n" for role, text in said)
    size = sum(len("".join(chat.rendered(*turn))) for turn in said)
    return len(said), sha(told), len(learnt), sha(learnt), size


def told(rows):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars) for r in rows}


@pytest.mark.parametrize("chars", [1, 90, chat.BLOCK_CHARS])
def test_conversations_are_read_back_whole(spark, chars):
    rows = [(c, i, *t) for c, turns in TALKS.items() for i, t in enumerate(turns)]
    random.Random(5).shuffle(rows)
    table = spark.createDataFrame(rows, CONVERSATIONS).withColumn("place", F.lit("x")).withColumn("ids", F.lit("x"))
    found = chat.digests(chat.formatted(table.repartition(3), BYTES, block_chars=chars)).collect()
    assert len(found) == len(TALKS) and told(found) == {c: plain_digest(turns) for c, turns in TALKS.items()}


def test_rows_put_together_are_the_encoding_of_the_whole(spark):
    rows = [(c, i, *t) for c, turns in TALKS.items() for i, t in enumerate(turns) if c]
    table = spark.createDataFrame(rows, CONVERSATIONS)
    ids, texts = defaultdict(list), defaultdict(str)
    for row in chat.formatted(table, BYTES, block_chars=1).orderBy("place").collect():
        ids[row.conv_id] += row.ids
        texts[row.conv_id] += row.text
        tokens = list(zip(row.starts, row.ends, row.loss, strict=True))
        assert [m for _, _, m in tokens] == [any(s < b and a < e for a, b in row.spans) for s, e, _ in tokens]
    for conv, text in texts.items():
        assert ids[conv] == LIBRARY.encode(text, add_special_tokens=False).ids
        assert chat.turns_of(text) == [(role or "", said or "") for role, said in TALKS[conv]]


def test_escapes_are_reversible_and_leave_no_control_string():
    for text in [*odd_texts(2000, seed=6), "###", "####", "</turn>", "\\", "\\\\###", "<</turn>", "#\\##", "<\\/turn>"]:
        for role in ("user", text):
            head, body, _ = chat.rendered(role, text)
            assert "###" not in body and "</turn>" not in body and "###" not in head[3:] and head.count("\n") - head.count("\\\n") == 1
        assert chat.turns_of("".join(chat.rendered(text, text)) * 2) == [(text, text)] * 2


def test_ties_and_nulls_of_turns_have_one_order(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, None, "assistant", "first"), (1, 0, "user", "a")]
    found = [
        chat.digests(chat.formatted(spark.createDataFrame(order, CONVERSATIONS).repartition(n), BYTES)).collect()
        for order, n in ((rows, 1), (rows[::-1], 4))
    ]
    assert found[0] == found[1] and found[0][0].n_turns == 4 and found[0][0].loss_chars == 5
    empty = spark.createDataFrame([], CONVERSATIONS)
    assert chat.digests(chat.formatted(empty, BYTES)).collect() == [] == chat.formatted(empty, BYTES).collect()


def test_one_huge_conversation_is_many_tasks(spark):
    huge = spark.range(4000).selectExpr("7L AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role", "'said ' || id AS text")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        blocks = chat.formatted(huge, BYTES)
        spread = [r.n_turns for r in blocks.collect()]
        found = told(chat.digests(blocks).collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(spread) > 4 and max(spread) < 1500
    assert found == {7: plain_digest([("assistant" if i % 2 else "user", f"said {i}") for i in range(4000)])}


# -- filter audit

LABELS = "doc_id bigint, quality int, toxic int"


def plain_audit(rows, labels):
    """Every document at every step of every order."""
    least = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            least[text or ""] = min(doc_id, least.get(text or "", doc_id))
    found = defaultdict(lambda: [0] * 6)
    shares = Counter()
    for doc_id, given, lang, _ in rows:
        text, part = given or "", lang or ""
        words = [w for w in text.translate({9: " ", 10: " ", 11: " ", 12: " ", 13: " "}).split(" ") if w]
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": doc_id is not None and text in least and least[text] < doc_id,
        }
        good, toxic = (any(i == doc_id and row[at] == 1 for i, *row in labels) for at in (0, 1))
        for order in permutations("ABCDE"):
            inside = True
            for step, name in enumerate(order, 1):
                here, gone = inside and fails[name], not inside and fails[name]
                inside = inside and not here
                only = fails[name] and sum(fails.values()) == 1
                cell = found[part, "".join(order), step]
                for i, value in enumerate((inside, here, gone, only, here and good, here and toxic)):
                    cell[i] += value
                shares[part, name] += here
    return {key: (*cell, shares[key[0], key[1][key[2] - 1]]) for key, cell in found.items()}


def audited(df):
    columns = [*filter_audit.OUTCOMES, "shapley"]
    return {(r.part, r.filter_order, r.step): tuple(r[c] for c in columns) for r in df.collect()}


def test_audit_matches_plain_counts(spark, documents):
    plain = " ".join(f"w{i}" for i in range(250))
    texts = [*ODD, plain, plain, "same " * 300, plain + " #", plain.upper(), "ÄÖÜ" + plain, "a\x0bb\x1cc d\x85e " * 60]
    rows = [(i, t, ["en", None, "", "de"][i % 4], "s") for i, t in enumerate(texts)]
    rows += [(3, "word", "en", "s"), (None, plain, "en", "s"), (None, None, None, None), (-5, plain, "xx", "s"), (-5, plain, "xx", "s")]
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(-5, 14)] + [(2, 1, None), (2, None, 1), (None, 1, 1), (7, None, None)]
    docs = documents(rows).withColumn("mask", F.lit("x")).withColumn("n", F.lit("x")).withColumn("part", F.lit("x"))
    said = spark.createDataFrame(labels, LABELS).withColumn("lang", F.lit("x"))
    known = [row for row in labels if row[0] is not None]
    assert audited(filter_audit.audit(docs, said)) == plain_audit(rows, known)


def test_audit_of_an_empty_table_and_without_labels(spark, documents):
    none = spark.createDataFrame([], LABELS)
    assert filter_audit.audit(documents([]), none).collect() == []
    rows = audited(filter_audit.audit(documents(["a", "a"]), none))
    assert len(rows) == 600 and rows["en", "ABCDE", 1] == (0, 2, 0, 1, 0, 0, 180) and rows["en", "EABCD", 1][:2] == (1, 1)


def test_fields_do_not_run_over():
    most = 2**63 - 1
    masks = list(range(128))
    share = most // len(masks)
    single = np.array([list(filter_audit.outcomes(m)) for m in masks], object).sum(axis=0)
    assert (filter_audit.unpacked(sum(filter_audit.packed(m) * share for m in masks)) == single * share).all()
    lone = filter_audit.unpacked(filter_audit.packed(31) * most)
    assert lone.max() == most and set(lone.ravel().tolist()) == {0, most}
    assert filter_audit.unpacked(0).sum() == 0


def test_planted_talk_is_in_the_query(spark):
    rows = told(queries.QUERIES["op12_chat_formatting"](spark, "/root/testdata/sf0.001").collect())
    assert rows[-7] == plain_digest([("user", r"\### Assistant: </turn> ok"), ("assistant", r"\### Assistant: </turn> ok")])
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").orderBy("conv_id", "turn").collect()
    talks = defaultdict(list)
    for r in turns:
        talks[r.conv_id].append((r.role, r.text))
    assert {c: v for c, v in rows.items() if c != -7} == {c: plain_digest(t) for c, t in talks.items()}
