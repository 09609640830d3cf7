"""Near duplicates, HTML extraction, shards, mixtures and the pipeline, against plain Python."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from labelspark.llm import components, html_text, langid, mincut, mixing, queries, sharding, simhash
from labelspark.llm.bktree import Forest, Labels
from tests.llm.conftest import ODD
from tests.llm.test_text_operators import PATH, by_id, clashing, language_rows, plain_secrets, sha

# -- SimHash


def plain_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, radius=4):
    """Least id that can be reached, by all pairs."""
    ids = list(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(ids, 2):
        if bin(prints[a] ^ prints[b]).count("1") <= radius:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {i: find(i) for i in ids}


def near_texts(n=40):
    draw = random.Random(12)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(4))
    texts = []
    for _ in range(n):
        words = [word() for _ in range(draw.randint(1, 200))]
        texts.append(" ".join(words))
        for _ in range(draw.randint(0, 4)):
            words[draw.randrange(len(words))] = word()
            texts.append("\t".join(words).upper() if draw.random() < 0.5 else " ".join(words))
    return texts


def test_fingerprints_match_plain_python(spark, documents):
    texts = near_texts() + ODD + ["É À a\x0bb c\x0cd", "one two three", "ONE two\nthree four"]
    rows = by_id(simhash.fingerprints(clashing(documents(texts)), more=True))
    for i, text in enumerate(texts):
        assert rows[i]["fp"] % 2**64 == plain_fingerprint(text)
        assert rows[i]["text_hash"] % 2**64 == xxhash.xxh64_intdigest((text or "").encode(), seed=42)


def test_near_duplicates_match_all_pairs(spark, documents):
    texts = near_texts() + ODD
    docs = clashing(documents([(3 * i + 1, t, "en", "s") for i, t in enumerate(texts)]))
    rows = by_id(simhash.near_duplicates(docs))
    groups = plain_groups({3 * i + 1: plain_fingerprint(t) for i, t in enumerate(texts)})
    assert {i: r["component_id"] for i, r in rows.items()} == groups
    assert len(set(groups.values())) < len(groups)
    assert simhash.near_duplicates(documents([])).count() == 0


def test_null_and_repeated_ids(spark, documents):
    docs = documents([(None, "a b c d e", "en", "s"), (5, "a b c d e", "en", "s"), (5, "a b c d e", "en", "s"), (None, "q", "en", "s")])
    found = sorted((str(r["doc_id"]), str(r["component_id"])) for r in simhash.near_duplicates(docs).collect())
    assert found == [("5", "5"), ("5", "5"), ("None", "5"), ("None", "None")]
    kept = simhash.deduplicated(clashing(docs))
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept.collect()) == [("5", "a b c d e"), ("None", "q")]
    assert kept.columns == clashing(docs).columns


def test_one_document_of_each_group_stays(spark, documents):
    texts = near_texts() + ODD
    groups = plain_groups({i: plain_fingerprint(t) for i, t in enumerate(texts)})
    docs = clashing(documents(texts))
    kept = simhash.deduplicated(docs.unionByName(docs.limit(9)))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(groups.values()))


@pytest.mark.parametrize("radius", [0, 1, 4, 9])
def test_trees_find_all_within_the_radius(radius):
    draw = np.random.default_rng(radius)
    centre = draw.integers(0, 2**63, 4, dtype=np.uint64)
    flips = np.bitwise_or.reduce(np.uint64(1) << draw.integers(0, 64, (300, 4)).astype(np.uint64), axis=1)
    points = np.unique(np.concatenate([centre[draw.integers(0, 4, 300)] ^ flips, draw.integers(0, 2**63, 100, dtype=np.uint64)]))
    groups = np.sort(draw.integers(0, 3, len(points)))
    asks, ask_groups = np.concatenate([points, centre]), np.concatenate([groups, [0, 1, 2, 7]])
    found = set()
    for q, p in Forest(groups, points).within(ask_groups, asks, radius):
        found |= set(zip(q.tolist(), p.tolist(), strict=True))
    wanted = {
        (q, p)
        for q in range(len(asks))
        for p in range(len(points))
        if ask_groups[q] == groups[p] and int(np.bitwise_count(asks[q] ^ points[p])) <= radius
    }
    assert found == wanted


def test_children_are_keyed_by_distance():
    draw = np.random.default_rng(3)
    points = np.unique(draw.integers(0, 2**63, 200, dtype=np.uint64))
    tree = Forest(np.zeros(len(points), int), points)
    assert len(tree.children) == len(points) - 1 and len(set(tree.edges.tolist())) == len(tree.edges)
    parents, distances = tree.edges // 65, tree.edges % 65
    assert (np.bitwise_count(points[parents] ^ points[tree.children]) == distances).all()


def test_labels():
    sets = Labels(8)
    sets.unite(np.array([1, 5, 3]), np.array([2, 6, 4]))
    sets.unite(np.array([6, 4]), np.array([2, 7]))
    assert sets.of.tolist() == [0, 1, 1, 3, 3, 1, 1, 3]


@pytest.mark.parametrize("blocks,tree_rows", [(None, 8192), (5, 10), (6, 3), (8, 8192)])
def test_shards_lose_no_link(spark, blocks, tree_rows, monkeypatch):
    monkeypatch.setattr(simhash, "GATHERED", 50)
    draw = np.random.default_rng(7)
    centre = draw.integers(-(2**62), 2**62, 12)
    near = [int(c) ^ sum(1 << int(b) for b in set(draw.integers(0, 62, draw.integers(0, 5)))) for c in np.repeat(centre, 20)]
    points = sorted(set(near) | set(draw.integers(-(2**62), 2**62, 150).tolist()))
    frame = spark.createDataFrame([(p,) for p in points], "fp bigint").repartition(4)
    pairs = simhash.links(frame, blocks=blocks, tree_rows=tree_rows)
    found, _ = components.components(pairs)
    got = {p: p for p in points} | {r["node"]: r["root"] for r in found.collect()}
    assert got == plain_groups({p: p % 2**64 for p in points})


def test_masks_cover_every_way_to_differ():
    for radius, blocks in ((4, 5), (4, 6), (2, 4)):
        found = simhash.masks(radius, blocks)
        assert len(found) == math.comb(blocks, radius)
        draw = random.Random(1)
        for _ in range(300):
            other = sum(1 << b for b in draw.sample(range(64), radius))
            assert any(other & (m % 2**64) == 0 for m in found)
    assert [simhash.blocks_for(n, 4) for n in (10, 10**5, 10**7, 10**10, 10**14)] == [5, 6, 6, 8, 8]


@pytest.mark.parametrize("bound", [1 << 20, 0])
def test_components_match_plain_search(spark, bound, monkeypatch):
    monkeypatch.setattr(components, "BROADCAST_ROWS", bound)
    draw = random.Random(5)
    chain = [(i, i + 1) for i in range(100, 140)]
    links = chain + [(200, i) for i in range(201, 260)] + [(draw.randrange(300, 400), draw.randrange(300, 400)) for _ in range(60)]
    frame = spark.createDataFrame([*links, (None, 3), (7, 7)], "a bigint, b bigint")
    found, rows = components.components(frame)
    nodes = {n for link in links if link[0] != link[1] for n in link}
    root = {n: n for n in nodes}
    for _ in range(200):
        for a, b in links:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    got = {r["node"]: r["root"] for r in found.collect()}
    assert got == {n: r for n, r in root.items() if n != r} and rows == len(got)
    assert components.components(frame.limit(0))[1] == 0


# -- HTML


@pytest.mark.parametrize("seed", range(30))
def test_cuts_are_minimal(seed):
    draw = random.Random(seed)
    n = draw.randint(1, 9)
    gain = [draw.randint(-9, 9) for _ in range(n)]
    edges = [(a, b, draw.randint(0, 6)) for a, b in itertools.combinations(range(n), 2) if draw.random() < 0.5]

    def cost(kept):
        missed = sum(g for g, k in zip(gain, kept, strict=True) if g > 0 and not k) - sum(g for g, k in zip(gain, kept, strict=True) if g < 0 and k)
        return missed + sum(c for a, b, c in edges if kept[a] != kept[b])

    ways = [list(w) for w in itertools.product((False, True), repeat=n)]
    least = min(map(cost, ways))
    found = mincut.content_side(gain, edges)
    assert cost(found) == least
    assert sum(found) == max(sum(w) for w in ways if cost(w) == least)


def test_long_pages_are_cut_in_time():
    page = "<body><div>" + "<p>Some text of an article, which goes on for quite a while and ends.</p><a href=x>link</a>" * 6000
    assert html_text.main_text(page).count("Some text") == 6000


ARTICLE = """<!DOCTYPE html><html><head><title>T</title><script>var x = "</p><p>no</p>";</script><style>p{}</style></head>
<body class="has-sidebar"><header><h1>Site name</h1><p>The best site of all the world, really it is that.</p></header>
<div id="topMenu"><a href=#>Home</a> <a href=#>About us</a></div>
<div class="cookie-notice">We use cookies on this site to make it better for you and for all others.</div>
<div class="post"><h2>Title &amp; more</h2><p>First  paragraph with <b>bold</b> text,
that has many words &lt;and&gt; an end.</p><!-- <p>hidden</p> --><p>Short.</p><ul><li>one thing<li>another thing</ul>
<form><label>Your name please, it is needed here for it.</label><textarea>typed</textarea></form>
<p>Open paragraph<br>with a break, and with a <a href=x>link</a> in it, that goes on and on.
<p>Last paragraph &copy &#8211; of the text, with many words in it, and a full stop.</div>
<aside><p>Read also this other text, which has many words and ends with a full stop.</p></aside>
<section id="comments"><p>Great article, I liked it very much and I will come back to read more.</p></section>
<div class="advert">Buy this now, it is very cheap and very good, and it is only here.</div>
<footer>(c) me. All rights are reserved by the owner of all of this.</footer></body></html>"""


def test_article_without_what_surrounds_it():
    wanted = [
        "Title & more",
        "First paragraph with bold text, that has many words <and> an end.",
        "Short.",
        "one thing",
        "another thing",
        "Open paragraph with a break, and with a link in it, that goes on and on.",
        "Last paragraph © – of the text, with many words in it, and a full stop.",
    ]
    assert html_text.main_text(ARTICLE).split("\n\n") == wanted


def test_marks_of_other_names():
    text = "Some words of an article, which go on for quite a while, and then they end."
    for mark in ('class="commentlist"', 'id="adverts-top"', 'class="site-footer"', 'role="navigation"', "hidden", 'style="display: none"', 'class="infoBanner"'):
        page = f"<head><title>x</title><div><p>{text}</p></div><div {mark}><p>{text.upper()}</p></div><p>{text}</p>"
        assert html_text.main_text(page) == f"{text}\n\n{text}", mark
    assert html_text.main_text(f"<article><header><h1>Head</h1></header><p>{text}</p><footer>x</footer></article>") == f"Head\n\n{text}"


def test_names_on_wrappers_do_not_decide_alone():
    text = "Some words of an article, which go on for quite a while, and then they end."
    inner = f"<h1>The head</h1><p>{text}</p><p>{text}</p><p>{text}</p>"
    wanted = "\n\n".join(["The head", text, text, text])
    around = f'<div class="sidebar"><p>{text.upper()}</p><a href=x>More of it</a></div><div id="comments"><p>{text.upper()}</p></div>'
    for mark in ('class="content-sidebar-wrap"', 'class="content has-sidebar"', 'id="page" class="menu-open"', 'class="entry-content social-share-on"'):
        for page in (inner, f"<article>{inner}</article>", f"<main><div>{inner}</div></main>"):
            assert html_text.main_text(f"<body><div {mark}>{page}{around}</div></body>") == wanted, (mark, page)
            assert html_text.main_text(f"<body><nav><a href=x>Home</a></nav><div {mark}>{page}</div>{around}</body>") == wanted, (mark, page)
    teasers = "".join(f'<article><h3><a href=x>Other {i}</a></h3><p>{text.upper()}</p></article>' for i in range(3))
    assert html_text.main_text(f'<article>{inner}</article><div class="related">{teasers}</div>') == wanted
    replies = "".join(f'<div class="comment"><p>{text.upper()}</p></div>' for _ in range(40))
    assert html_text.main_text(f'<div id="page" class="menu-open">{inner}<div id="comments">{replies}</div></div>') == wanted


PROSE = "The river rose for three days and the lower town was flooded before anyone had time to leave."
MORE = "People came back in boats to fetch what they could, and slept in the school until the water fell."


@pytest.mark.parametrize(
    "around",
    [
        '<form id="aspnetForm" method="post" action="./">{}</form>',
        '<div style="visibility:hidden" class="js-load">{}</div>',
        '<div aria-hidden="true">{}</div>',
        '<div role="dialog">{}</div>',
        "<dialog open>{}</dialog>",
    ],
)
@pytest.mark.parametrize("inside", ["<main>{}</main>", "<article>{}</article>", "<div>{}</div>"])
def test_wrappers_of_whole_pages_do_not_decide_alone(around, inside):
    article = f"<h1>The flood</h1><p>{PROSE}</p><p>{MORE}</p>"
    small = '<form class="signup"><p>Subscribe to our newsletter, and get all the news of the town each morning.</p></form>'
    page = f"<html><body>{around.format(small + inside.format(article))}<footer><p>© The Town</p></footer></body></html>"
    assert html_text.main_text(page) == f"The flood\n\n{PROSE}\n\n{MORE}"


def test_the_same_elements_beside_an_article_go():
    article = f"<div><h1>The flood</h1><p>{PROSE}</p><p>{MORE}</p></div>"
    text = "<p>Write your name and what you think of us in this box, and we will be back soon.</p>"
    for beside in (f"<form>{text}</form>", f"<div hidden>{text}</div>", f'<div style="display:none">{text}</div>', f'<div role="dialog">{text}</div>', f"<dialog>{text}</dialog>"):
        assert html_text.main_text(f"<body>{beside}{article}</body>") == html_text.main_text(f"<body>{article}{beside}</body>") == f"The flood\n\n{PROSE}\n\n{MORE}"


def test_notices_in_four_languages_go():
    for notice in (
        "All rights reserved, see our privacy policy.", "Alle Rechte vorbehalten, Impressum und Datenschutz finden Sie hier.",
        "Tous droits réservés, mentions légales ci-dessous.", "Todos los derechos reservados, consulte el aviso legal.",
    ):
        page = f"<body><div><h1>The flood</h1><p>{PROSE}</p><p>{MORE}</p></div><div><p>{notice}</p></div></body>"
        assert html_text.main_text(page) == f"The flood\n\n{PROSE}\n\n{MORE}"


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    for row in html_text.extract(pages).join(pages.drop("url"), "page_id").collect():
        inner = row["html"].split("<article>")[1].split("</article>")[0]
        import html

        parts = [re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]*>", "", p.replace("<br>", " ")))).strip() for p in re.split("</?(?:p|h1)>", inner)]
        assert row["text"] == "\n\n".join(filter(None, parts)) and row["n_chars"] == len(row["text"])


def test_odd_pages(spark):
    pages = [None, "", "plain text only, without any mark-up, but with enough words to be read", "<", "<p", "<!-- open", "<script>x", "<div><nav>a", "</p></div>", "<p>" * 3000]
    frame = spark.createDataFrame([(i, "u", p) for i, p in enumerate(pages)] + [(None, None, "<p>x")], "page_id bigint, url string, html string")
    frame = frame.withColumn("text", F.lit("x")).withColumn("n_chars", F.lit("x"))
    found = {r["page_id"]: r for r in html_text.extract(frame.unionByName(frame.limit(1))).collect()}
    assert found[2]["text"] == pages[2] and found[0]["text"] == found[1]["text"] == found[5]["text"] == ""
    assert html_text.extract(frame.limit(0)).count() == 0


# -- shards


def plain_shards(rows, limit):
    """Buckets split on one more bit until they fit."""
    hashed = [(r, int(hashlib.md5(f"{r[0]}:{r[1]}:{r[2]}".encode()).hexdigest()[:15], 16)) for r in rows]
    done, todo = {}, [("", hashed)]
    while todo:
        bits, held = todo.pop()
        if not held:
            continue
        if sum(r[1] for r, _ in held) <= limit or len(held) == 1 or len(bits) == 60:
            done |= {r: (bits, sum(x[1] for x, _ in held), len(held)) for r, _ in held}
            continue
        for bit in (0, 1):
            todo.append((f"{bits}{bit}", [(r, h) for r, h in held if h >> (59 - len(bits)) & 1 == bit]))
    return done


@pytest.mark.parametrize("limit,big", [(2000, 100), (2000, 5000), (10**9, 100), (1, 50)])
def test_shards_match_plain_splitting(spark, documents, limit, big):
    draw = random.Random(limit)
    docs = clashing(documents([(i, "é" * draw.randint(0, big), "en", "s") for i in range(300)] + [(5, "x" * 10, "en", "s")] * 80))
    found = sharding.assign(docs, limit=limit)
    got = {(r["doc_id"], r["n_bytes"], r["copy"]): (r["shard"], r["shard_bytes"], r["shard_docs"]) for r in found.collect()}
    assert got == plain_shards(list(got), limit) and len(got) == 380
    entries = sharding.directory(found).orderBy("first").collect()
    assert all(a["last"] < b["first"] for a, b in zip(entries, entries[1:], strict=False))
    deepest = max(e["depth"] for e in entries)
    assert all(format(e["first"], f"0{deepest}b")[: e["depth"]] == e["shard"] for e in entries if deepest)


def test_shards_of_odd_rows_and_written_ones(spark, documents, tmp_path):
    docs = documents([(i, t, "en", "s") for i, t in enumerate(ODD)] + [(None, "x", "en", "s")] * 3)
    found = sharding.assign(docs, limit=40)
    assert found.count() == len(ODD) + 3
    sharding.write(docs, found, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(str, (r["row"]["text"] for r in back.collect()))) == sorted(map(str, (r["text"] for r in docs.collect())))
    sizes = back.groupBy("shard_folder").agg(F.sum(F.octet_length("row.text")).alias("b"), F.count("*").alias("n")).collect()
    assert all((r["b"] or 0) <= 40 or r["n"] == 1 for r in sizes)
    assert sharding.assign(documents([])).count() == 0


# -- mixtures


def plain_copies(doc_id, rate, seed=mixing.SEED):
    parts = max(1, math.ceil(rate / mixing.MEAN))
    mean, n = rate / parts, 0
    for j in range(parts):
        u = int(hashlib.md5(f"{seed}:{'' if doc_id is None else doc_id}:{j}".encode()).hexdigest()[:13], 16) / 2**52
        p = total = math.exp(-mean)
        k = 0
        while total <= u and k < 100:
            k += 1
            p *= mean / k
            total += p
            n += 1
    return n


def plain_rates(docs, weights=None, total=None):
    sizes = {}
    for _, text, source in docs:
        sizes[source] = sizes.get(source, 0) + len(text or "") + 1
    weights = weights or dict.fromkeys(sizes, 1.0)
    total = total or sum(sizes.values())
    return {s: weights.get(s, 0) * total / sum(weights.get(x, 0) for x in sizes) / n for s, n in sizes.items()}


@pytest.mark.parametrize("weights,total", [(None, None), ({"a": 1.0, "b": 3.0}, None), ({"a": 1.0, None: 1.0}, 50_000.0)])
def test_mixture_matches_plain_inversion(spark, documents, weights, total):
    draw = random.Random(3)
    rows = [(i, draw.choice([None, "", "x" * draw.randint(0, 99)]), "en", draw.choice(["a", "a", "a", "b", None])) for i in range(300)] + [(900, "tiny", "en", "c")]
    docs = clashing(documents(rows))
    mixed = mixing.mixed(docs, weights, total=total)
    got = {}
    for r in mixed.collect():
        got.setdefault(r["row"]["doc_id"], []).append(r["copy"])
    rates = plain_rates([(r[0], r[1], r[3]) for r in rows], weights, total)
    wanted = {r[0]: plain_copies(r[0], rates[r[3]]) for r in rows}
    assert {i: sorted(c) for i, c in got.items()} == {i: list(range(1, n + 1)) for i, n in wanted.items() if n}
    assert mixing.sampled_rows(docs, weights, total=total).columns == docs.columns


def test_mixture_reaches_its_weights(spark, documents):
    docs = documents([(i, "x" * 99, "en", "hot" if i % 3 else f"s{i % 4}") for i in range(6000)])
    sums = {r["source"]: r["n"] for r in mixing.sampled_rows(docs).groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert all(n == pytest.approx(6000 / len(sums), rel=0.1) for n in sums.values()) and len(sums) == 5
    keys = [r["shuffle_key"] for r in mixing.mixed(docs, keep_text=False).collect()]
    assert len(set(keys)) == len(keys)
    assert mixing.mixed(documents([])).count() == 0


def test_endless_copies_are_refused(spark, documents):
    docs = documents([(1, "a", "en", "small"), (2, "x" * 1000, "en", "large")])
    with pytest.raises(ValueError, match="most_copies"):
        mixing.mixed(docs, total=3e11)
    assert mixing.mixed(docs, {"small": 1.0, "large": 0.0}, total=4000.0).count() == pytest.approx(2000, rel=0.1)
    with pytest.raises(ValueError, match="most_copies"):
        mixing.mixed(docs, {"small": 1.0}, total=4000.0, most_copies=1000.0)


def test_same_mixture_for_any_partitioning_and_without_broadcast(spark, documents, monkeypatch):
    docs = documents([(i, "x" * (i % 50), "en", f"s{i % 3}") for i in range(500)])
    key = lambda df: sorted((r["row"]["doc_id"], r["copy"], r["shuffle_key"]) for r in df.collect())
    first = key(mixing.mixed(docs))
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", 0)
    assert key(mixing.mixed(docs.repartition(7))) == first


# -- queries and pipeline


def test_sql_twins(spark):
    from tests.check_oracle import compare, connect

    con = connect("/root/testdata/sf0.001")
    for name, sql in queries.ORACLES.items():
        assert compare(spark, con, "/root/testdata/sf0.001", name, queries.QUERIES[name], sql) is None


def test_all_are_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))


def test_pipeline_matches_plain_python(spark, documents, tmp_path):
    import corpus_pipeline
    from tokenizers import Tokenizer

    draw = random.Random(2)
    rows = language_rows(120)
    rows = [(i, t, lang, draw.choice(["a", "a", "b"])) for i, t, lang, _ in rows]
    rows += [(500 + i, rows[i][1], "en", "b") for i in range(10)]  # copies
    rows += [(600, None, "en", "a"), (601, "123 456", "en", "a"), (602, rows[20][1] + ' token = "abcdefgh12345678"', "en", "b"), (None, "the and of that", "en", None)]
    docs = documents(rows).withColumn("extra", F.lit("x"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]

    model = langid.fit(docs)
    scorer = langid.Scorer(model)
    kept = [r for r in rows if (lambda f: f[0] != "und" and f[1] >= 0.4)(scorer.predict(r[1]))]
    assert len(kept) == len(rows) - 2
    prints = {i: plain_fingerprint(r[1]) for i, r in enumerate(sorted(kept, key=lambda r: (r[0] is None, r[0])))}
    ordered = sorted(kept, key=lambda r: (r[0] is None, r[0]))
    kept = [ordered[i] for i, root in plain_groups(prints).items() if i == root]
    clean = []
    for i, text, _, source in kept:
        out, at = "", 0
        for start, _, _, end in plain_secrets(text)[1]:
            if start >= at:
                out += text[at:start] + "[SECRET]"
            at = max(at, end)
        clean.append((i, out + text[at:], source))
    rates = plain_rates(clean)
    theirs = Tokenizer.from_file(PATH)
    wanted = []
    for i, text, source in clean:
        ids = theirs.encode(text, add_special_tokens=False).ids
        row = (i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha(theirs.decode(ids, skip_special_tokens=False)))
        wanted += [row] * plain_copies(i, rates[source])
    assert sorted(got, key=str) == sorted(wanted, key=str)


def test_stages_keep_the_columns(spark):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_near_dedup", "secret_scan", "source_mixture", "bpe_codec"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.dtypes == docs.dtypes
        assert stage(spark, docs.limit(0), "/root/testdata/sf0.001").count() == 0
