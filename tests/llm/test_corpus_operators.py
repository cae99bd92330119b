"""Operators over the whole corpus against brute force, with edge rows."""

from __future__ import annotations

import base64
import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from triplake.llm import html, jaccard, lines, quality, secrets, warc
from triplake.llm.queries import QUERIES
from triplake.llm.vocabulary import default_path
from triplake.session import new_scratch

LIBRARY = Tokenizer.from_file(default_path())

# ---- archives


@settings(max_examples=50, deadline=None)
@given(st.lists(st.binary(max_size=300), max_size=12))
def test_archive_round_trip(records):
    data = b"".join(
        frame + warc._NO_RECORD for frame in warc.archive_frames(records)
    )
    assert list(warc.archive_records(data)) == records
    assert data[:4] == bytes.fromhex("5d2a4d18")


@pytest.mark.parametrize("records", [
    [b""] * 12 + [b"x" * 9000], [b"ab"] * 11 + [bytes(range(256))], [b"12345678"] * 9, [b"x" * 7] * 40,
])
def test_records_that_nothing_can_be_trained_from(records):
    data = b"".join(f + warc._NO_RECORD for f in warc.archive_frames(records))
    assert list(warc.archive_records(data)) == records


def test_dictionary_is_used_and_plain_readers_read_on():
    records = [b"WARC/1.1\r\nName: %d\r\n" % i + b"common text of every record " * 4 for i in range(300)]
    frames = list(warc.archive_frames(records))
    assert len(frames[0]) > 8
    import zstandard

    alone = zstandard.ZstdCompressor(level=warc.LEVEL).compress(records[0])
    assert len(frames[1]) < len(alone)
    with pytest.raises(ValueError):
        list(warc.archive_records(b"".join(frames)[:-3]))


def test_pages_come_back_from_archives(spark):
    pages = [
        (5, "http://a/1", "<p>one</p>"), (3, "http://a/2", "<p>one</p>"), (9, None, None),
        (4, "http://b/\r\nX: 1", ""), (None, "http://c", "<p>one</p>"), (7, "u", "é\r\n\r\nrest"),
        (7, "u", "é\r\n\r\nrest"), (8, "v", "x" * 200_000), (10, "w", "x" * 200_000),
    ]
    df = spark.createDataFrame([(*p, "n") for p in pages], "page_id long, url string, html string, sha string")
    path = new_scratch(spark, "warc-test")
    warc.write_archives(df, path, archive_records_=2)
    firsts = {}
    for page_id, _, text in pages:
        if page_id is not None:
            firsts[text or ""] = min(page_id, firsts.get(text or "", page_id))
    want = collections.Counter()
    for page_id, url, text in pages:
        body = (text or "").encode()
        first = firsts[text or ""]
        again = page_id is None or page_id > first
        url = url and url.replace("\r", "%0D").replace("\n", "%0A")
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        want[page_id, url, len(body), digest, "revisit" if again else "response",
             first if again else None, None if again else body] += 1
    got = collections.Counter(
        (*r[:6], None if r["payload"] is None else bytes(r["payload"]))
        for r in warc.read_archives(spark, path).collect()
    )
    assert got == want
    empty = new_scratch(spark, "warc-empty")
    warc.write_archives(df.limit(0), empty)
    assert warc.read_archives(spark, empty).count() == 0


def test_archives_are_bounded_by_bytes(spark):
    rng = random.Random(6)
    rows = [(i, f"u{i}", "".join(rng.choice("abcdefgh ") for _ in range(rng.choice([10, 300, 9000])))) for i in range(120)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(2)
    path = new_scratch(spark, "warc-bytes")
    warc.write_archives(df, path, archive_records_=30, archive_bytes=20_000)
    files = spark.read.format("binaryFile").load(path).select("content").collect()
    sizes = [[len(r) for r in warc.archive_records(bytes(f["content"]))] for f in files]
    assert sum(map(len, sizes)) == 120 and len(sizes) > 12
    assert all(len(s) <= 30 and sum(s[:-1]) < 20_000 for s in sizes)
    back = {r["page_id"]: bytes(r["payload"]) for r in warc.read_archives(spark, path).collect() if r["payload"] is not None}
    assert all(back[i] == html_.encode() for i, _, html_ in rows if i in back) and len(back) > 100


# ---- pages

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body class="has-sidebar">
<header id=top>Site &amp; name</header><nav><ul><li>Menu<li>More</ul></nav>
<div class="cookie-notice">We use cookies</div>
<div id="layout"><article><header><h1>Head {0}</h1></header>
<p><b>First {0}<br>line &lt;here&gt;<p>Second&nbsp; &#233; {0}<script>var a = "</p>";</script>
<div class="box17"><p>Read our letter</p></div>
<ul><li>one {0}<li>two</ul><form><p>Mail</p></form><p>Read our letter</p>
<section class="comments"><article class=comment>Reader says</article></section>
</article><div class="side">Everywhere the same</div><aside>Side</aside></div><footer>&copy; us</footer>"""


def test_main_text_of_pages(spark):
    rows = [(i, f"http://h.example/{i}", PAGE.format(i)) for i in range(8)]
    rows += [
        (20, "http://single.example/", PAGE.format(20)), (21, None, None), (22, "not a url", ""),
        (23, "http://plain.example", "just text &amp &am <b>bold"), (0, rows[0][1], rows[0][2]),
        (24, "http://x.example", "<div>" * 3000 + "deep"), (25, "http://x.example", "a < b <3 <a href='x>y'>z</a> <unclosed"),
        (26, "http://t.example", "<table><tr><td>1<td>2<tr><td>3</table><p>end"),
    ]
    df = spark.createDataFrame([(*r, "kept") for r in rows], "page_id long, url string, html string, n_template string")
    got = collections.defaultdict(list)
    for r in html.extract(df).collect():
        got[r["page_id"]].append(r)

    def want(i, letter):
        blocks = [f"Head {i}", f"First {i} line <here>", f"Second é {i}", *letter, f"one {i}", "two", "Read our letter"]
        return "\n\n".join(blocks)

    # The box recurs on the host; the same words as a paragraph of the article stay.
    assert {r["text"] for r in got[3]} == {want(3, [])} and got[3][0]["n_template"] > 0
    assert got[20][0]["text"] == want(20, ["Read our letter"])
    assert len(got[0]) == 2
    assert got[21][0]["text"] == got[22][0]["text"] == ""
    assert got[23][0]["text"] == "just text & &am bold"
    assert got[24][0]["text"] == "deep"
    assert got[25][0]["text"] == "a < b <3 z"
    assert got[26][0]["text"] == "1\n\n2\n\n3\n\nend"
    assert html.extract(df.limit(0)).count() == 0


def test_copies_of_an_article_are_no_template(spark):
    page = "<body><div><p>The same article on every page of this host, word for word.</p></div></body>"
    rows = [(i, f"http://copies.example/{i}", page) for i in range(30)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r["text"] for r in html.extract(df).collect()} == {
        "The same article on every page of this host, word for word."
    }


def test_templates_do_not_depend_on_the_size_of_the_host(spark):
    box = "<div><p>Read more of this section</p></div>"
    rows = [
        (i, f"http://large.example/{i}", f"<body>{box if i < 6 else ''}<p>Text number {i} of this host, which is its own.</p></body>")
        for i in range(60)
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r["text"] for r in html.extract(df).collect()} == {
        f"Text number {i} of this host, which is its own." for i in range(60)
    }


def test_slugs_and_wrapping_forms_keep_their_text():
    inner = (
        "<div class='entry-header'>Title</div><h2 id='social-impact'>Social impact</h2>"
        "<section id='related-work'><p class='share-price'>Price</p></section>"
        "<div class='advert'>Buy</div><div class='comments'>Says</div>"
    )
    kept = "Title\n\nSocial impact\n\nPrice"
    article = f"<article>{inner}</article>"
    for page in (article, f"<form><nav>Menu</nav>{article}</form>"):
        assert html.main_text(page, set())[0] == kept
    plain = "<h2 id='discussion'>Discussion</h2><p>The text of a page in a form.</p>"
    page = f"<body><nav>Menu</nav><form id='aspnetForm'>{plain}<select><option>One</select></form></body>"
    assert html.main_text(page, set())[0] == "Discussion\n\nThe text of a page in a form."
    assert html.main_text(f"<body>{plain}<form>Your mail</form></body>", set())[0] == (
        "Discussion\n\nThe text of a page in a form."
    )


WHOLE = "<p>The whole text of this page stands here, all of it in one paragraph.</p>"


@pytest.mark.parametrize("wrapper", [
    "div class=layout-sidebar-left", "div class=content-with-sidebar", "section id=social-science",
    "div id=share-prices", "div class=notice-board", "div class='post menu-open'",
    "div class=widget-wrap", "div class=page-header", "form id=aspnetForm", "div class=sidebar",
])
def test_layouts_keep_their_page(wrapper):
    tag = wrapper.split()[0]
    page = f"<body><nav>Menu</nav><{wrapper}>{WHOLE}</{tag}><div class=footer>Ours</div></body>"
    assert html.main_text(page, set())[0] == WHOLE[3:-4]


@pytest.mark.parametrize("inner,stays", [
    ("div id=comments", False), ("section class=comment-list", False), ("div id=disqus_thread", False),
    ("div class=share-buttons", False), ("div class=related", False), ("div class=cookie-notice", False),
    ("div class=sidebar", False), ("div class=ad-slot", False), ("div class=article-footer", False),
    ("aside", False), ("div style='display: none'", False),
    ("section id=related-work", True), ("p class=share-price", True), ("div class=entry-header", True),
    ("h2 id=comments", True), ("section id=discussion", True), ("div class=box", True),
])
def test_parts_of_an_article(inner, stays):
    tag = inner.split()[0]
    page = f"<article><h1>Head</h1>{WHOLE}<{inner}>Part</{tag}></article><div class=sidebar>x</div>"
    want = ["Head", WHOLE[3:-4]] + ["Part"] * stays
    assert html.main_text(page, set())[0].split("\n\n") == want


def test_comments_do_not_count_as_the_page():
    page = f"<body><div class=post>{WHOLE}</div><div class=comments><p>{'long ' * 99}</p></div>"
    assert html.main_text(page, set())[0] == WHOLE[3:-4]


@pytest.mark.parametrize("seed", [1, 2])
def test_generated_sites(spark, seed):
    """Hosts whose pages are put together from blocks that are known to recur or not."""
    rng = random.Random(seed)
    rows, pages = [], []
    for host in range(4):
        boxes = [f"<div class=b{k}><span>Box {host} {k}</span></div>" for k in range(6)]
        for n in range(rng.choice([3, 12, 25])):
            number, inside = len(pages), rng.random() < 0.5
            used = [k for k in range(6) if rng.random() < (0.1, 0.2, 0.5, 0.5, 0.9, 1)[k]]
            parts = [("p", f"Own words {number} {i} " + "and more " * rng.randint(5, 9) + "here.") for i in range(3)]
            parts += [("box", k) for k in used] + [("p", "Said on every page")] * inside
            rng.shuffle(parts)
            body = "".join(boxes[v] if kind == "box" else f"<p>{v}</p>" for kind, v in parts)
            page = f"<body><nav>Menu</nav>{f'<article>{body}</article><div>Beside</div>' if inside else body}</body>"
            pages.append((host, parts))
            rows.append((number, f"http://h{host}.example/{number}", page, "kept"))
    counts = collections.Counter((h, v) for h, parts in pages for kind, v in set(parts) if kind == "box")
    want = {
        i: "\n\n".join(
            f"Box {h} {v}" if kind == "box" else v for kind, v in parts
            if kind == "p" or counts[h, v] < html.TEMPLATE_PAGES
        )
        for i, (h, parts) in enumerate(pages)
    }
    df = spark.createDataFrame(rows, "page_id long, url string, html string, Text string")
    out = html.extract(df)
    assert out.columns == ["page_id", "url", "text", "n_template"]
    assert {r["page_id"]: r["text"] for r in out.collect()} == want
    assert 0 < sum(n >= html.TEMPLATE_PAGES for n in counts.values()) < len(counts)


# ---- lines


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def plain_lines(docs):
    order = sorted(range(len(docs)), key=lambda i: (docs[i][0] is None, docs[i][0] or 0))
    seen, first = [], {}
    for i in order:
        for at, raw in enumerate((docs[i][1] or "").split("\n")):
            line = raw.strip(" \t\x0b\x0c\r")
            if line and line not in first:
                first[line] = (i, at)
                seen.append(line)
    near = set()
    for k, line in enumerate(seen):
        for other in seen[:k]:
            if min(len(line), len(other)) >= lines.LEAST_CHARS and abs(len(line) - len(other)) <= 1:
                if distance(line, other) == 1:
                    near.add(line)
                    break
    out = {}
    for i in order:
        if docs[i][1] is None:
            out[docs[i][0]] = (None, 0, 0)
            continue
        kept, exact, close = [], 0, 0
        for at, raw in enumerate(docs[i][1].split("\n")):
            line = raw.strip(" \t\x0b\x0c\r")
            if line and first[line] != (i, at):
                exact += 1
            elif line in near:
                close += 1
            else:
                kept.append(raw)
        out[docs[i][0]] = ("\n".join(kept), exact, close)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_lines_one_edit_apart(spark, seed):
    rng = random.Random(seed)
    letters = "abé d"
    bases = ["".join(rng.choice(letters) for _ in range(n)) for n in (19, 20, 21, 33, 64, 65, 150, 1300)]

    def edit(line):
        at = rng.randrange(len(line) + 1)
        kind = rng.randrange(4)
        if kind == 0:
            return line[:at] + rng.choice(letters) + line[at:]
        if kind == 1:
            return line[:at] + line[at + 1 :]
        if kind == 2:
            return line[:at] + rng.choice(letters) + line[at + 1 :]
        return line

    docs = []
    for i in range(40):
        body = []
        for _ in range(rng.randrange(6)):
            line = rng.choice(bases)
            for _ in range(rng.randrange(3)):
                line = edit(line)
            body.append(rng.choice(["", " "]) + line)
        body += rng.choice([[], [""], ["  "], ["short"], ["Short"]])
        docs.append((i * 3 % 40, "\n".join(body)))
    docs += [(50, None), (51, ""), (None, bases[3]), (52, "\n\n")]
    df = spark.createDataFrame([(*d, 1, "r") for d in docs], "doc_id long, text string, n_near int, `row` string")
    out = lines.dedup(df)
    assert out.columns == ["doc_id", "text", "row", "n_exact", "n_near"]
    got = {r["doc_id"]: (r["text"], r["n_exact"], r["n_near"]) for r in out.collect()}
    assert got == plain_lines(docs)
    assert lines.dedup(df.limit(0)).count() == 0


def test_rows_alike_are_one_document(spark):
    df = spark.createDataFrame([(1, "a line of text"), (1, "a line of text"), (2, "a line of text")], "doc_id long, text string")
    assert sorted((r["doc_id"], r["text"]) for r in lines.dedup(df).collect()) == [
        (1, "a line of text"), (1, "a line of text"), (2, "")
    ]


def test_no_python_in_line_dedup(spark, sf_small):
    plan = QUERIES["op9_lines"](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# ---- similar sets


def plain_components(docs, words, percent):
    sets = []
    for _, text in docs:
        found = (text or "").encode().lower().split()
        width = min(words, len(found))
        sets.append({tuple(found[i : i + width]) for i in range(len(found) - width + 1)} if found else set())
    up = list(range(len(docs)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in itertools.combinations(range(len(docs)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * len(sets[i] | sets[j]):
            up[max(top(i), top(j))] = min(top(i), top(j))
    least = collections.defaultdict(lambda: 1 << 60)
    for i, (doc_id, _) in enumerate(docs):
        least[top(i)] = min(least[top(i)], doc_id)
    return {d[0]: (len(sets[i]), least[top(i)]) for i, d in enumerate(docs)}


@pytest.mark.parametrize("words,percent,parts,seed", [(3, 90, 3, 1), (5, 80, 2, 2), (1, 70, 3, 3)])
def test_components_of_similar_sets(spark, words, percent, parts, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    docs = []
    for _ in range(14):
        text = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 4, 12, 25, 60, 200]))]
        for _ in range(rng.randrange(1, 9)):
            docs.append(" ".join(text))
            text = list(text)
            for _ in range(rng.randrange(1 + len(text) // 25)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
    rng.shuffle(docs)
    docs = [(i * 2, t) for i, t in enumerate(docs)] + [(901, None), (903, ""), (905, " \n"), (907, "W1"), (909, "w1")]
    df = spark.createDataFrame([(*d, 7) for d in docs], "doc_id long, text string, node long")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.link(df, words=words, percent=percent, parts=parts).collect()}
    assert got == plain_components(docs, words, percent)


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 160), st.integers(0, 60), st.sampled_from([(90, 3), (80, 2), (80, 3), (60, 3)]), st.integers(0, 10**6))
def test_similar_sets_share_a_signature(size, changes, kind, seed):
    percent, parts = kind
    rng = np.random.default_rng(seed)
    pool = np.unique(rng.integers(0, 2**63, size + 2 * changes + 2, dtype=np.uint64))
    one = pool[:size]
    cut = min(changes, size - 1)
    two = np.sort(np.concatenate([one[cut:], pool[size : size + int(rng.integers(0, changes + 1))]]))
    both = len(np.intersect1d(one, two))
    signatures = jaccard.Signatures(percent, parts)
    alike = 100 * both >= percent * (len(one) + len(two) - both)
    if alike and not np.array_equal(one, two):
        assert np.intersect1d(signatures.of(np.sort(one)), signatures.of(two)).size
    difference = len(one) + len(two) - 2 * both
    assert np.bitwise_count(jaccard.sketch(one, 512) ^ jaccard.sketch(two, 512)).sum() <= difference
    assert jaccard.sketches_apart(jaccard.fitting_sketch(one), jaccard.fitting_sketch(two)) <= difference
    if alike:
        assert difference <= jaccard.most_apart(len(one), len(two), percent)


def test_edge_rows_of_similar_sets(spark):
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (8, "A B C D E F"), (9, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r[0], r[2]) for r in jaccard.link(df).collect()), key=str)
    assert got == sorted([(None, None), (3, 3), (3, 3), (8, 3), (9, 9)], key=str)
    kept = [r["doc_id"] for r in jaccard.keep_one(df).collect()]
    assert sorted(kept, key=str) == sorted([None, 3, 3, 9], key=str)
    assert jaccard.link(df.limit(0)).count() == 0


def test_large_signatures_are_cut_into_units(spark):
    # Key 1: a large group and an outlier; 2: one group; 3: large and small groups; 4: two nodes.
    group_of = {n: 0 if n < 100 else 500 if n < 160 else n // 3 * 3 for n in range(200)}
    members = {1: [*range(100), 199], 2: list(range(100)), 3: list(range(200)), 4: [5, 150]}
    shared = spark.createDataFrame([(k, n, 0) for k, ns in members.items() for n in ns], "key long, node long, first long")
    placed = spark.createDataFrame(list(group_of.items()), "node long, group long")
    units = collections.defaultdict(lambda: ([], []))
    for r in jaccard.cross_units(shared, placed, 16).collect():
        assert r["group"] == group_of[r["node"]]
        units[r["key"], r["unit"]][r["side"]].append(r["node"])
    got = collections.Counter()
    for (key, _), (left, right) in units.items():
        assert len(left) + len(right) <= 4 * 16
        met = itertools.product(left, right) if right else itertools.combinations(left, 2)
        got.update((key, min(p), max(p)) for p in met if group_of[p[0]] != group_of[p[1]])
    assert got == collections.Counter(
        (k, *p) for k, ns in members.items() for p in itertools.combinations(ns, 2)
        if group_of[p[0]] != group_of[p[1]]
    )
    assert jaccard.cross_units(shared.filter("key = 2"), placed, 16) is None


@pytest.mark.parametrize("rows_a_batch", [1, 4, 100])
def test_units_are_compared_over_batches(rows_a_batch):
    rows = [  # key, unit, side, group, node
        (1, 7, 0, 0, 1), (1, 7, 0, 0, 2), (1, 7, 0, 5, 5),
        (1, 9, 0, 0, 3), (1, 9, 0, 5, 6), (1, 9, 1, 0, 4), (1, 9, 1, 5, 7),
        (2, 9, 0, 3, 8), (2, 9, 0, 4, 9),
    ]
    names = ["key", "unit", "side", "group", "node", "size", "sketch"]
    batches = [
        pa.RecordBatch.from_pylist([dict(zip(names, (*r, 50, bytes(128)))) for r in rows[i : i + rows_a_batch]])
        for i in range(0, len(rows), rows_a_batch)
    ]
    got = [tuple(p.values()) for b in jaccard._across(iter(batches), 80) for p in b.to_pylist()]
    assert sorted(got) == [(1, 5), (2, 5), (3, 7), (4, 6), (8, 9)]


def test_closest_pairs_of_two_groups():
    rng = np.random.default_rng(4)
    base = np.unique(rng.integers(0, 2**63, 300, dtype=np.uint64))
    rows = []
    for node in range(40):  # near copies, in three groups
        own = np.delete(base, rng.integers(0, len(base), 1 + node % 12))
        rows.append((1, 1, 0, node % 3, node, len(own), jaccard.fitting_sketch(own).tobytes()))
    rows.sort(key=lambda r: r[:5])
    names = ["key", "unit", "side", "group", "node", "size", "sketch"]
    batch = pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows])

    def pairs(nearest):
        return {tuple(p.values()) for b in jaccard._across(iter([batch]), 80, nearest) for p in b.to_pylist()}

    group = {r[4]: r[3] for r in rows}
    every, closest = pairs(False), pairs(True)
    assert len(every) > 400 and closest <= every
    assert sorted(tuple(sorted((group[a], group[b]))) for a, b in closest) == [(0, 1), (0, 2), (1, 2)]


def test_components_of_a_chain(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 150)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["group"] for r in jaccard.components(df).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 200: 100, 150: 100}


# ---- pipeline


@pytest.fixture(scope="module")
def sf_small():
    return "/root/testdata/sf0.001"


def test_pipeline_stages(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    columns = docs.columns
    rules = quality.fit(docs, spark.read.parquet(f"{sf_small}/labels.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        before = [r.asDict() for r in docs.collect()]
        path = new_scratch(spark, name)
        stage(spark, docs, sf_small).write.parquet(path)
        docs = spark.read.parquet(path)
        after = docs.collect()
        if name != "best_fit_packing":
            assert docs.columns == columns
            assert all(r["n_chars"] == len(r["text"]) for r in after)
        kept = {r["doc_id"] for r in after}
        if name == "quality_rules":
            judged = quality.judge(spark.createDataFrame(before, docs.schema), rules)
            assert kept == {r["doc_id"] for r in judged.filter("kept").collect()}
        elif name == "line_dedup":
            plain = plain_lines([(r["doc_id"], r["text"]) for r in before])
            want = {
                d: t for d, (t, exact, near) in plain.items() if t.strip(" \t\n\x0b\x0c\r") or not exact + near
            }
            assert {r["doc_id"]: r["text"] for r in after} == want
        elif name == "near_duplicates":
            plain = plain_components([(r["doc_id"], r["text"]) for r in before], 5, 80)
            assert kept == {d for d, (_, c) in plain.items() if c == d}
        elif name == "secret_scan":
            want = plain_masked([(r["doc_id"], r["text"], r["source"]) for r in before])
            assert {r["doc_id"]: r["text"] for r in after} == want
        else:
            assert kept == {r["doc_id"] for r in before}
            check_packed(after, {r["doc_id"]: r["text"] for r in before})
    assert corpus_pipeline.ORACLE_SQL is None


def plain_masked(docs):
    """Texts without live values, from owners counted one document after another."""
    owners, random_looking = collections.defaultdict(set), collections.defaultdict(bool)
    found = {i: secrets.find(text) for i, text, _ in docs}
    for i, _, owner in docs:
        for c in found[i]:
            owners[c["value"]].add(owner)
            random_looking[c["value"]] |= c["random"]
    out = {}
    for i, text, _ in docs:
        live = [c for c in found[i] if len(owners[c["value"]]) <= 2 and random_looking[c["value"]]]
        at, parts = 0, []
        for c in live:
            if c["end"] > at:
                parts += [text[at : max(at, c["start"])], "[secret]"]
                at = c["end"]
        out[i] = "".join([*parts, text[at:]])
    return out


def check_packed(pieces, texts):
    """Pieces hold every document's ids in order, and fill sequences without gaps."""
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in pieces:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, text in texts.items():
        ids = [*LIBRARY.encode(text, add_special_tokens=False).ids, 0]
        own = sorted(by_doc[i], key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own)))
        assert len(own) == 1 or all(r["length"] == 2048 for r in own[1:])
        at = 0
        for r in own:
            part = np.array(ids[at : at + r["length"]], "<u4").tobytes()
            assert (r["start"], r["ids_crc32"]) == (at, zlib.crc32(part))
            at += r["length"]
        assert at == len(ids)
    for placed in by_sequence.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 2048


def test_pipeline_rows_that_are_odd(spark, sf_small):
    """NULL, empty and repeated rows, clashing names, and an empty table."""
    words = " ".join(f"word{i} and" for i in range(40))
    rows = [(1, words, "en", "s", 0, 9, 8, 7), (1, words, "en", "s", 0, 9, 8, 7), (2, None, None, None, None, 1, 1, 1),
            (3, "", "en", "s", 0, 1, 1, 1), (None, words + " other", "en", None, 0, 5, 5, 5)]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, exact int, gone int, spans int"
    )
    for name, stage in corpus_pipeline.STAGES[1:]:
        out = stage(spark, docs, sf_small).collect()
        assert stage(spark, docs.limit(0), sf_small).count() == 0
        if name != "best_fit_packing":
            assert len({r["doc_id"] for r in out} & {1, 2, 3, None}) == 4
            assert {r["doc_id"]: (r["exact"], r["gone"], r["spans"]) for r in out}[1] == (9, 8, 7)
        else:
            assert sorted(str(r["doc_id"]) for r in out) == ["1", "1", "2", "3", "None"]
    assert {r["doc_id"] for r in corpus_pipeline.quality_rules(spark, docs, sf_small).collect()} <= {1, None}


def test_registered():
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES}
    assert {*QUERIES, "pipeline"} <= set(queries())
    assert "op9_lines" in oracle_sql()


def test_sets_and_signatures_are_made_for_many_texts_at_once(monkeypatch):
    rng = random.Random(7)
    texts = [None, "", " \n", "w1", "w1 w2", "W1 w2 w3", "w1 w2 w3 w1 w2 w3", "\u00e9 \ud800 x y"]
    texts += [" ".join(f"w{rng.randrange(40)}" for _ in range(rng.randrange(200))) for _ in range(300)]
    for words, percent, parts in ((3, 90, None), (5, 80, None), (1, 60, 3)):
        signatures = jaccard.Signatures(percent, parts)
        elements, sizes = jaccard.shingle_sets(texts, words)
        sets = np.split(elements, np.cumsum(sizes)[:-1])
        for text, found in zip(texts, sets):
            split = (text or "").lower().split()
            width = min(words, len(split))
            plain = {tuple(split[i : i + width]) for i in range(len(split) - width + 1)} if split else set()
            assert len(found) == len(plain) and np.array_equal(found, np.unique(found))
            assert np.array_equal(found, jaccard.shingles(text, words))
        for number in range(signatures.rounds):
            keys, places = signatures.of_sets(elements, sizes, signatures.rounds, number)
            for i, found in enumerate(sets):
                one = signatures.of(found, signatures.rounds, number)
                assert sorted(keys[places == i].tolist()) == sorted(one.tolist())
    # The numpy calls are as many for 40 texts as for 300 of their length.
    calls = []
    mixed = jaccard._mixed
    monkeypatch.setattr(jaccard, "_mixed", lambda x: calls.append(1) or mixed(x))
    made = []
    for texts in (["a b c d e f"] * 40, ["a b c d e f"] * 300):
        calls.clear()
        assert len(list(jaccard.each_set(texts, 3))) == len(texts)
        jaccard.Signatures(90).of_sets(*jaccard.shingle_sets(texts, 3))
        made.append(len(calls))
    assert made[0] == made[1]
