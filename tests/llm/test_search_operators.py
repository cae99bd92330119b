"""Decontamination, hard negatives and whitening against brute force, with edge rows."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from __spark_entry__ import queries
from triplake.llm import decontaminate, negatives, whitening

DATA = "/root/testdata/sf0.001"

# ---- decontamination


def plain_words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain_hits(text, items, window=10):
    """Places of hit words, and the items with occurring windows."""
    words, hit, listed = plain_words(text), set(), set()
    for item, item_text in items:
        own = plain_words(item_text)
        span = min(window, len(own))
        windows = {tuple(own[i : i + span]) for i in range(len(own) - span + 1)} if own else set()
        for i in range(len(words) - span + 1):
            if tuple(words[i : i + span]) in windows:
                hit.update(range(i, i + span))
                listed |= {str(item)} - {"None"}
    return sorted(hit), sorted(listed)


def check_hits(spark, docs, items, **options):
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, items string, d1 int")
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, words string")
    got = decontaminate.find(df, bench, **options).collect()
    window = options.get("window", 10)
    want = [(i, len(plain_words(t)), *plain_hits(t, items, window)) for i, t in docs]

    def order(row):
        return str(row)

    assert sorted([tuple(r) for r in got], key=order) == sorted(want, key=order)
    return want


def test_windows_in_documents(spark):
    rng = random.Random(5)
    few = ["a", "b", "The", "é1", "X9"]
    many = [f"w{i}" for i in range(60)]

    def text(words, n):
        return "".join(rng.choice(words) + rng.choice([" ", ", ", "-\n"]) for _ in range(n))

    items = [(i, text(many, rng.randint(1, 40))) for i in range(25)]
    items += [(30, text(few, 30)), (31, "a " * 25), (32, items[3][1]), (3, text(many, 15))]
    items += [(33, None), (34, ""), (35, "--"), (None, text(many, 12)), (40, "Zwei Wörter")]
    docs = [
        (i, text(many, 30) + (rng.choice(items)[1] or "") + text(many, 9) if i % 3 else text(few, 40))
        for i in range(60)
    ]
    # Spans one word short of a window, at either end of a text, and beyond one.
    whole = next(w for w in (plain_words(t) for _, t in items) if len(w) > 20)
    docs += [(100 + n, " ".join(whole[3 : 3 + n])) for n in (9, 10, 11)]
    docs += [(200, None), (201, ""), (202, "?!"), (203, "zwei; WÖRTER"), (203, "zwei wörter"),
             (None, " ".join(whole)), (None, " ".join(whole)), (204, "A" * 50_000),
             (205, ("a " * 3000) + " ".join(whole) + " b" * 20_000)]
    want = check_hits(spark, docs, items)
    assert any(len(w[3]) > 1 for w in want) and any(not w[2] for w in want)
    check_hits(spark, docs, items, window=6, gram=3)
    check_hits(spark, docs[:5], [(1, None)])


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert decontaminate.find(docs.limit(0), bench).count() == 0
    assert decontaminate.find(docs, bench.limit(0)).first()["hit_words"] == []
    assert decontaminate.find(docs, bench).first()["hit_words"] == [0]


def test_no_python_in_the_plan(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    bench = spark.read.parquet(f"{DATA}/benchmark.parquet")
    plan = decontaminate.find(docs, bench)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# ---- whitening


def plain_whitening(vectors, count=16):
    """Eigenvalues and vectors by the library, sums and deviations in whole numbers."""
    x = [tuple(int(np.floor(float(c) * 64)) + 1_000_000 for c in v) for v in vectors]
    fit = sorted(set(x))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    offsets = np.array([[n * c - s for c, s in zip(row, sums)] for row in fit], float) / n
    values, loads = np.linalg.eigh(offsets.T @ offsets / n)
    deviations = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x]
    own = np.array([[n * c - s for c, s in zip(row, sums)] for row in x], float) / n
    order = np.argsort(-values)[:count]
    with np.errstate(divide="ignore", invalid="ignore"):
        white = own @ loads[:, order] / np.sqrt(values[order])
    return n, deviations, white, values[order] / values.sum()


def check_whitening(rows, vectors, components):
    n, deviations, white, explained = plain_whitening(vectors)
    by_row = {}
    for r in rows:
        by_row.setdefault(r["vec_id"], {})[r["component"]] = r
    assert len(rows) == len(vectors) * components and len(by_row) == len(vectors)
    signs = [np.sign(white[:, c] @ [by_row[i][c + 1]["whitened"] for i in range(len(vectors))])
             for c in range(components)]
    for i, found in by_row.items():
        assert sorted(found) == list(range(1, components + 1))
        for c, r in found.items():
            assert (r["n"], r["deviation"]) == (n, deviations[i])
            assert r["whitened"] == pytest.approx(signs[c - 1] * white[i, c - 1], abs=1e-7)
            assert r["explained"] == pytest.approx(explained[c - 1], rel=1e-9)
            assert r["identity_error"] <= 1e-9


@pytest.mark.parametrize("spread", ["plain", "alike", "graded", "low"])
def test_spectrum_of_symmetric_matrices(spread):
    rng = np.random.default_rng(3)
    q, _ = np.linalg.qr(rng.normal(size=(40, 40)))
    values = {
        "plain": rng.random(40), "alike": np.repeat(rng.random(8), 5),
        "graded": 10.0 ** -np.arange(40), "low": np.r_[np.zeros(30), rng.random(10)],
    }[spread]
    a = q * values @ q.T
    a = (a + a.T) / 2
    found, vectors = whitening.spectrum(a)
    assert np.allclose(found, np.sort(values)[::-1], atol=1e-14)
    assert np.linalg.norm(a @ vectors - vectors * found) < 1e-13
    assert np.linalg.norm(vectors.T @ vectors - np.eye(40)) < 1e-13


def test_registered_whitening(spark):
    rows = spark.read.parquet(f"{DATA}/embeddings.parquet").orderBy("vec_id").collect()
    assert [r["vec_id"] for r in rows] == list(range(len(rows)))
    got = queries()["op13_whitening"](spark, DATA).collect()
    check_whitening(got, [r["embedding"] for r in rows], 16)


def test_whitening_of_edge_rows(spark):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(60, 5)).tolist()
    vectors += [vectors[0], vectors[0], [300.0, -300.0, 1e4, 0.0, 1.0]]
    bad = [None, [], [1.0, 2.0], [1.0, None, 0.0, 0.0, 0.0], [float("nan")] * 5,
           [float("inf"), 0.0, 0.0, 0.0, 0.0], [1e30, 0.0, 0.0, 0.0, 0.0]]
    rows = [(i, v, "x", i) for i, v in enumerate(vectors)]
    rows += [(1000 + i, v, "x", 0) for i, v in enumerate(bad)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, Whitened string, grid int")
    out = whitening.whiten(df)
    assert out.columns == ["vec_id", "grid", "whitened", "deviation", "n", "explained", "identity_error"]
    found = out.collect()
    assert all(r["vec_id"] == r["grid"] for r in found)
    each = [
        {"vec_id": r["vec_id"], "component": c + 1, "n": r["n"], "deviation": r["deviation"],
         "whitened": r["whitened"][c], "explained": r["explained"][c],
         "identity_error": r["identity_error"]}
        for r in found for c in range(5)
    ]
    check_whitening(each, vectors, 5)
    assert whitening.whiten(df.limit(0)).count() == 0
    same = whitening.whiten(spark.createDataFrame([(None, [1.0, 2.0]), (1, [1.0, 2.0])], "vec_id long, embedding array<float>"))
    assert [tuple(r)[1:] for r in same.collect()] == [([None, None], 0, 1, [None, None], 0.0)] * 2
    flat = spark.createDataFrame([(i, [float(i), 2.0, -float(i)]) for i in range(9)], "vec_id long, embedding array<float>")
    row = whitening.whiten(flat).first()
    assert row["whitened"][1:] == [None, None] and row["explained"][0] == pytest.approx(1)
    assert row["explained"][1:] == pytest.approx([0, 0], abs=1e-15)


# ---- hard negatives


def plain_negatives(rows, every, positives=5, negatives=10, scale=256):
    own = {}
    for i, label, v in rows:
        if i is None or label is None or not v or any(c is None or not np.isfinite(c) for c in v):
            continue
        x = [int(np.floor(float(c) * scale)) for c in v]
        own[i] = min(own.get(i, (label, x)), (label, x))
    out = []
    for a, (label, x) in own.items():
        if a % every:
            continue
        ranked = sorted((-sum(p * q for p, q in zip(x, y)), i, other)
                        for i, (other, y) in own.items() if i != a)
        for p, i, _ in [r for r in ranked if r[2] == label][:positives]:
            fits = [r for r in ranked if r[2] != label and 30 * -p <= 100 * -r[0] <= 90 * -p]
            out += [(a, i, k, r[1], -p, -r[0]) for k, r in enumerate(fits[:negatives], 1)]
    return sorted(out)


def test_negatives_of_anchors(spark, monkeypatch):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(6, 6)) * 3
    rows = [(i, int(rng.integers(3)), (centres[i % 6] + rng.normal(size=6) / 2).tolist()) for i in range(400)]
    rows += [(400 + i, i % 2, centres[1].tolist()) for i in range(60)]  # many ties
    rows += [(0, 0, rows[0][2]), (0, 0, rows[0][2]), (20, 2, [0.0] * 6), (21, 0, [0.0] * 6),
             (-20, 1, (-centres[0]).tolist()), (500, 1, [1000.0] * 6), (501, 2, [-900.0, 5.0, 0, 0, 0, 0])]
    rows += [(None, 1, [1.0] * 6), (600, None, [1.0] * 6), (620, 1, None), (640, 1, [1.0, None, 0, 0, 0, 0]),
             (660, 1, [float("inf")] + [0.0] * 5), (680, 1, [float("nan")] * 6), (700, 1, []), (720, 1, [1.0])]
    rows = [(i, l, None if v is None else [None if c is None else float(c) for c in v]) for i, l, v in rows]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, label int, embedding array<double>, known string, bound int")
    want = plain_negatives([r for r in rows if r[2] is None or len(r[2]) != 1], 20)
    assert len(want) > 300
    for slab, part, clusters in ((1 << 15, 1 << 12, 8), (100, 3, 4)):
        monkeypatch.setattr(negatives, "SLAB_ROWS", slab)
        monkeypatch.setattr(negatives, "PART_ANCHORS", part)
        monkeypatch.setattr(negatives, "CLUSTERS", clusters)
        assert sorted(tuple(r) for r in negatives.mine(df, every=20).collect()) == want
    assert negatives.mine(df.limit(0)).count() == 0
    assert negatives.mine(df.filter("vec_id = 1")).count() == 0


def test_walks_end_where_the_bound_certifies():
    rng = np.random.default_rng(9)
    x = np.floor(256 * np.concatenate([rng.normal(size=(500, 8)) / 9 + c for c in np.eye(8)])).astype(np.int64)
    labels, ids = np.arange(len(x)) % 2, np.arange(len(x))
    chosen = np.arange(0, 500, 50)
    centres = negatives.centres_of(x[chosen], 1)
    widths = negatives.angles(x[chosen], centres).max(axis=0)
    bound = negatives.bounds(x, centres, widths)[:, 0]
    order = np.argsort(-bound)
    goals = [(i, -negatives._MOST, negatives._MOST) for i in range(len(chosen))]
    walk, seen = negatives.Walk(x[chosen], ids[chosen], labels[chosen], goals, 5, same=True), 0
    for begin in range(0, len(order), 50):
        at = order[begin : begin + 50]
        if walk.stop(bound[at[0]]):
            break
        walk.see(x[at], ids[at], labels[at])
        seen += len(at)
    assert seen < len(x) / 2
    for g, a in enumerate(chosen):
        fits = [i for i in ids if i != a and labels[i] == labels[a]]
        best = sorted((-int(x[a] @ x[i]), int(i)) for i in fits)[:5]
        assert [(-s, i) for n, s, i in walk.best.tolist() if n == g] == best


def test_bound_holds_for_every_pair():
    rng = np.random.default_rng(10)
    x = np.concatenate([rng.normal(size=(200, 5)) * 100, np.zeros((2, 5)), np.tile(rng.normal(size=(1, 5)) * 50, (3, 1))])
    centres = negatives.centres_of(x[:40], 3)
    apart = negatives.angles(x, centres)
    cluster = np.argmin(apart, axis=1)
    widths = np.array([apart[cluster == k, k].max(initial=0) for k in range(len(centres))])
    bound = negatives.bounds(x, centres, widths)
    most = np.linalg.norm(x, axis=1)[:, None] * bound[:, cluster].T
    assert (x @ x.T <= most + 1e-6).all()
