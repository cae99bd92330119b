"""Row-wise operators against plain versions, with edge rows."""

from __future__ import annotations

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from triplake.llm import bpe, fingerprints, packing, quality, secrets, token_counts
from triplake.llm.vocabulary import default_path, fast_encoder

LIBRARY = Tokenizer.from_file(default_path())
ENCODER = bpe.TextEncoder(default_path())

TEXTS = [
    None, "", " ", "\n\n", "a", "Hello world, it's 12 o'clock.", "naïve 日本 😀​",
    "x" * 3000, "ab " * 2000, "<|endoftext|>tail<|endoftext|>", "tab\t\tand\r\nline ", "a", "a",
]


@pytest.fixture
def texts(spark):
    """Edge texts with repeated rows and columns named like results."""
    rows = [(i, t, -1, "ids") for i, t in enumerate(TEXTS)] + [(4, "a", -1, "ids")]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words int, ids string")


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_ids_are_those_of_the_library(text):
    ids = ENCODER.encode([text])[0].tolist()
    assert ids == library_ids(text)
    assert fast_encoder(default_path())(text).tolist() == ids
    assert ENCODER.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abe ", min_size=100, max_size=400).map(lambda t: t.replace(" ", "")))
def test_long_words_have_a_tree_of_their_own(word):
    assert ENCODER.trees.encode_words([word.encode()])[0] == (
        np.array(library_ids(word), "<i4").tobytes()
    )


def test_forgotten_words_are_encoded_again(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED_WORDS", 5)
    encoder = bpe.TextEncoder(default_path())
    for text in ("one two three four", "two five six seven", "one eight nine two", "two"):
        assert encoder.encode([text])[0].tolist() == library_ids(text)


def test_encode_and_decode_frames(spark, texts):
    coded = bpe.encode(texts)
    assert coded.columns == ["doc_id", "text", "n_words", "ids"]
    back = bpe.decode(coded.drop("text")).collect()
    assert len(back) == len(TEXTS) + 1
    for row in back:
        assert row["ids"] == library_ids(TEXTS[row["doc_id"]])
        assert row["text"] == (TEXTS[row["doc_id"]] or "")
    assert bpe.round_trip(texts.limit(0)).count() == 0


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often, covered = collections.Counter(windows), set()
    for i, window in enumerate(windows):
        if often[window] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(covered),
    )


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab#\n \t é", max_size=120))
def test_counts(text):
    assert quality.count_text(text)[:5] == plain_counts(text)


def test_rules_reject_what_labels_call_bad(spark):
    good = "The quick brown fox jumps over the lazy dog and then goes home to its den number {} again."
    bad = "SHOUT!! LOUD!! AND!! NEVER!! STOP!! TO!! BUY!! NOW!! {} !! YES!! OR!! NO!! SO!! IT!! IS!! FOR!! YOU!! AND!! ME!! ALL!! DAY!!"
    rows = [(i, (bad if i % 4 == 0 else good + " One more sentence is here for {} too.").format(i, i)) for i in range(400)]
    docs = spark.createDataFrame([*rows, (None, None), (1000, ""), (0, rows[0][1])], "doc_id long, text string")
    labels = spark.createDataFrame(
        [(i, int(i % 4 != 0)) for i in range(300)] + [(0, 1), (None, 0), (5, None)],
        "doc_id long, quality int",
    )
    rules = quality.fit(docs, labels)
    assert rules.rules
    judged = quality.judge(docs, rules)
    for row in judged.collect():
        if row["doc_id"] is None or row["doc_id"] == 1000:
            assert row["base_failed"] and not row["kept"]
        else:
            assert row["kept"] == (row["doc_id"] % 4 != 0)
    kept = quality.keep_good(docs.withColumn("quality_n_words", F.lit("x")), rules)
    assert kept.columns == ["doc_id", "text", "quality_n_words"] and kept.count() == 300
    assert not quality.fit(docs, labels.limit(0)).rules
    assert quality.judge(docs.limit(0), rules).count() == 0


def plain_base(text):
    spans = []
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for m in re.finditer(assign, text, re.I | re.A):
        if len(m[2]) >= 12:
            spans.append((m.start(), 0, m.end()))
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(spans)


PIECES = ["password=", "Token : '", "api_key", "AKIA", "AKIA9X", "deadbeef01", "=", " ", "é", "hunter2hunter2", "ZZ99"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14).map("".join))
def test_base_spans(text):
    found = [(c["start"], c["kind"], c["end"]) for c in secrets.find(text) if c["kind"] < 3]
    assert found == plain_base(text)


def test_ownership_separates_examples_from_live_values(spark):
    live, example = "q8ZkP2mX7vR4tY6wB1nC", "Ex4mpleEx9mpleK3yQ7zTT"
    rows = [(1, f"token = '{live}' and {live}", "a"), (2, f"bare {live} there", "a"), (3, None, "a"),
            (4, "", None), (4, "", None)]
    rows += [(10 + i, f"secret: {example} {example}", f"o{i}") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {
        r["doc_id"]: [(secrets.KINDS[s["kind"]], s["standing"]) for s in r["spans"]]
        for r in secrets.scan(docs).collect()
    }
    assert found[1] == [("assign", "live"), ("live", "live")]
    assert found[2] == [("live", "live")]
    assert found[3] == found[4] == []
    assert found[10] == [("assign", "example")]
    masked = {r["doc_id"]: r["text"] for r in secrets.mask_live(docs).collect()}
    assert masked[2] == "bare [secret] there" and masked[3] is None
    assert live not in masked[1] and example in masked[10]
    assert secrets.mask_live(docs).count() == len(rows)
    assert secrets.scan(docs.limit(0)).count() == 0


def test_short_random_values_look_random():
    rng = np.random.default_rng(3)
    base62 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    for alphabet, size in [("0123456789abcdef", 12), ("0123456789abcdef", 16), (base62, 12), (base62, 16)]:
        values = ["".join(rng.choice(list(alphabet), size)) for _ in range(2000)]
        values = [v for v in values if any(c.isdigit() for c in v) and any(c.isalpha() for c in v)]
        assert np.mean([secrets.looks_random(v) for v in values]) > 0.98


def test_named_values_are_live_unless_placeholders(spark):
    live = ["qzxkvwpjtrmb", "GXkqTZwvLpRd", "837261940572", "a1b9c3f04e77", "hunter2hunter2",
            "correcthorsebattery", "TigerLilyRose", "SummerHolidays", "letmeinplease"]
    plain = ["your_token_here", "changeme1234", "aaaaaaaaaaaa", "123456789012", "configuration.value",
             "xxxxxxxxxxxx", "abcdabcdabcd", "ponmlkjihgfe"]
    rows = [(i, f"password = {v}", f"o{i}") for i, v in enumerate(live + plain)] + [(99, f"bare {live[0]} here", "o0")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: [s["standing"] for s in r["spans"] if s["kind"] in (0, 3)] for r in secrets.scan(docs).collect()}
    assert got == {**{i: ["live" if i < len(live) else "plain"] for i in range(len(rows) - 1)}, 99: ["live"]}


@pytest.mark.parametrize("seed", [1, 2])
def test_ownership_of_random_corpora(spark, seed):
    """Values of few and of many owners, named or bare, against plain counting."""
    rng = np.random.default_rng(seed)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    values = ["".join(rng.choice(letters, 14)) for _ in range(12)]
    values += ["".join(rng.choice(list("0123456789abcdef"), 24)) for _ in range(6)]
    docs, holders, named = [], collections.defaultdict(set), set()
    for i in range(120):
        owner = None if i % 17 == 0 else f"o{int(rng.integers(6)) if i % 2 else i % 3}"
        parts = []
        for v in rng.choice(len(values), int(rng.integers(0, 4)), replace=False):
            name = rng.random() < 0.3 and v % 3 > 0
            if v % 4 == 0 and owner not in ("o0", "o1"):
                continue  # values of two owners
            parts.append(("password: " if name else "") + values[v])
            holders[v].add(owner)
            named |= {v} if name else set()
        docs.append((i, " some words ".join(parts), owner, "x"))
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, spans string")
    got = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in secrets.scan(df).collect()}
    seen = collections.Counter()
    for i, text, _, _ in docs:
        want = []
        for v, value in enumerate(values):
            at = text.find(value)
            if at < 0:
                continue
            before = at - len("password: ")
            is_named = before >= 0 and text[before:at] == "password: "
            random_looking = len(value) == 24
            standing = "example" if len(holders[v]) > 2 else "live" if v in named or random_looking else "plain"
            seen[standing] += 1
            if is_named:
                want.append((before, 0, at + len(value), standing))
            if random_looking:
                want.append((at, 2, at + len(value), standing))
            elif not is_named and standing == "live":
                want.append((at, 3, at + len(value), standing))
        assert got[i] == sorted(want)
    assert min(seen["example"], seen["live"]) > 3


@pytest.mark.parametrize("range_rows", [20_000, 5])
def test_fingerprints_of_edited_texts(spark, range_rows, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", range_rows)
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(500)]
    rows = [(i * 7 % 60, " ".join(rng.choice(words, int(rng.integers(1, 300))))) for i in range(60)]
    rows += [(70, None), (71, ""), (71, ""), (None, "no id"), (3, "tie of three")]
    # Many rows without id, and of one id, some of them alike.
    rows += [(None, f"{rng.choice(words)} {i % 25}") for i in range(40)]
    rows += [(33, f"{rng.choice(words)} {i % 25}") for i in range(40)] + [(33, "é same")] * 3
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, place int, id string")
    if range_rows == 5:
        placed, places = fingerprints._in_places(docs.selectExpr("doc_id as id", "text"), 8)
        most = max(r["count"] for r in placed.groupBy("place").count().collect())
        assert len(places) > 20 and most <= 20
    got = collections.Counter(
        (r["doc_id"], r["n_chars"], r["edited_text"]) for r in fingerprints.compare_edited(docs).collect()
    )
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or ""))
    want = collections.Counter()
    for i, (doc_id, text) in enumerate(ordered):
        text, after = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        quarter = len(text) // 4
        want[doc_id, len(text), text[: len(text) - quarter] + after[:quarter]] += 1
    assert got == want
    for row in fingerprints.compare_edited(docs).collect():
        # Three quarters stay, and the cut spoils one chunk at most.
        assert row["near_edited"] >= 0.74 - fingerprints.MAX_CHUNK / max(1, row["n_chars"])
    assert fingerprints.compare_edited(docs.limit(0)).count() == 0
    assert fingerprints.compare_edited(docs.limit(1)).count() == 1


def test_chunks_move_with_their_text():
    rng = np.random.default_rng(1)
    text = " ".join("".join(rng.choice(list("abcdefghij"), 5)) for _ in range(400))
    own = fingerprints.chunks(text)
    shifted = fingerprints.chunks("some words put in front of it " + text)
    assert fingerprints.containment(own, shifted) > 0.9
    assert fingerprints.containment(own, fingerprints.chunks(text.upper())) == 1.0
    ends = fingerprints.chunk_ends(text.encode())
    assert ends == sorted(set(ends)) and ends[-1] == len(text)


def test_length_histogram(spark, texts):
    table = token_counts.histogram(texts)
    sizes = [len(library_ids(t)) for t in TEXTS] + [1]
    for row in table.collect():
        limit = row["n_tokens"]
        assert row["n_docs"] == sizes.count(limit)
        assert row["truncated_tokens"] == sum(min(s, limit) for s in sizes)
        assert row["tokens_over"] == sum(s for s in sizes if s > limit)
    for limit in (3, 10, 5000):
        got = token_counts.at_limit(table, limit).first()
        assert got["truncated_tokens"] == sum(min(s, limit) for s in sizes)
    assert token_counts.quantile(table, 0.5).first()[0] == sorted(sizes)[(len(sizes) - 1) // 2]
    assert token_counts.histogram(texts.limit(0)).count() == 0


def test_limits_below_the_shortest_document(spark):
    docs = spark.createDataFrame([("Hello world, it's 12 o'clock.",), ("ab " * 40,)], "text string")
    sizes = [len(library_ids(t)) for (t,) in docs.collect()]
    got = token_counts.at_limit(token_counts.histogram(docs), 2).first()
    assert tuple(got) == (2, 2, 4, sum(sizes) - 4) and min(sizes) > 2


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=8))
def test_bound_and_best_fit(lengths):
    lengths = np.array(lengths, np.int64)
    bins, offsets, free = packing.best_fit(lengths, 20)
    counts = np.bincount(lengths, minlength=21)

    def fewest(left, rooms):
        if not left:
            return len(rooms)
        size, rest = left[0], left[1:]
        best = fewest(rest, [*rooms, 20 - size])
        for i, room in enumerate(rooms):
            if room >= size:
                best = min(best, fewest(rest, [*rooms[:i], room - size, *rooms[i + 1 :]]))
        return best

    exact = fewest(sorted(lengths.tolist(), reverse=True), [])
    assert packing.lower_bound(counts, 20) <= exact <= len(free)
    for b in range(len(free)):
        at = 0
        for i in sorted(np.flatnonzero(bins == b), key=lambda i: offsets[i]):
            assert offsets[i] == at
            at += lengths[i]
        assert at == 20 - free[b]


@pytest.mark.parametrize("size", [1, 5, 6, 7, 12, 13])
def test_cut(size):
    spans = packing.cut(size, 6)
    assert [e - b for b, e in spans][1:] == [6] * (len(spans) - 1)
    assert spans[0][0] == 0 and spans[-1][1] == size and len(spans) == -(-size // 6)


@pytest.mark.parametrize("partition_pieces", [7, 1000])
def test_every_piece_has_its_place(spark, texts, partition_pieces):
    packed = packing.pack(texts, capacity=64, partition_pieces=partition_pieces).collect()
    by_row = collections.defaultdict(list)
    for row in packed:
        by_row[row["doc_id"]].append(row)
    for doc_id, text in enumerate(TEXTS):
        ids = np.array(library_ids(text) + [0], "<u4")
        copies = 2 if doc_id == 4 else 1
        spans = packing.cut(len(ids), 64)
        want = sorted(
            (n, b, e - b, zlib.crc32(ids[b:e].tobytes())) for n, (b, e) in enumerate(spans)
        ) * copies
        got = sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in by_row[doc_id])
        assert got == sorted(want)
    places = collections.defaultdict(list)
    for row in packed:
        places[row["sequence_id"]].append((row["offset"], row["length"]))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 64
    if partition_pieces == 1000:
        assert len(places) <= -(-sum(r["length"] for r in packed) // 64) + 1
    assert packing.pack(texts.limit(0)).count() == 0


def test_repeated_rows_are_spread_over_partitions(spark):
    docs = spark.createDataFrame([(None, None)] * 640, "doc_id long, text string")
    packed = packing.pack(docs, capacity=64, partition_pieces=64)
    assert packed.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    rows = packed.collect()
    parts = collections.Counter(r["sequence_id"] >> 24 for r in rows)
    assert len(rows) == 640 and max(parts.values()) < 3 * 64
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == 640


def test_digest_columns(spark, texts):
    row = bpe.encode(texts).filter("doc_id = 5").select(
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256)
    ).first()
    ids = ",".join(map(str, library_ids(TEXTS[5])))
    assert row[0] == hashlib.sha256(ids.encode()).hexdigest()
