"""Secret scans with corpus-wide ownership frequency.

Every text is searched for credential-shaped values. Each value is hashed, and
the hashes are counted over the whole corpus by distinct repositories and
owners. A value that many owners have is a copied example; a named one that few
owners have is taken to be live, words or not, unless it is a placeholder; without
a name in front it has to look random. Live values are then also marked where they
stand bare, and such places count for their owners, too.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triplake.llm.common import per_row, stored, text_digest, unused

# Patterns of the kinds and the least length of each, in the order
# in which kinds are listed.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 12, "access": 18, "hex": 16}
KINDS = ("assign", "access", "hex", "live")

# A run shorter than the least length fails, and a failed run holds no match, so
# looking for long runs finds the same and skips the letters of ordinary words.
_LONG_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_LONG_HEX = re.compile(r"[0-9a-f]{16,}")
#: Values that may stand bare.
_BARE = re.compile(r"[A-Za-z0-9+/_=-]{12,}")
_NAME = re.compile(r"pass|secret|token|api", re.IGNORECASE | re.ASCII)

#: Owners up to which a value counts as belonging to them (a copied document may
#: bring a second one).
LIVE_OWNERS = 2
#: Share of the entropy that its length and alphabet allow that a random-looking
#: value has at least.
LIVE_SHARE = 0.68
#: Characters from which bare values are taken to be random by themselves.
LEAST_BARE = 20
#: Parts that make a value a placeholder.
PLACEHOLDERS = frozenset(
    "your my example sample dummy placeholder changeme change replace insert todo test foo bar "
    "xxx none null undefined redacted secret password passwd token".split()
)
_REFERENCE = re.compile(r"[A-Za-z_]+(?:\.[A-Za-z_]+)+")
_LETTERS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

_CANDIDATE = T.StructType(
    [
        T.StructField("kind", T.IntegerType(), False),
        T.StructField("start", T.IntegerType(), False),
        T.StructField("end", T.IntegerType(), False),
        T.StructField("value", T.LongType(), False),
        T.StructField("random", T.BooleanType(), False),
    ]
)


def _entropy(value: str) -> float:
    size = len(value)
    return -sum(n / size * math.log2(n / size) for n in Counter(value).values())


def _mixed_enough(value: str) -> bool:
    """Whether a value has the share of the entropy that its length and alphabet
    (hex, digits, letters of one case, others) allow."""
    if HEX.fullmatch(value):
        alphabet = 16
    elif value.isdigit():
        alphabet = 10
    elif value.isalnum() and (value.islower() or value.isupper()):
        alphabet = 36
    else:
        alphabet = 64
    return _entropy(value) >= LIVE_SHARE * math.log2(min(len(value), alphabet))


def looks_random(value: str) -> bool:
    """Letters and digits both, and about as mixed as its length allows."""
    if not (any(c.isdigit() for c in value) and any(c.isalpha() for c in value)):
        return False
    return _mixed_enough(value)


def is_placeholder(value: str) -> bool:
    """Values made of placeholder words, of few signs, of a short part repeated, or
    of signs that count up or down, and names of variables (``settings.key``)."""
    if _REFERENCE.fullmatch(value):
        return True
    parts = [p.lower() for p in _LETTERS.findall(value)]
    if any(p in PLACEHOLDERS or p.startswith("xxx") for p in parts):
        return True
    if len(set(value)) <= 3 or any(value == (value[:n] * len(value))[: len(value)] for n in (4, 5, 6)):
        return True
    steps = {ord(b) - ord(a) for a, b in zip(value, value[1:])}
    if value.isdigit():
        steps = {step % 10 for step in steps}
    return steps <= {0, 1} or steps <= {0, -1} or steps == {9}


def _hashed(value: str) -> int:
    number = xxhash.xxh3_64_intdigest(value.encode())
    return number - (1 << 64) if number >= 1 << 63 else number


def find(text: str | None) -> list[dict]:
    """Candidates by start, then kind. Bare values inside another span are left
    to that span."""
    if not text:
        return []
    spans = []
    if _NAME.search(text):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= LEAST["assign"]:
                spans.append((m.start(), 0, m.end(), m[2]))
    spans += [(m.start(), 1, m.end(), m[0]) for m in _LONG_ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end(), m[0]) for m in _LONG_HEX.finditer(text)]
    base = list(spans)
    for m in _BARE.finditer(text):
        if is_placeholder(m[0]):
            continue
        if not any(b < m.end() and m.start() < e for b, _, e, _ in base):
            spans.append((m.start(), 3, m.end(), m[0]))
    return [
        {"kind": k, "start": b, "end": e, "value": _hashed(v), "random": _may_be_live(k, v)}
        for b, k, e, v in sorted(spans)
    ]


def _may_be_live(kind: int, value: str) -> bool:
    """Whether a value of few owners is live. Named values and access keys are
    unless they are placeholders; a bare value that is short or of words is not by
    itself, only where the same value has a name elsewhere."""
    if kind < 2:
        return not is_placeholder(value)
    return (kind == 2 or len(value) >= LEAST_BARE) and looks_random(value)


def candidates(
    df: DataFrame, text_col: str = "text", out_col: str = "candidates"
) -> DataFrame:
    """Add the candidates of each whole text; NULL and empty texts have none."""
    field = T.StructField(out_col, T.ArrayType(_CANDIDATE, False), False)
    return per_row(df, [text_col], [field], lambda: lambda rows: [(find(t),) for (t,) in rows])


def ownership(found: DataFrame, repository: Column, owner: Column) -> DataFrame:
    """For each value: distinct repositories and owners, and what that makes it.

    ``found`` has ``candidates``. A NULL repository or owner is one of its own.
    Repetitions within a repository fall together before anything is counted, so
    a value copied a million times is a few rows by then.
    """
    return (
        found.select(
            repository.alias("repository"), owner.alias("owner"),
            F.explode("candidates").alias("c"),
        )
        .groupBy("c.value", "owner", "repository")
        .agg(F.bool_or("c.random").alias("random"))
        .groupBy("value", "owner")
        .agg(F.count(F.lit(1)).alias("repositories"), F.bool_or("random").alias("random"))
        .groupBy("value")
        .agg(
            F.sum("repositories").alias("n_repositories"),
            F.count(F.lit(1)).alias("n_owners"),
            F.bool_or("random").alias("random"),
        )
        .withColumn(
            "standing",
            F.when(F.col("n_owners") > LIVE_OWNERS, "example")
            .when(F.col("random"), "live")
            .otherwise("plain"),
        )
    )


def scan(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    repository_col: str | None = None,
    owner_col: str = "source",
) -> DataFrame:
    """Spans of each document.

    Returns id, two digests of the text, and ``spans``: structs of start, kind,
    end and standing (``live``, ``example`` or ``plain``), by start, then kind.
    Spans of kind 3 (bare values) are there only when the value is live. Without
    a repository column each document is a repository. Rows alike in id and text
    get the same spans; NULL and empty texts get none; nothing is capped.
    """
    repository = repository_col or id_col
    picked = df.select(
        F.col(id_col).alias("_id"), F.col(text_col).alias("_text"),
        F.col(repository).alias("_repository"), F.col(owner_col).alias("_owner"),
    ).withColumns(dict(zip(("_d1", "_d2"), text_digest(F.col("_text")))))
    found = candidates(picked, "_text").drop("_text")
    # Few bytes a document; both the counts and the spans are taken from it.
    found = stored(found, "secret-candidates")
    standing = stored(
        ownership(found, F.col("_repository"), F.col("_owner")).select("value", "standing"),
        "secret-standing",
    )
    ends = found.select("_id", "_d1", "_d2", "candidates")
    marked = (
        ends.filter(F.size("candidates") > 0)
        .dropDuplicates(["_id", "_d1", "_d2"])
        .select("_id", "_d1", "_d2", F.explode("candidates").alias("c"))
        .join(standing, F.col("c.value") == standing["value"])
        .filter((F.col("c.kind") < 3) | (F.col("standing") == "live"))
        .groupBy("_id", "_d1", "_d2")
        .agg(
            F.sort_array(
                F.collect_list(F.struct("c.start", "c.kind", "c.end", "standing"))
            ).alias("spans")
        )
    )
    kind = "array<struct<start:int,kind:int,end:int,standing:string>>"
    left, right = ends.drop("candidates").alias("l"), marked.alias("r")
    same = (
        F.col("l._id").eqNullSafe(F.col("r._id"))
        & (F.col("l._d1") == F.col("r._d1"))
        & (F.col("l._d2") == F.col("r._d2"))
    )
    return left.join(right, same, "left").select(
        F.col("l._id").alias(id_col), "l._d1", "l._d2",
        F.coalesce("r.spans", F.array().cast(kind)).alias("spans"),
    )


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def _masked(text: str | None, spans, mask: str) -> str | None:
    if not text or not spans:
        return text
    out, begin = [], 0
    for s in spans:
        if s["end"] <= begin:
            continue
        out += [text[begin : max(begin, s["start"])], mask]
        begin = s["end"]
    return "".join([*out, text[begin:]])


def mask_live(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str = "source",
    mask: str = "[secret]",
) -> DataFrame:
    """The documents with each live value's span replaced; examples stay.

    Every row and column stays, apart from the masked text.
    """
    live = (
        scan(df, id_col, text_col, owner_col=owner_col)
        .select(
            F.col(id_col).alias("_id"), "_d1", "_d2",
            F.filter("spans", lambda s: s["standing"] == "live").alias("_spans"),
        )
        .filter(F.size("_spans") > 0)
        .dropDuplicates(["_id", "_d1", "_d2"])
    )
    digest_1, digest_2 = text_digest(F.col(f"d.{text_col}"))
    same = (
        F.col(f"d.{id_col}").eqNullSafe(F.col("m._id"))
        & (digest_1 == F.col("m._d1"))
        & (digest_2 == F.col("m._d2"))
    )
    spans_col = unused("spans", df.columns)
    joined = df.alias("d").join(live.alias("m"), same, "left").select(
        "d.*", F.col("m._spans").alias(spans_col)
    )
    out = per_row(
        joined, [text_col, spans_col], [df.schema[text_col]],
        lambda: lambda rows: [(_masked(t, s, mask),) for t, s in rows],
        keep=[c for c in df.columns if c != text_col],
    )
    return out.select(*[F.col(f"`{c}`") for c in df.columns])
