"""Quality rules: a decision list learned from labelled documents.

Counts are taken from each whole text. Rules are conjunctions of thresholds on
ratios of these counts. Sequential covering learns them: a rule is grown on two
thirds of the labelled rows until it covers no good document, pruned on the
other third, and the rows that it covers are set aside before the next one. The
list becomes one ordered CASE expression.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triplake.llm.common import per_row

#: Labelled rows that rules are fitted on at most, chosen by a hash of the id.
SAMPLE_ROWS = 20_000
#: Share of rejected rows that a rule must have among those it covers.
MIN_PRECISION = 0.97
#: Rejected rows that a rule must cover when pruned rows are counted too.
MIN_COVERED = 5
MAX_CONDITIONS = 4
MAX_RULES = 24
#: Thresholds tried for each ratio are this many quantiles of the rows left.
THRESHOLDS = 64
_WINDOW = 8

# White space between words, and the characters called symbols.
SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_DIGITS = bytes(range(ord("0"), ord("9") + 1))

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_distinct_words", "n_upper", "n_digits", "n_bangs",
)


def count_text(text: str | None) -> tuple[int, ...]:
    """The counts of one text, in the order of COUNTS; NULL counts as empty."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at exactly the six ASCII spaces
    lines = [line for line in raw.split(b"\n") if line.strip(SPACES)]

    def among(letters: bytes) -> int:
        return len(raw) - len(raw.translate(None, letters))

    numbers: dict[bytes, int] = {}
    numbered = [numbers.setdefault(w, len(numbers)) for w in words]
    return (
        len(words), len(text) - among(SPACES), among(SYMBOLS), len(lines) - len(set(lines)),
        _repeated_words(numbered, len(numbers)), len(lines), len(numbers), among(_UPPER),
        among(_DIGITS), raw.count(b"!"),
    )


def _repeated_words(numbered: list[int], distinct: int) -> int:
    """Words within windows of eight that the text has more than once.

    Windows of 2, 4 and 8 words are numbered from those of half the length, so
    equal numbers mean equal words.
    """
    count = len(numbered) - _WINDOW + 1
    if count < 2 or distinct == len(numbered):
        return 0
    name = np.array(numbered, np.int64)
    width = 1
    while width < _WINDOW:
        pair = name[:-width] * (int(name.max()) + 1) + name[width:]
        _, name, times = np.unique(pair, return_inverse=True, return_counts=True)
        width *= 2
        if width < _WINDOW and times.max() == 1:
            return 0
    repeated = np.flatnonzero(times[name] > 1)
    change = np.zeros(len(numbered) + 1, np.int64)
    np.add.at(change, repeated, 1)
    np.add.at(change, repeated + _WINDOW, -1)
    return int(np.count_nonzero(np.cumsum(change)))


def with_counts(df: DataFrame, text_col: str = "text", prefix: str = "") -> DataFrame:
    """Add the counts; columns of the same names are replaced, others stay."""
    fields = [T.StructField(prefix + c, T.LongType(), False) for c in COUNTS]
    return per_row(df, [text_col], fields, lambda: lambda rows: [count_text(t) for (t,) in rows])


def base_failed(prefix: str = "") -> Column:
    """Fewer than 20 words, or over 30 % of them in repeated windows."""
    words, repeated = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return (words < 20) | (100 * repeated > 30 * words)


# Ratio: numerator, denominator. A zero denominator gives 0.
RATIOS = {
    "words": ("n_words", None),
    "symbols_per_word": ("n_symbols", "n_words"),
    "bangs_per_word": ("n_bangs", "n_words"),
    "chars_per_word": ("word_chars", "n_words"),
    "distinct_share": ("n_distinct_words", "n_words"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "duplicate_line_share": ("n_dup_lines", "n_lines"),
    "upper_share": ("n_upper", "word_chars"),
    "digit_share": ("n_digits", "word_chars"),
}


def ratio(name: str, prefix: str = "") -> Column:
    top, below = RATIOS[name]
    top_col = F.col(prefix + top).cast("double")
    if below is None:
        return top_col
    below_col = F.col(prefix + below)
    return F.when(below_col > 0, top_col / below_col).otherwise(F.lit(0.0))


@dataclass
class Condition:
    ratio: str
    at_least: bool
    threshold: float

    def holds(self, columns: dict[str, np.ndarray]) -> np.ndarray:
        values = columns[self.ratio]
        return values >= self.threshold if self.at_least else values <= self.threshold

    def column(self, prefix: str) -> Column:
        value = ratio(self.ratio, prefix)
        return value >= self.threshold if self.at_least else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.ratio} {'>=' if self.at_least else '<='} {self.threshold:g}"


@dataclass
class DecisionList:
    """Rules in order; a document that none of them matches is kept."""

    rules: list[list[Condition]] = field(default_factory=list)

    def rejects(self, columns: dict[str, np.ndarray]) -> np.ndarray:
        out = np.zeros(len(next(iter(columns.values()))), bool)
        for rule in self.rules:
            out |= covered_by(rule, columns)
        return out

    def first_match(self, prefix: str = "") -> Column:
        """Number of the first rule that matches, from 1; NULL if none does."""
        out = None
        for number, rule in enumerate(self.rules, 1):
            test = rule[0].column(prefix)
            for condition in rule[1:]:
                test = test & condition.column(prefix)
            out = F.when(test, number) if out is None else out.when(test, number)
        return F.lit(None).cast("int") if out is None else out

    def __str__(self) -> str:
        return "\n".join(" and ".join(map(str, r)) for r in self.rules)


def covered_by(rule: list[Condition], columns: dict[str, np.ndarray]) -> np.ndarray:
    out = np.ones(len(next(iter(columns.values()))), bool)
    for condition in rule:
        out &= condition.holds(columns)
    return out


def learn(columns: dict[str, np.ndarray], rejected: np.ndarray) -> DecisionList:
    """Sequential covering of the rejected rows. Rows come in hash order, so
    every third one serves for pruning."""
    pruning = np.arange(len(rejected)) % 3 == 2
    left = np.ones(len(rejected), bool)
    found = DecisionList()
    while len(found.rules) < MAX_RULES:
        rule = _grow(columns, rejected, left & ~pruning)
        rule = _prune(rule, columns, rejected, left & pruning)
        if not rule:
            break
        hit = covered_by(rule, columns) & left
        bad = int(np.count_nonzero(hit & rejected))
        if bad < MIN_COVERED or bad < MIN_PRECISION * np.count_nonzero(hit):
            break
        found.rules.append(rule)
        left &= ~hit
    return found


def _grow(columns: dict[str, np.ndarray], rejected: np.ndarray, rows: np.ndarray):
    rule: list[Condition] = []
    hit = rows.copy()
    while len(rule) < MAX_CONDITIONS:
        bad, good = np.count_nonzero(hit & rejected), np.count_nonzero(hit & ~rejected)
        if not bad or not good:
            break
        now, best, best_gain = np.log2(bad / (bad + good)), None, 0.0
        for name, values in columns.items():
            tried = np.unique(np.quantile(values[hit], np.linspace(0, 1, THRESHOLDS)))
            for threshold in tried:
                for at_least in (True, False):
                    rounded = float(f"{threshold:.5g}")
                    condition = Condition(name, at_least, rounded)
                    then = hit & condition.holds(columns)
                    b = np.count_nonzero(then & rejected)
                    if not b:
                        continue
                    g = np.count_nonzero(then) - b
                    gain = b * (np.log2(b / (b + g)) - now)
                    if gain > best_gain + 1e-9:
                        best, best_gain = condition, gain
        if best is None:
            break
        rule.append(best)
        hit &= best.holds(columns)
    return rule


def _prune(rule, columns, rejected, rows):
    """Drop final conditions while that does not lower (bad - good) / covered."""
    best, best_worth = [], -2.0
    for length in range(1, len(rule) + 1):
        hit = covered_by(rule[:length], columns) & rows
        bad, all_hit = np.count_nonzero(hit & rejected), np.count_nonzero(hit)
        worth = (2 * bad - all_hit) / all_hit if all_hit else -1.0
        if worth > best_worth:
            best, best_worth = rule[:length], worth
    return best


def fit(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> DecisionList:
    """Learn from documents labelled 0 (bad) or 1 (good).

    A document labelled more than once is bad if any label says so; NULL labels
    and ids do not count. At most ``sample_rows`` labelled ids, the first in the
    order of a hash, are used; they and their counts are what the driver holds.
    Without both kinds of labels there are no rules.
    """
    known = (
        labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.min(label_col).alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(sample_rows)
    )
    # Bounded by sample_rows, so a broadcast is safe at any size of the corpus.
    chosen = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(
        F.broadcast(known), "_id"
    )
    rows = (
        with_counts(chosen, "_text")
        .select("_id", "_label", *[ratio(n).alias(n) for n in RATIOS])
        .groupBy("_id")
        .agg(*[F.first(n).alias(n) for n in ["_label", *RATIOS]])
        .orderBy(F.xxhash64("_id"), "_id")
        .toPandas()
    )
    if rows.empty:
        return DecisionList()
    columns = {n: rows[n].to_numpy(float) for n in RATIOS}
    return learn(columns, rows["_label"].to_numpy() == 0)


def judge(
    df: DataFrame, rules: DecisionList, text_col: str = "text", prefix: str = ""
) -> DataFrame:
    """Add counts, ``base_failed``, ``rule`` (first that matches) and ``kept``.

    NULL and empty texts have no words and fail the base rule. Repeated rows are
    judged alike. Input columns of these names are replaced.
    """
    out = with_counts(df, text_col, prefix)
    return out.withColumns(
        {
            f"{prefix}base_failed": base_failed(prefix),
            f"{prefix}rule": rules.first_match(prefix),
            f"{prefix}kept": ~base_failed(prefix) & rules.first_match(prefix).isNull(),
        }
    )


def keep_good(df: DataFrame, rules: DecisionList, text_col: str = "text") -> DataFrame:
    """Documents that pass, with the columns they came with."""
    prefix = "quality_"
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix += "_"
    judged = judge(df, rules, text_col, prefix)
    return judged.filter(F.col(f"{prefix}kept")).select(*[F.col(f"`{c}`") for c in df.columns])
