"""Byte-pair encoding and decoding with a segment tree over pair ranks.

A word is a row of symbols. The leaves of its segment tree hold the merge rank
of each adjacent pair, every node the smallest value below it, so the root names
the lowest rank and, among equals, the leftmost pair. A merge changes three
leaves; their paths to the root are recomputed, which takes logarithmic time.

Words are met again and again, so each task encodes the words of a few hundred
documents at once, the new ones together: trees of equal size lie side by side
in one array and advance in step.
"""

from __future__ import annotations

from collections.abc import Iterable
from itertools import chain

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from triplake.llm.common import other_columns, per_row
from triplake.llm.vocabulary import SPLIT_PATTERN, Vocabulary, default_path, vocabulary

#: New words a worker remembers before those it did not meet again are forgotten.
REMEMBERED_WORDS = 250_000
#: Symbols up to which words share an array; longer ones get a tree of their own.
SHARED_TREE = 128
_NONE = np.int64(1) << 60


class SegmentTreeEncoder:
    """Ids of words, given as UTF-8."""

    def __init__(self, known: Vocabulary):
        self.known = known
        self.byte_ids = known.byte_ids.tolist()
        self.pair_rank = dict(zip(known.pairs.tolist(), known.ranks.tolist()))

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each pair, or a large number."""
        pairs = left * self.known.size + right
        at = np.searchsorted(self.known.pairs, pairs)
        at[at == len(self.known.pairs)] = 0
        return np.where(self.known.pairs[at] == pairs, self.known.ranks[at], _NONE)

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, packed as little-endian 32-bit numbers."""
        found = [b""] * len(words)
        by_leaves: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            if len(word) == 1:
                found[i] = _packed([self.byte_ids[word[0]]])
            elif len(word) > SHARED_TREE:
                found[i] = _packed(self.encode_long(word))
            elif word:
                by_leaves.setdefault(1 << (len(word) - 2).bit_length(), []).append(i)
        for leaves, members in by_leaves.items():
            step = max(1, (1 << 18) // leaves)
            for begin in range(0, len(members), step):
                part = members[begin : begin + step]
                for i, ids in zip(part, self._in_step([words[i] for i in part], leaves)):
                    found[i] = ids
        return found

    def _in_step(self, words: list[bytes], leaves: int) -> list[bytes]:
        """Encode words of 2 to leaves + 1 bytes, one merge of each at a time."""
        count, width = len(words), leaves + 2  # the last place holds no symbol
        end, shift = width - 1, leaves.bit_length() - 1
        lengths = np.fromiter(map(len, words), np.int64, count)
        place = np.arange(width)
        alive = place < lengths[:, None]
        symbols = np.zeros((count, width), np.int64)
        symbols[alive] = self.known.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        after = np.broadcast_to(place + 1, (count, width)).copy()
        after[np.arange(count), lengths - 1] = after[:, end] = end
        before = np.broadcast_to(place - 1, (count, width)).copy()
        before[:, 0] = end
        # A leaf holds rank * leaves + place, so the smallest is also the leftmost.
        tree = np.full((count, 2 * leaves), _NONE, np.int64)
        row, at = np.nonzero(place[1 : leaves + 1] < lengths[:, None])
        value = self.ranks(symbols[row, at], symbols[row, at + 1])
        tree[row, leaves + at] = np.where(value < _NONE, value * leaves + at, _NONE)
        half = leaves
        while half > 1:
            np.minimum(
                tree[:, half : 2 * half : 2], tree[:, half + 1 : 2 * half : 2],
                out=tree[:, half // 2 : half],
            )
            half //= 2
        flat, row = tree.ravel(), np.arange(count)
        while True:
            root = tree[row, 1]
            go = root < _NONE
            row, root = row[go], root[go]
            if not len(row):
                break
            at = root & (leaves - 1)
            right = after[row, at]
            beyond, ahead = after[row, right], before[row, at]
            symbols[row, at] = self.known.merged[root >> shift]
            after[row, at] = beyond
            before[row, beyond] = at
            alive[row, right] = False
            # The pairs of the new symbol replace those of the two old ones.
            left_of = np.concatenate([at, ahead])
            rows2 = np.concatenate([row, row])
            rank = self.ranks(symbols[rows2, left_of], symbols[rows2, after[rows2, left_of]])
            there = (rank < _NONE) & (np.concatenate([beyond, ahead]) < end)
            value = np.where(there, rank * leaves + left_of, _NONE)
            # A symbol in the last places starts no pair and has no leaf.
            node = np.concatenate([left_of, right])
            value = np.concatenate([value, np.full(len(row), _NONE)])
            base = np.concatenate([rows2, row]) * (2 * leaves)
            leaf = node < leaves
            node, value, base = node[leaf] + leaves, value[leaf], base[leaf]
            flat[base + node] = value
            for _ in range(shift):
                pair = base + (node & ~1)
                node >>= 1
                flat[base + node] = np.minimum(flat[pair], flat[pair + 1])
        ids = symbols[alive].astype("<i4").tobytes()
        ends = (4 * np.cumsum(alive.sum(1))).tolist()
        return [ids[b:e] for b, e in zip([0, *ends], ends)]

    def encode_long(self, word: bytes) -> list[int]:
        """The same tree for one word of any length, as plain lists."""
        size, ranks, merged = self.known.size, self.pair_rank, self.known.merged
        symbols = [self.byte_ids[b] for b in word]
        count = len(symbols)
        leaves = 1 << max(0, (count - 2).bit_length())
        none = int(_NONE)
        tree = [none] * (2 * leaves)
        for i in range(count - 1):
            rank = ranks.get(symbols[i] * size + symbols[i + 1])
            if rank is not None:
                tree[leaves + i] = rank * leaves + i
        for node in range(leaves - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        after, before = list(range(1, count + 1)), list(range(-1, count - 1))

        def put(leaf: int) -> None:
            right, value = after[leaf], none
            if symbols[leaf] >= 0 and right < count:
                rank = ranks.get(symbols[leaf] * size + symbols[right])
                if rank is not None:
                    value = rank * leaves + leaf
            node = leaf + leaves
            tree[node] = value
            while node > 1:
                node >>= 1
                smallest = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == smallest:
                    break
                tree[node] = smallest

        while tree[1] < none:
            rank, at = divmod(tree[1], leaves)
            right = after[at]
            symbols[at], symbols[right] = int(merged[rank]), -1
            after[at] = after[right]
            if after[right] < count:
                before[after[right]] = at
            if right < leaves:
                put(right)
            put(at)
            if before[at] >= 0:
                put(before[at])
        return [s for s in symbols if s >= 0]


class TextEncoder:
    """Ids of texts: special tokens, then words, then merges within words."""

    def __init__(self, path: str):
        self.known = vocabulary(path)
        self.trees = SegmentTreeEncoder(self.known)
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.find = regex.compile(SPLIT_PATTERN).findall
        special = sorted(self.known.special, key=len, reverse=True)
        self.special = (
            regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        )

    def _words(self, text: str) -> list[str]:
        if not any(s in text for s in self.known.special):
            return self.find(text)
        words: list[str] = []
        for part in self.special.split(text):
            words += [part] if part in self.known.special else self.find(part)
        return words

    def encode(self, texts: Iterable[str]) -> list[np.ndarray]:
        """Texts of one batch; their new words are encoded together."""
        split = [self._words(text) for text in texts]
        new = set(chain.from_iterable(split))
        if len(self.words) + len(new) > REMEMBERED_WORDS:
            self.words, self.older = {}, self.words
        new = new.difference(self.words, self.known.special)
        again = new & self.older.keys()
        self.words.update((w, self.older[w]) for w in again)
        new = list(new - again)
        self.words.update(zip(new, self.trees.encode_words([w.encode() for w in new])))
        self.words.update((w, _packed([at])) for w, at in self.known.special.items())
        look = self.words.__getitem__
        return [np.frombuffer(b"".join(map(look, words)), "<i4") for words in split]

    def decode(self, ids: Iterable[int]) -> str:
        """Bytes of the tokens, read as UTF-8; what is not UTF-8 becomes U+FFFD."""
        ids = ids.tolist() if isinstance(ids, np.ndarray) else ids
        return b"".join(map(self.known.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, "<i4").tobytes()


def encode(
    df: DataFrame, text_col: str = "text", ids_col: str = "ids", path: str | None = None
) -> DataFrame:
    """Add the token ids of each whole text.

    NULL and empty texts have no ids. Other columns stay; an input column named
    like the result is replaced. Repeated rows and empty tables need no care,
    since each row stands alone.
    """
    path = path or default_path()

    def start():
        encoder = TextEncoder(path)
        return lambda rows: [(ids,) for ids in encoder.encode(t or "" for (t,) in rows)]

    field = T.StructField(ids_col, T.ArrayType(T.IntegerType(), False), False)
    return per_row(df, [text_col], [field], start)


def decode(
    df: DataFrame, ids_col: str = "ids", text_col: str = "text", path: str | None = None
) -> DataFrame:
    """Add the text of token ids; NULL gives NULL. An unknown id is an error."""
    path = path or default_path()

    def start():
        encoder = TextEncoder(path)
        return lambda rows: [(None if i is None else encoder.decode(i),) for (i,) in rows]

    return per_row(df, [ids_col], [T.StructField(text_col, T.StringType())], start)


def round_trip(
    df: DataFrame,
    text_col: str = "text",
    ids_col: str = "ids",
    decoded_col: str = "decoded",
    path: str | None = None,
) -> DataFrame:
    """Encode and decode in one pass; drops the input text, keeps other columns."""
    path = path or default_path()

    def start():
        encoder = TextEncoder(path)
        return lambda rows: [
            (ids, encoder.decode(ids)) for ids in encoder.encode(t or "" for (t,) in rows)
        ]

    fields = [
        T.StructField(ids_col, T.ArrayType(T.IntegerType(), False), False),
        T.StructField(decoded_col, T.StringType(), False),
    ]
    keep = other_columns(df, [text_col, ids_col, decoded_col])
    return per_row(df, [text_col], fields, start, keep)
