"""The vocabulary file of a byte-level BPE tokenizer, read as plain tables."""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np

# Fixed value: how the tokenizer splits a text before merging.
SPLIT_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

#: Longer texts go to the reference library itself, whose splitter needs no stack.
LONG_TEXT = 1_000_000


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """Letter to byte: visible Latin-1 letters stand for themselves, and the
    other bytes, in order, for the letters from U+0100 on."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(visible)]
    letters = {chr(b): b for b in visible}
    letters.update({chr(256 + i): b for i, b in enumerate(hidden)})
    return letters


class Vocabulary:
    """``token_bytes[id]``, the id of each byte, and merges in order of rank."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        model, letters = stored["model"], byte_letters()
        self.special = {t["content"]: t["id"] for t in stored["added_tokens"]}
        ids = model["vocab"]
        size = 1 + max([*ids.values(), *self.special.values()])
        self.token_bytes: list[bytes] = [b""] * size
        for token, at in ids.items():
            self.token_bytes[at] = bytes(letters[c] for c in token)
        for token, at in self.special.items():
            self.token_bytes[at] = token.encode()
        self.byte_ids = np.zeros(256, np.int64)
        for letter, byte in letters.items():
            self.byte_ids[byte] = ids[letter]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([ids[a] for a, _ in merges], np.int64)
        right = np.array([ids[b] for _, b in merges], np.int64)
        self.merged = np.array([ids[a + b] for a, b in merges], np.int64)
        self.size = size
        pairs = left * size + right
        order = np.argsort(pairs, kind="stable")
        self.pairs, self.ranks = pairs[order], order
        self.ids = ids
        self.letters = letters


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=2)
def fast_encoder(path: str):
    """A compiled encoder with the ids of the tokenizer file: text to numpy ids.

    Built from the same file, so merge order and special tokens are the same;
    the tests hold it against the tokenizers library.
    """
    import tiktoken

    known = vocabulary(path)
    encoding = tiktoken.Encoding(
        "from-file",
        pat_str=SPLIT_PATTERN,
        mergeable_ranks={known.token_bytes[i]: i for i in known.ids.values()},
        special_tokens=known.special,
    )

    def encode(text: str) -> np.ndarray:
        if len(text) > LONG_TEXT:
            ids = _library(path).encode(text, add_special_tokens=False).ids
            return np.array(ids, np.uint32)
        return encoding.encode_to_numpy(text, allowed_special="all")

    return encode


@lru_cache(maxsize=2)
def _library(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer
