"""Byte-level BPE vocabulary read from a public tokenizer file.

The path is a parameter; executors read the file where it is installed.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_chars() -> dict[str, int]:
    """Printable stand-in character of every byte in such vocabulary files:
    printable Latin-1 bytes stand for themselves, the rest count up from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocab:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            d = json.load(f)
        chars = _byte_chars()
        to_bytes = lambda s: bytes(chars[c] for c in s)
        self.id_of = {to_bytes(t): i for t, i in d["model"]["vocab"].items()}
        special = [t for t in d["added_tokens"] if t["content"]]
        self.special = special[0]["content"].encode() if special else None
        self.special_id = special[0]["id"] if special else -1
        size = max([*self.id_of.values(), self.special_id]) + 1
        self.size = size
        self.bytes_of = [b""] * size
        for b, i in self.id_of.items():
            self.bytes_of[i] = b
        if self.special:
            self.bytes_of[self.special_id] = self.special
        self.byte_id = np.array([self.id_of[bytes([b])] for b in range(256)], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in d["model"]["merges"]]
        left = np.array([self.id_of[to_bytes(a)] for a, _ in pairs], np.int64)
        right = np.array([self.id_of[to_bytes(b)] for _, b in pairs], np.int64)
        into = np.array([self.id_of[to_bytes(a + b)] for a, b in pairs], np.int64)
        keys = left * size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.into = keys[order], order.astype(np.int64), into[order]
        self.byte_id_list = self.byte_id.tolist()
        self.rank_of = {p: i for i, p in enumerate(zip(left.tolist(), right.tolist()))}
        self.into_of = into.tolist()
        self.token_len = np.array([len(b) for b in self.bytes_of], np.int64)
        self.token_at = np.cumsum(self.token_len) - self.token_len
        self.token_bytes = np.frombuffer(b"".join(self.bytes_of), np.uint8)


@lru_cache(maxsize=2)
def load(path: str) -> Vocab:
    """The vocabulary, read once per Python worker."""
    return Vocab(path)
