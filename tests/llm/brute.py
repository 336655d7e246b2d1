"""Brute-force versions of the operators, for small tables."""

from __future__ import annotations

import collections
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import tiktoken

from graustein.llm.bpe import read_ranks

ENCODING = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                             mergeable_ranks=read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))

BASE = {  # the contract's patterns, as they stand there
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def sha(data) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def token_bytes(text: str | None) -> bytes:
    return np.array(ENCODING.encode_ordinary(text or ""), "<u4").tobytes()


def crc(text: str | None) -> int:
    return zlib.crc32(token_bytes(text) + bytes(4))


def luhn(number: str) -> bool:
    values = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(number))]
    return sum(v - 9 if v > 9 else v for v in values) % 10 == 0


def personal(text: str | None) -> list[tuple[int, int, int]]:
    out = []
    for k, (name, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or "", re.A):
            n = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": name == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                    "card": 14 <= len(n) <= 19 and luhn(n), "phone": 10 <= len(n) <= 15}[name]
            if good:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def shingle_set(text: str | None) -> frozenset:
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = [w for w in re.split("[\x20\x09-\x0d]+", lower) if w]
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def near_components(texts: list, percent: int) -> list[int]:
    """The component of every row: the smallest row number in it."""
    sets = [shingle_set(t) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(texts))]


def repeats(texts: list, length: int = 200) -> list[tuple[int, int, int, str]]:
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(t[i:i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for t in raw:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(t), sum(gone), runs, sha(bytes(c for c, g in zip(t, gone) if not g))))
    return out
