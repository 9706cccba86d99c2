"""Merge tables of a byte-level BPE tokenizer file, shared by operators 3 and 10.

The file (the tokenizers library's JSON layout) is read once on the driver and
broadcast: its size is fixed by the vocabulary, not by the corpus. A Python
worker parses it once and keeps the model and its word cache between tasks.
"""

from __future__ import annotations

import hashlib
import json
from functools import cached_property
from heapq import heapify, heappop, heappush

import regex


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Bytes that are printable in Latin-1 stand for themselves; the others take
    the characters from U+0100 on, in order.
    """
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    letters, spare = [], 0x100
    for b in range(256):
        letters.append(chr(b if b in printable else spare))
        spare += b not in printable
    return letters


_BITS = 17


class BpeModel:
    """Vocabulary, merge ranks and special strings of one tokenizer file.

    Symbols are numbered anew: 0 to 255 the bytes, 256 to 511 the bytes at the
    end of a word (only in files with a word-end suffix), then the results of
    merges, so that the bytes of a word are its first symbols as they stand.
    """

    def __init__(self, data: bytes):
        spec = json.loads(data)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        suffix: str = model.get("end_of_word_suffix") or ""
        self.ends = bool(suffix)
        self.specials: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        letters = byte_letters()
        self.token: list[str] = letters + ([c + suffix for c in letters] if suffix else [])
        number = {t: i for i, t in enumerate(self.token)}
        #: left << 17 | right -> rank; made[rank] is the symbol the pair becomes
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        for at, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            if (merged := left + right) not in number:
                number[merged] = len(self.token)
                self.token.append(merged)
            self.rank[number[left] << _BITS | number[right]] = at
            self.made.append(number[merged])
        for text in self.specials:
            number[text] = len(self.token)
            self.token.append(text)
        self.number = number
        ids = {**vocab, **self.specials}
        self.id_text: list[str] = [str(ids[t]) for t in self.token]

    @cached_property
    def special_pattern(self) -> regex.Pattern:
        longest_first = sorted(self.specials, key=len, reverse=True)
        return regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")")

    def symbols(self, word: str) -> list[int]:
        ids = list(word.encode("utf-8"))
        if self.ends and ids:
            ids[-1] += 256
        return ids

    def split_specials(self, text: str) -> list[str]:
        """Ordinary stretches at even places, special strings at odd ones."""
        return self.special_pattern.split(text) if "<|" in text else [text]


def heap_merge(model: BpeModel, ids: list[int]) -> int:
    """Merge ``ids`` in place; the number of merges. Symbols merged away become -1.

    The heap holds (rank, place of the left symbol) of adjacent pairs, the
    linked list the neighbours of the symbols that are left. A popped pair
    whose symbols have changed since is stale and skipped.
    """
    rank, made, n = model.rank.get, model.made, len(ids)
    heap = [r << 32 | i for i, pair in enumerate(zip(ids, ids[1:]))
            if (r := rank(pair[0] << _BITS | pair[1])) is not None]
    if not heap:
        return 0
    heapify(heap)
    following, before, merges = list(range(1, n + 1)), list(range(-1, n - 1)), 0
    while heap:
        top = heappop(heap)
        i = top & 0xFFFFFFFF
        j = following[i]
        left = ids[i]
        if left < 0 or j >= n or rank(left << _BITS | ids[j]) != top >> 32:
            continue
        merged = ids[i] = made[top >> 32]
        ids[j] = -1
        merges += 1
        k = following[i] = following[j]
        if k < n:
            before[k] = i
            if (s := rank(merged << _BITS | ids[k])) is not None:
                heappush(heap, s << 32 | i)
        p = before[i]
        if p >= 0 and (s := rank(ids[p] << _BITS | merged)) is not None:
            heappush(heap, s << 32 | p)
    return merges


_LOADED: dict[tuple, object] = {}


def per_worker(kind, data: bytes, *args):
    """``kind(BpeModel, *args)``, built once in each Python worker."""
    key = (kind, hashlib.sha256(data).digest(), *args)
    if key not in _LOADED:
        _LOADED[key] = kind(BpeModel(data), *args)
    return _LOADED[key]


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()
