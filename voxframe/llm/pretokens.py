"""Splitting texts into the pieces that byte-level BPE encodes separately, and caches of their ids."""

from __future__ import annotations

import array
import base64
import json
import re
import unicodedata
from collections.abc import Callable

import regex

# White space of the Unicode standard, as the tokenizer libraries' \s has it.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
LATIN_END = 0x250
_OUTSIDE = re.compile(f"[^\\x00-{chr(LATIN_END - 1)}]")


def _ranges(kind: str) -> str:
    """The Latin code points of one general category, as the inside of a character class."""
    points = [i for i in range(LATIN_END) if unicodedata.category(chr(i))[0] == kind]
    runs, start = [], None
    for i, x in enumerate(points):
        start = x if start is None else start
        if i + 1 == len(points) or points[i + 1] != x + 1:
            runs.append(f"\\u{start:04x}-\\u{x:04x}")
            start = None
    return "".join(runs)


def _pattern(letter: str, number: str) -> str:
    """Fixed value: the public pattern, its alternatives in their order, for given classes."""
    return f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{SPACE}{letter}{number}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"


LATIN = re.compile(_pattern(_ranges("L"), _ranges("N")))
ANY = regex.compile(_pattern("\\p{L}", "\\p{N}"))


def split(text: str) -> list[str]:
    """The pieces of public_tokenizers.PATTERN in order; together they are the text."""
    return (ANY if _OUTSIDE.search(text) else LATIN).findall(text)


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies, reversed."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def json_ranks(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Ranks and special strings of a byte-level tokenizer's JSON file.

    Ids must rise in the order of the merges; then merging by rank gives the library's ids, as a pair that
    joins to a token can only come up by that token's own merge. A ValueError says so otherwise.
    """
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    vocab, letters = spec["model"]["vocab"], byte_letters()
    special = {x["content"]: x["id"] for x in spec["added_tokens"]}
    merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    ids = [vocab[a + b] for a, b in merges]
    if ids != sorted(ids):
        raise ValueError("ids don't follow the merges")
    return {bytes(letters[c] for c in word): i for word, i in vocab.items() if word not in special}, special


def tiktoken_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class Ids(dict):
    """Little-endian unsigned 32-bit ids by piece. Holds at most `most` pieces, then begins anew."""

    def __init__(self, encode: Callable[[bytes], list[int]], most: int = 400_000):
        super().__init__()
        self.encode, self.most = encode, most

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= self.most:
            self.clear()
        ids = array.array("I", self.encode(piece.encode("utf-8"))).tobytes()
        if len(piece) <= 64:
            self[piece] = ids
        return ids


class Encoder:
    """Whole texts to the bytes of their ids, as the tokenizers library gives them for a byte-level JSON file."""

    def __init__(self, path: str):
        import tiktoken

        ranks, self.special = json_ranks(path)
        core = tiktoken.Encoding("pieces", pat_str="[\\s\\S]+", mergeable_ranks=ranks, special_tokens={})._core_bpe
        self.ids = Ids(core.encode_single_piece)
        self.marks = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def parts(self, text: str) -> list[str]:
        """The text cut at special strings, which stand at the odd places."""
        return self.marks.split(text) if self.marks and any(x in text for x in self.special) else [text]

    def __call__(self, text: str) -> bytes:
        get = self.ids.__getitem__
        out = []
        for k, part in enumerate(self.parts(text)):
            out.append(self.special[part].to_bytes(4, "little") if k % 2 else b"".join(map(get, split(part))))
        return b"".join(out)


_LOADED: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder, with its cache, for each worker process."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]
