"""Byte-level BPE by dynamic programming over prefixes.

For every byte prefix of a piece there is exactly one token that can end its encoding; an array of these last
tokens is the whole state. A sequence of tokens is the encoding of its bytes just when each token encodes to
itself and each pair of neighbours, put together and encoded, comes apart into the same pair: merges that stay
inside the tokens go on as if the neighbours weren't there, so the first merge over a boundary would also
happen in that pair alone. The encoding follows by walking back from the end. As a prefix's last token never
depends on later bytes, appending is exact, and after an edit only the places from it to where the array
agrees with the old one again, over the longest token's length, are computed anew.

A null text is an empty one and gives no ids; texts of any length are encoded whole, a match at a time. Rows are encoded by
themselves: repeated rows and ties come out alike, an empty table gives no rows, and extra columns are left out, whatever their names.
"""

from __future__ import annotations

import array
import hashlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import mapped
from .pretokens import Ids, split, tiktoken_ranks


class PrefixBPE:
    """Encodes and decodes pieces by ranks (token bytes to id). Memory: ranks, and at most `most` judged pairs."""

    def __init__(self, ranks: dict[bytes, int], most: int = 1_000_000):
        self.ranks, self.most = ranks, most
        self.token = {i: t for t, i in ranks.items()}
        self.longest = max(map(len, ranks), default=0)
        self.pairs: dict[tuple[int, int], bool] = {}
        self.whole: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()  # gives the tokens that end at each place, longest first
        for token, i in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), (i, len(token)))
        if ranks:
            self.automaton.make_automaton()

    def merged(self, data: bytes) -> list[bytes]:
        """Plain merging, lowest rank first, then leftmost; for the few bytes of one or two tokens."""
        parts = [data[i : i + 1] for i in range(len(data))]
        get = self.ranks.get
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stands(self, token: int) -> bool:
        if token not in self.whole:
            self.whole[token] = len(self.merged(self.token[token])) == 1
        return self.whole[token]

    def fits(self, left: int, right: int) -> bool:
        """Whether right may follow left in an encoding."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= self.most:
                self.pairs.clear()
            a, b = self.token[left], self.token[right]
            known = self.pairs[left, right] = self.stands(right) and self.merged(a + b) == [a, b]
        return known

    def extend(self, data: bytes, last: list[int], upto: int | None = None) -> list[int]:
        """Last tokens of the prefixes of data, of which those of the first len(last) bytes are given."""
        pairs, fits, done = self.pairs, self.fits, len(last)
        upto = len(data) if upto is None else upto
        begin = max(0, done - self.longest)
        for end, (token, size) in self.automaton.iter(data[begin:upto].decode("latin-1")):
            end += begin + 1
            if end <= done:
                continue
            if end > done + 1:
                break
            start = end - size
            if start:
                left = last[start - 1]
                known = pairs.get((left, token))
                if not (known or known is None and fits(left, token)):
                    continue
            elif not self.stands(token):
                continue
            last.append(token)
            done = end
        if done < upto:
            raise ValueError("the ranks lack a single byte")
        return last

    def ids(self, last: list[int]) -> list[int]:
        out, end = [], len(last)
        while end:
            out.append(last[end - 1])
            end -= len(self.token[out[-1]])
        return out[::-1]

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one piece; a piece that is a token is that token."""
        known = self.ranks.get(piece)
        return [known] if known is not None else self.ids(self.extend(piece, []))

    def edit(self, data: bytes, last: list[int], start: int, end: int, new: bytes) -> tuple[bytes, list[int]]:
        """The state after data[start:end] became new; places beyond the edit are reused once the states agree."""
        changed = data[:start] + new + data[end:]
        moved, fresh, agree = end - start - len(new), last[:start], 0
        while len(fresh) < len(changed):
            self.extend(changed, fresh, len(fresh) + 1)
            old = len(fresh) - 1 + moved
            agree = agree + 1 if len(fresh) > start + len(new) and fresh[-1] == last[old] else 0
            if agree >= self.longest:
                fresh += last[old + 1 :]
        return changed, fresh

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


_LOADED: dict[str, tuple[PrefixBPE, Ids]] = {}


def loaded(path: str) -> tuple[PrefixBPE, Ids]:
    if path not in _LOADED:
        coder = PrefixBPE(tiktoken_ranks(path))
        _LOADED[path] = coder, Ids(coder.encode)
    return _LOADED[path]


def encode_texts(docs: DataFrame, path: str, key: str = "doc_id", column: str = "text") -> DataFrame:
    """doc_id, ids (array<int>) and decoded (binary) of every whole text; null and empty texts have no ids."""
    return _mapped(docs, path, key, column, "doc_id long, ids array<int>, decoded binary", lambda doc, ids, decoded: (doc, pa.array([array.array("i", x) for x in ids], pa.list_(pa.int32())), pa.array(decoded, pa.binary())))


def encode_digests(docs: DataFrame, path: str, key: str = "doc_id", column: str = "text") -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of ids and of decoded bytes, taken where they are made so that they don't travel."""

    def columns(doc: pa.Array, ids: list[bytes], decoded: list[bytes]) -> tuple:
        return doc, pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in ids]), pa.array([hashlib.sha256(x).hexdigest() for x in decoded])

    return _mapped(docs, path, key, column, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", columns)


def _mapped(docs: DataFrame, path: str, key: str, column: str, schema: str, columns) -> DataFrame:
    names = [x.split()[0] for x in schema.split(", ")]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, cache = loaded(path)
        get, token = cache.__getitem__, coder.token.__getitem__
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                some = batch.slice(at, 1000)
                ids = [b"".join(map(get, split(text))) if text else b"" for text in some.column(1).to_pylist()]
                decoded = [b"".join(map(token, array.array("I", x))) for x in ids]
                yield pa.RecordBatch.from_arrays(list(columns(some.column(0), ids, decoded)), names)

    return mapped(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(column).alias("text")), encode, schema)
