"""Fill-in-the-middle: texts cut into prefix, middle and suffix, and put together with marks in another order.

A unit is a run of white space with the word behind it, or the white space that ends a text. The cuts lie between units
and come from a hash of seed and key, so a document has the same form in every run and on every machine. An Arrow-batched
pandas UDF finds the units with `regex`'s finditer and keeps their ends, 8 bytes each, in one array; a cut is one look into
it. Texts that hold one of the marks stay plain, so what is put together can always be taken apart again.

Null and empty texts are plain and have no units; a null key is hashed as an empty one. A text of any length is one value,
never cut short. Rows are handled by themselves: repeated rows and ties come out alike, an empty table gives no rows, and
extra columns don't matter, whatever their names; `infilled` keeps them, save those named like its own.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import BATCH_ROWS

# What a unit is, and the marks of prefix, suffix and middle.
UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
MARKS = ("<P>", "<S>", "<M>")

FIND = regex.compile(UNIT)
OWN = ("n", "form", "prefix_chars", "middle_chars", "output")


@dataclass(frozen=True)
class Rates:
    """Of a hundred texts, how many are cut; and of a hundred of these, how many have the suffix first."""

    seed: int = 42
    cut: int = 50
    suffix_first: int = 80


def unit_ends(text: str) -> array:
    """Where each unit ends, in code points."""
    return array("q", (m.end() for m in FIND.finditer(text)))


def infill(key: str, text: str, rates: Rates) -> tuple[int, str, int | None, int | None, str]:
    """Units, form, characters of prefix and middle (none where plain), output."""
    ends = unit_ends(text)
    n = len(ends)
    h = sha256(f"{rates.seed}:{key}".encode()).hexdigest()
    first, second, whether, order = (int(h[k : k + 8], 16) for k in range(0, 32, 8))
    if not text or whether % 100 >= rates.cut or any(mark in text for mark in MARKS):
        return n, "plain", None, None, text
    a, b = sorted((first % (n + 1), second % (n + 1)))
    a, b = (ends[k - 1] if k else 0 for k in (a, b))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    p, s, m = MARKS
    if order % 100 < rates.suffix_first:
        return n, "spm", a, b - a, f"{s}{suffix}{p}{prefix}{m}{middle}"
    return n, "psm", a, b - a, f"{p}{prefix}{s}{suffix}{m}{middle}"


def restore(output: str, form: str) -> str:
    """The text that an output was made from.

    A mark can't begin inside another or end in one, so the first of each kind is the one that was put in.
    """
    if form == "plain":
        return output
    p, s, m = MARKS
    first, second = (s, p) if form == "spm" else (p, s)
    front, middle = output.removeprefix(first).split(m, 1)
    one, two = front.split(second, 1)
    return f"{two}{middle}{one}" if form == "spm" else f"{one}{middle}{two}"


def _whole(values: list[int | None]) -> pd.Series:
    return pd.Series(values, dtype="Int64")


def _pieces(key: pd.Series, text: pd.Series) -> Iterator[tuple[pd.Series, pd.Series]]:
    """A few rows at a time: outputs are as long as texts, and both are held."""
    for at in range(0, len(key), BATCH_ROWS):
        yield key.iloc[at : at + BATCH_ROWS], text.iloc[at : at + BATCH_ROWS]


def _udf(schema: str, rates: Rates, row):
    names = [x.split()[0] for x in schema.split(", ")]

    def mapped(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for keys, texts in _pieces(*batch):
                rows = [row(infill(k, t, rates)) for k, t in zip(keys, texts, strict=True)]
                columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
                yield pd.DataFrame({c: _whole(v) if f"{c} long" in schema else pd.Series(v, dtype=object) for c, v in zip(names, columns, strict=True)})

    mapped.__annotations__ = {"batches": Iterator[tuple[pd.Series, pd.Series]], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(mapped, schema)


def _inputs(key: str, column: str) -> tuple[Column, Column]:
    return F.coalesce(F.col(key).cast("string"), F.lit("")), F.coalesce(F.col(column), F.lit(""))


def infilled(docs: DataFrame, key: str = "doc_id", column: str = "text", rates: Rates = Rates()) -> DataFrame:
    """docs with n (units), form (plain, psm or spm), prefix_chars, middle_chars and output."""
    made = _udf("n long, form string, prefix_chars long, middle_chars long, output string", rates, lambda x: x)
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in OWN]
    return docs.select(F.struct(*kept).alias("_row"), made(*_inputs(key, column)).alias("_made")).select("_row.*", *(F.col(f"_made.{c}") for c in OWN))


def restored(output: Column, form: Column) -> Column:
    """The texts that outputs were made from."""

    def back(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for outputs, forms in batches:
            yield pd.Series([None if o is None else restore(o, f) for o, f in zip(outputs, forms, strict=True)], dtype=object)

    back.__annotations__ = {"batches": Iterator[tuple[pd.Series, pd.Series]], "return": Iterator[pd.Series]}
    return F.pandas_udf(back, "string")(output, form)


def infill_digests(docs: DataFrame, key: str = "doc_id", column: str = "text", rates: Rates = Rates()) -> DataFrame:
    """What `infilled` gives, with the outputs' digests and those of the texts taken from the outputs again in place of the outputs."""

    def digest(made: tuple) -> tuple:
        *rest, output = made
        return *rest, sha256(output.encode()).hexdigest(), sha256(restore(output, rest[1]).encode()).hexdigest()

    made = _udf("n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string", rates, digest)
    return docs.select(F.col(key).cast("long").alias("doc_id"), made(*_inputs(key, column)).alias("_made")).select("doc_id", "_made.*")
