import sys
from pathlib import Path

import pytest

for folder in (Path(__file__).resolve().parents[2], Path(__file__).resolve().parent):
    sys.path.insert(0, str(folder))

from odd_rows import ODD  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, a null id, and columns whose names the operators use."""
    rows = [(k, t, None, "s", len(t or "")) for k, t in enumerate(ODD)]
    rows += [(3, "word", "en", "s", 4), (None, "no id at all here", "en", None, None), (None, None, None, None, None)]
    out = spark.createDataFrame(rows, DOCS)
    for name in ("id", "label", "component", "length", "piece", "salt", "doc", "batch", "hash_a", "bucket", "lead", "score", "held_out", "kept_text", "n_lines", "url", "gram"):
        out = out.selectExpr("*", f"'clash' as {name}")
    return out


@pytest.fixture(scope="session")
def none(docs):
    return docs.limit(0)
