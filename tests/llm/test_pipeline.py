"""The pipeline against its stages' own rules on a small table."""

import hashlib

import pytest

import corpus_pipeline
from voxframe.llm import neardup
from voxframe.llm._common import materialise

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(materialise(stage(spark, out[-1], SF), name))
    return out


def test_each_stage_keeps_the_columns_and_rows(stages):
    docs, good, known, lines, unique, packed = stages
    for df in (good, known, lines, unique):
        assert df.columns == docs.columns and df.dtypes == docs.dtypes
    counts = [df.count() for df in (docs, good, known, lines, unique)]
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0
    ids = [{r[0] for r in df.select("doc_id").collect()} for df in (docs, good, known, lines, unique)]
    assert all(b <= a for a, b in zip(ids, ids[1:], strict=False)) and ids[2] == ids[3]
    assert {r[0] for r in packed.select("doc_id").distinct().collect()} == ids[-1]


def test_clean_documents_stay(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    wanted = stages[0].join(labels, "doc_id").where("quality = 1")
    assert stages[1].join(wanted, "doc_id", "left_semi").count() > 0.95 * wanted.count()


def test_lines_follow_brute_force(stages):
    from test_operators import brute_lines

    before = [(r.doc_id, r.text) for r in stages[2].select("doc_id", "text").collect()]
    want = brute_lines(before, 40, 5)
    for r in stages[3].select("doc_id", "text", "n_chars").collect():
        assert r.text == want[r.doc_id][2] and r.n_chars == len(r.text)


def test_one_of_each_group_stays(stages):
    from test_operators import brute_components, shingles_of

    sets = {r.doc_id: shingles_of(r.text) for r in stages[3].select("doc_id", "text").collect()}
    want = {k for k, c in brute_components(sets, 80).items() if k == c}
    assert {r[0] for r in stages[4].select("doc_id").collect()} == want
    left = neardup.near_duplicates(stages[4], percent=80)
    assert left.where("not kept").count() == 0


def test_run_gives_the_last_stage(spark, stages):
    digest = lambda df: hashlib.sha256(str(sorted((r.doc_id, r.piece, r.ids_crc32) for r in df.collect())).encode()).hexdigest()
    assert digest(corpus_pipeline.run(spark, SF)) == digest(stages[-1])


ODD = [(None, None, None, None, None), (1, None, "en", "s", 0), (2, "", None, "s", 0), (3, "a word", "en", None, 6), (3, "a word", "en", None, 6), (4, "same here", "en", "s", 9), (5, "same here", "en", "s", 9)]
#: Ids that come out; of quality what the model says. A null id has no partner.
WANTED = {"language": [3, 3, 4, 5], "line_dedup": [None, 1, 2, 3, 3, 4, 5], "near_duplicates": [None, 1, 2, 3, 3, 4], "packing": [None, 1, 2, 3, 3, 4, 5]}


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_stand_empty_and_null_rows(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert stage(spark, docs.limit(0), SF).count() == 0
    odd = spark.createDataFrame(ODD, docs.schema)
    clash = odd.selectExpr("*", *(f"concat('clash', doc_id) as {c}" for c in ("kept_text", "n_lines", "n_dropped", "id", "label", "score", "component", "batch", "length")))
    got = {r: stage(spark, df, SF).collect() for r, df in (("plain", odd), ("clash", clash))}
    ids = lambda rows: sorted((r.doc_id for r in rows), key=lambda x: (x is not None, x))
    assert ids(got["plain"]) == ids(got["clash"])
    if name in WANTED:
        assert ids(got["plain"]) == WANTED[name]
    if name != "packing":
        assert stage(spark, clash, SF).columns == clash.columns
        assert all(r[c] == (None if r.doc_id is None else f"clash{r.doc_id}") for r in got["clash"] for c in clash.columns[5:])
        texts = {k: t for k, t, *_ in ODD}
        assert all(r.text == (texts[r.doc_id] or "" if name == "line_dedup" else texts[r.doc_id]) for r in got["clash"])
