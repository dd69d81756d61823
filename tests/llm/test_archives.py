"""WARC archives, hard negatives and fill-in-the-middle against brute force, and on odd rows."""

import gzip
import hashlib
import io
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from odd_rows import ODD
from voxframe.llm import hardneg, infill, warc
from voxframe.llm.entries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def canon(rows):
    return Counter(tuple(None if v is None else v for v in r) for r in rows)


@pytest.mark.parametrize("name", ["op11_warc", "op12_hard_negatives", "op13_infill"])
def test_same_as_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    want = duck.sql(ORACLE_SQL[name])
    assert sorted(want.columns) == columns
    assert canon(df.select(*columns).collect()) == canon(want.select(*columns).fetchall())


# 11 WARC

PAGES = "page_id long, url string, html string, payload_digest string, _first string, refers_to string"
SAME = "<p>" + "the same page " * 20


def odd_pages():
    rows = [(k, f"http://e.org/{k}", t) for k, t in enumerate(ODD)]
    rows += [(100 + k, f"http://e.org/s{k}", SAME) for k in range(40)] + [(90, None, SAME), (90, "http://again", SAME), (None, "", SAME)]
    rows += [(200, "http://é.org/a b\r\nX: y", "x" * 99), (201, "u", "x" * 99), (202, "u", "x" * 100), (-5, "u", "x" * 100), (1 << 62, "u", "é" * 50), (-(1 << 62), "u", "é" * 50), (None, "u", "only without an id " * 9), (None, "u", "only without an id " * 9)]
    return rows


def expected(rows):
    first = {}
    for page, _, html in rows:
        if page is not None and len((html or "").encode()) >= 100:
            first[html] = min(page, first.get(html, page))
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        to = first.get(html)
        to = None if to is None or page == to else to
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), "response" if to is None else "revisit", to))
    return Counter(out)


def test_pages_come_back(spark, monkeypatch):
    rows = odd_pages()
    pages = spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], PAGES).repartition(3)
    assert canon(warc.archived(pages, split_bytes=700).collect()) == expected(rows)
    monkeypatch.setattr(warc, "if_small", lambda df, most: df)  # the way for many groups
    assert canon(warc.archived(pages).collect()) == expected(rows)
    assert warc.archived(pages.limit(0)).count() == 0


def test_whole_records(spark, tmp_path):
    """Files are gzip as any reader sees them; payloads are those of the pages, and a revisit's are found by its digest."""
    rows = odd_pages()
    warc.write(warc.revisits(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)), str(tmp_path), date="2024-01-01T00:00:00Z")
    files = sorted(tmp_path.glob("*.warc.gz"))
    assert len(files) == 2 and not list(tmp_path.glob("*.crc"))
    found = warc.read(spark, str(tmp_path), split_bytes=500)
    assert warc.gaps(found).count() == 0
    got = [r for r in found.collect() if r.warc_type != "warcinfo"]
    texts = {r.payload_digest: bytes(r.payload).decode() for r in got if r.warc_type == "response"}
    assert Counter((r.row_id, texts[r.payload_digest]) for r in got) == Counter((p, h or "") for p, _, h in rows)
    plain = [gzip.decompress(f.read_bytes()) for f in files]
    heads = [m.decode() for data in plain for m in re.findall(rb"WARC/1\.1\r\n.*?\r\n\r\n", data, re.S)]
    assert len(heads) == len(rows) + 2 and all("2024-01-01T00:00:00Z" in h for h in heads)
    assert sum(len(f.read_bytes()) for f in files) == sum(r.length for r in found.collect())
    ids = Counter(r.record_id for r in got if r.row_id is not None)
    assert {r.refers_to for r in got if r.refers_to} <= ids.keys()
    assert any("X:%20y" not in h and "%0D%0AX:%20y" in h for h in heads) or any("%0D%0AX:%20y" in h for h in heads)


def test_files_are_bounded_and_replaced(spark, tmp_path):
    pages = warc.revisits(spark.createDataFrame([(k, "u", random.Random(k).randbytes(3000).hex()) for k in range(40)], "page_id long, url string, html string").coalesce(1))
    pages = pages.select("row_id", "target_uri", "payload", "payload_digest", "refers_to")
    spark.dataSource.register(warc.WarcSource)
    for _ in range(2):
        pages.write.format("warc").mode("overwrite").option("fileBytes", 20_000).save(str(tmp_path))
    assert len(list(tmp_path.glob("*.warc.gz"))) > 3
    assert warc.page_records(warc.read(spark, str(tmp_path))).count() == 40


def archive(payloads, level=6):
    parts = [warc.page_member(k, f"http://e/{k}", p, hashlib.sha256(p).hexdigest(), None, "2024-01-01T00:00:00Z", level) for k, p in enumerate(payloads)]
    places = np.cumsum([0, *map(len, parts)]).tolist()
    return b"".join(parts), places


def in_splits(data, step):
    out = []
    for a in range(0, len(data), step):
        out += [(place, length, warc.row_of(head["warc-record-id"]), block) for place, length, head, block in warc.records(warc.Window(io.BytesIO(data), len(data)), a, min(len(data), a + step))]
    return out


def test_each_record_in_one_split():
    rng = random.Random(1)
    magic = warc.MAGIC + bytes(7) + b"WARC/1.1"
    payloads = [b"", b"a" * 5000, *(rng.randbytes(rng.randrange(3000)) + magic + rng.randbytes(rng.randrange(400)) for _ in range(30)), magic * 300]
    for level in (0, 6):
        data, places = archive(payloads, level)
        for step in (1 << 9, 1 << 12, 5 << 12, len(data)):
            got = in_splits(data, step)
            assert [g[0] for g in got] == places[:-1] and [g[2] for g in got] == list(range(len(payloads)))
            assert [g[3].partition(b"\r\n\r\n")[2] for g in got] == payloads


def test_archive_inside_a_record():
    """Stored, an archive's members lie in the file as they are; they are still part of one record."""
    rng = random.Random(2)
    inner, _ = archive([rng.randbytes(900) for _ in range(200)])
    assert len(inner) > 2 * warc.STORED
    payloads = [b"before", inner, b"between", inner[:30_000], b"after"]
    data, places = archive(payloads, level=0)
    assert data.count(b"".join((warc.MAGIC,))) > 200
    for step in (3000, 20_000, 100_000):
        assert [g[:1] + g[2:3] for g in in_splits(data, step)] == list(zip(places[:-1], range(5), strict=True))


def test_damage(spark, tmp_path):
    data, places = archive([random.Random(k).randbytes(500) for k in range(50)])
    bad = bytearray(data)
    bad[places[20] + 100] ^= 0xFF
    with pytest.raises(ValueError, match=f"byte {places[20]}"):
        in_splits(bytes(bad), len(bad))
    (tmp_path / "x.warc.gz").write_bytes(data[: places[20]] + data[places[21] - 7 :])
    with pytest.raises(Exception, match="no whole record"):
        warc.read(spark, str(tmp_path)).count()
    # a range that begins in the damaged part goes on behind it, and the gap shows
    (tmp_path / "x.warc.gz").write_bytes(bytes(bad))
    found = warc.read(spark, str(tmp_path / "x.warc.gz"), split_bytes=places[20])
    assert found.count() == 49 and warc.gaps(found).count() == 1
    (tmp_path / "x.warc.gz").write_bytes(b"\0" * 10 + data)
    with pytest.raises(Exception, match="no whole record"):
        warc.read(spark, str(tmp_path)).count()


def test_gap_shows(spark, tmp_path):
    data, places = archive([random.Random(k).randbytes(500) for k in range(400)])
    split = places[200]
    (tmp_path / "x.warc.gz").write_bytes(data[:split] + b"\0" * 9 + data[split:])
    found = warc.read(spark, str(tmp_path), split_bytes=split)
    assert found.count() == 400 and [r.covered for r in warc.gaps(found).collect()] == [len(data)]


def test_record_ids():
    for row in (0, 1, -1, 5, -(1 << 63), (1 << 63) - 1, 1 << 40):
        assert warc.row_of(warc.record_id(row, "ffffffff" + "0" * 56)) == row
    assert warc.row_of(warc.record_id(None, "")) is None and warc.row_of("<urn:x>") is None and warc.row_of(None) is None
    assert warc.record_id(1, "0" * 64) != warc.record_id(1, "1" * 64)


def test_heads():
    good = b"WARC/1.0\r\nWARC-Type: a\r\nwarc-record-id: <b>\r\nWARC-Date: c\r\n d\r\nContent-Length: 2\r\n\r\nxy\r\n\r\n"
    head, block = warc.parsed(good)
    assert block == b"xy" and head["warc-date"] == "c d"
    for bad in (good[:-1], good.replace(b"h: 2", b"h: 3"), good.replace(b"h: 2", b"h: z"), good.replace(b"WARC/", b"warc/"), good.replace(b"WARC-Type", b"Type"), good.replace(b"WARC-Type:", b"WARC-Type"), b""):
        assert warc.parsed(bad) is None
    gz = zlib.compressobj(6, zlib.DEFLATED, 31)
    data = gz.compress(b"no record") + gz.flush()
    assert warc.decoded(warc.Window(io.BytesIO(data), len(data)), 0) == (b"no record", len(data))
    assert warc.decoded(warc.Window(io.BytesIO(data), len(data)), 0, head_only=True) is None
    assert warc.decoded(warc.Window(io.BytesIO(data[:-1]), len(data) - 1), 0) is None


# 12 hard negatives

VECTORS = "vec_id long, label int, embedding array<double>, score long, cells string, query string, v string"


def negatives_of(rows, anchor, plan):
    part = {}
    for vec, label, v, *_ in rows:
        if vec is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        part[(vec, label, tuple(max(-hardneg.MOST, min(hardneg.MOST, math.floor(256 * x))) for x in v))] = None
    out = []
    for a, la, va in part:
        if not anchor(a):
            continue
        scored = sorted({(-sum(x * y for x, y in zip(va, v, strict=False)), i, label) for i, label, v in part if i != a})
        positives = [(i, -s) for s, i in dict.fromkeys((s, i) for s, i, label in scored if label == la)][: plan.positives]
        for p, ps in positives:
            fits = dict.fromkeys((i, -s) for s, i, label in scored if label != la and plan.least * ps <= -100 * s <= plan.most * ps)
            out += [(a, p, r + 1, i, ps, s) for r, (i, s) in enumerate([*fits][: plan.negatives])]
    return Counter(out)


def mined(spark, rows, anchor, **more):
    df = spark.createDataFrame([(*r, 1, "clash", "clash", "clash") for r in rows], VECTORS).repartition(3)
    return canon(hardneg.mined(df, anchor, **more).collect())


@pytest.mark.parametrize("width", [1, 6, 33])
def test_negatives_by_hand(spark, width, monkeypatch):
    monkeypatch.setattr(hardneg, "TILE_ROWS", 16)
    monkeypatch.setattr(hardneg, "TILE_ANCHORS", 4)
    monkeypatch.setattr(hardneg, "PAIRS", 7)
    rng = random.Random(width)
    rows = [(k, rng.randrange(3), [rng.gauss(0.02, 0.1) for _ in range(width)]) for k in range(150)]
    rows += [(1000 + k, k % 3, [0.1] * width) for k in range(60)]  # one very common vector
    rows += [rows[5], rows[5], (5, 1, [0.2] * width), (10, 0, rows[10][2]), (None, 1, [0.1] * width), (400, None, [0.1] * width), (401, 1, None), (402, 1, [None] + [0.1] * (width - 1)), (403, 2, [math.nan] * width), (404, 0, [-math.inf] * width)]
    rows += [(500, 0, [0.1] * max(1, width - 2)), (501, 1, []), (510, 2, [9e9] * width), (511, 1, [-9e9] * width), (-10, 0, [0.3] * width)]
    for plan, numbers in ((hardneg.Plan(), 1_000_000), (hardneg.Plan(2, 3, 10, 100), 5 * width)):
        want = negatives_of(rows, lambda a: a % 10 == 0, plan)
        assert want and mined(spark, rows, F.col("vec_id") % 10 == 0, plan=plan, numbers=numbers, draw=50) == want


def test_negatives_of_nothing(spark):
    assert not mined(spark, [], F.lit(True))
    assert not mined(spark, [(1, None, [1.0]), (None, 1, [1.0])], F.lit(True))
    assert not mined(spark, [(1, 1, [1.0]), (2, 1, [1.0])], F.col("vec_id") > 5)
    assert not mined(spark, [(1, 1, [1.0])], F.lit(True))  # no positive
    assert not mined(spark, [(k, 1, []) for k in range(5)], F.lit(True))  # no negative
    assert mined(spark, [(k, k % 2, []) for k in range(4)], F.col("vec_id") == 0) == Counter({(0, 2, 1, 1, 0, 0): 1, (0, 2, 2, 3, 0, 0): 1})


def test_bounds_hold(monkeypatch):
    rng = np.random.default_rng(0)
    vectors = rng.integers(-200, 200, (300, 7))
    edges = np.sort(np.concatenate([vectors.min(0)[:, None], rng.integers(-200, 200, (7, hardneg.CELLS - 1)), vectors.max(0)[:, None] + 1], axis=1), axis=1)
    codes = np.stack([np.searchsorted(edges[d, 1:-1], vectors[:, d], side="right") for d in range(7)] + [np.zeros(300, int)], axis=1)
    packed = (codes[:, ::2] * hardneg.CELLS + codes[:, 1::2]).astype(np.uint8)
    anchors = rng.integers(-200, 200, (5, 7))
    exact = vectors @ anchors.T
    row, anchor = np.nonzero(np.ones_like(exact))
    monkeypatch.setattr(hardneg, "PAIRS", 100)
    assert np.array_equal(hardneg._exact(vectors.astype("<i4"), anchors, row, anchor), exact.ravel())
    low, high = (hardneg._summed(hardneg._bounds(anchors, edges, upper), packed) for upper in (False, True))
    assert (low <= exact).all() and (exact <= high).all() and (high - low).mean() < np.ptp(exact)


# 13 fill-in-the-middle


def infilled_by_hand(doc, text):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    h = hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(h[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    return (n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 80 else (n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def test_infill_by_hand(spark, docs):
    more = [(k, t, None, None, None) for k, t in enumerate(["a <P> b", "<S", "<<S>>", "S> x <", "P>P>", "<M", *(f"< {k} <" for k in range(60)), " lead", "trail \n", " em space x\u0085y"] * 2, 500)]
    rows = docs.select("doc_id", "text", "lang", "source", "n_chars").unionByName(spark.createDataFrame(more, "doc_id long, text string, lang string, source string, n_chars long"))
    rows = rows.withColumn("form", F.lit("clash")).withColumn("n", F.lit("clash")).withColumn("_made", F.lit("clash"))
    made = infill.infilled(rows).withColumn("back", infill.restored(F.col("output"), F.col("form")))
    got = made.select("doc_id", "text", "n", "form", "prefix_chars", "middle_chars", "output", "back").collect()
    assert len(got) == rows.count() and {r.form for r in got} == {"plain", "psm", "spm"} and "lang" in made.columns
    for r in got:
        assert tuple(r)[2:7] == infilled_by_hand(r.doc_id, r.text) and r.back == (r.text or "")
    sums = infill.infill_digests(rows).collect()
    want = Counter((r.doc_id, *infilled_by_hand(r.doc_id, r.text)[:4], hashlib.sha256(r.output.encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()) for r in got)
    assert canon(sums) == want


def test_infill_of_nothing_and_rates(spark, none):
    assert infill.infilled(none).count() == infill.infill_digests(none).count() == 0
    rows = spark.range(3000).selectExpr("id as doc_id", "repeat('word ', 9) as text")
    share = {r.form: r.n / 3000 for r in infill.infilled(rows, rates=infill.Rates(seed=7, cut=90, suffix_first=25)).groupBy("form").agg(F.count("*").alias("n")).collect()}
    assert abs(share["plain"] - 0.1) < 0.03 and abs(share["spm"] - 0.225) < 0.04
    assert infill.unit_ends("a" * 100_000 + " " * 100_000).tolist() == [100_000, 200_000]
