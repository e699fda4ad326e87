"""WARC round trips, salvage of damaged archives, and nearest neighbours."""

import base64
import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from adstream.llm import nearest, warc
from adstream.llm.common import scratch

PAGES = [
    (3, "http://a/", "<p>same</p>"), (1, "http://b/\r\nX: y", "<p>same</p>"), (1, "http://b/", "<p>same</p>"),
    (7, None, None), (8, "http://c/", ""), (9, "http://d/", "é WARC/1.1\r\n\r\n" * 50), (None, "http://e/", "x"),
    (None, "http://f/", "x"), (10, "http://g/", "z" * 3_000_000),
]


def pages(spark, rows=PAGES):
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("sha1", F.lit(1))


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.mark.parametrize("compress", [True, False])
def test_round_trip(spark, compress):
    manifest = warc.write_archives(pages(spark), scratch(spark, "w"), compress=compress, archive_bytes=600)
    rows = warc.read_archives(manifest).collect()
    assert not [r for r in rows if r.gap]
    first = {}
    for page, _, html in PAGES:
        if page is not None:
            first[html or ""] = min(page, first.get(html or "", page))
    expected = Counter()
    for page, _, html in PAGES:
        own = first.get(html or "")
        refers = None if own == page else own
        expected[page, len((html or "").encode()), digest(html), "revisit" if refers is not None else "response", refers] += 1
    number = lambda uri: int(uri[10:-1]) if uri and uri != "<urn:page:>" else None
    got = Counter(
        (number(r.record_id), r.payload_bytes, r.payload_digest, r.record_type, number(r.refers_to)) for r in rows
    )
    assert got == expected
    assert {bytes(r.payload).decode() for r in rows if r.record_type == "response"} == {h or "" for _, _, h in PAGES}
    empty = warc.round_trip(spark, pages(spark, []))
    assert empty.count() == 0


def test_small_payloads_are_all_responses(spark):
    manifest = warc.write_archives(pages(spark), scratch(spark, "w"), revisit_from=1000)
    assert {r.record_type for r in warc.read_archives(manifest, payloads=False).collect()} == {"response"}


@pytest.mark.parametrize("compress", [True, False])
def test_salvage(tmp_path, compress):
    rng = random.Random(1)
    records = [warc.page_record(i, "http://x/", rng.randbytes(rng.randint(0, 900)), None, "2024-01-01T00:00:00Z") for i in range(30)]
    packed = [warc.member(r) if compress else r for r in records]
    starts = np.cumsum([0, *map(len, packed)]).tolist()

    def read(data):
        (tmp_path / "a").write_bytes(data)
        system, name = warc.file_system(str(tmp_path / "a"))
        with system.open_input_file(name) as file:
            rows = list(warc.salvage(file))
        # Records and gaps cover the file.
        assert [r["start"] for r in rows] == [0, *(r["end"] for r in rows[:-1])] and rows[-1]["end"] == len(data)
        return [r["record_id"] for r in rows if "gap" not in r], [(r["start"], r["end"]) for r in rows if "gap" in r]

    whole = b"".join(packed)
    names = [f"<urn:page:{i}>" for i in range(30)]
    assert read(whole) == (names, [])
    for broken in (0, 7, 29):
        damaged = bytearray(whole)
        at = starts[broken] + len(packed[broken]) // 2
        damaged[at : at + 4] = bytes(b ^ 0x55 for b in damaged[at : at + 4])
        found, gaps = read(bytes(damaged))
        assert found == names[:broken] + names[broken + 1 :]
        assert gaps == [(starts[broken], starts[broken + 1])]
    assert read(whole[:-5]) == (names[:-1], [(starts[29], len(whole) - 5)])
    # Cut out in the middle of one record: that one is lost, and nothing after it.
    hole = whole[: starts[4] + 10] + whole[starts[6] :]
    assert read(hole) == (names[:4] + names[6:], [(starts[4], starts[4] + 10)])
    found, gaps = read(b"junk" * 100 + whole)
    assert found == names and gaps == [(0, 400)]


def test_nearest(spark):
    rng = np.random.default_rng(3)
    vectors = np.round(rng.normal(size=(700, 12)), 1).astype(np.float32)
    vectors[50:60] = vectors[0]  # ties
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    odd = [(700, None), (701, [0.0] * 12), (702, [float("nan")] * 12), (710, [1.0, 2.0]), (None, rows[0][1]), (720, [None] + [1.0] * 11), (5, rows[5][1])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumn("score", F.lit(0)).repartition(3)
    x = np.array([r[1] for r in rows] + [rows[5][1]], float)
    ids = np.array([r[0] for r in rows] + [5])
    expected = {}
    for q in range(0, 700, 10):
        d = np.sqrt(np.add.accumulate((x - x[q]) ** 2, axis=1)[:, -1])
        order = [i for i in np.lexsort((ids, d)) if ids[i] != q][:10]
        expected[q] = [(k + 1, int(ids[i]), float(d[i])) for k, i in enumerate(order)]
    for block in (4096, 16):
        got = {}
        for r in nearest.nearest(df, F.col("vec_id") % 10 == 0, block=block).collect():
            got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
        assert {q: sorted(v) for q, v in got.items()} == expected
    assert nearest.nearest(df.limit(0), F.lit(True)).count() == 0
    few = nearest.nearest(df.where("vec_id < 3 OR vec_id = 710"), F.lit(True)).collect()
    assert Counter(r.query_id for r in few) == {0: 2, 1: 2, 2: 2}


def test_huge_components_keep_their_neighbours(spark):
    rows = [(0, [1e200, 0.0]), (1, [1e200, 3e199]), (2, [-1e200, 0.0]), (3, [1e-3, 1e300]), (4, None)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r.rank, r.vec_id, r.score) for r in nearest.nearest(frame, F.col("vec_id") == 0).orderBy("rank").collect()]
    assert [g[:2] for g in got] == [(1, 1), (2, 2), (3, 3)]
    assert [g[2] for g in got] == pytest.approx([3e199, 2e200, 1e300])


def third_party(kind, block, *more):
    headers = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:{len(block)}>"), *more]
    return warc.record_bytes(headers, block)


@pytest.mark.parametrize("compress", [True, False])
def test_archives_of_other_writers(tmp_path, compress):
    body = b"<p>page</p>\r\n\r\nmore"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"
    chunked = b"5\r\nhello\r\n6;x=y\r\n world\r\n0\r\n\r\n"
    sha1, sha256 = hashlib.sha1, hashlib.sha256
    b32 = lambda h: base64.b32encode(h.digest()).decode()
    http_type = ("Content-Type", "application/http; msgtype=response")
    records = [
        third_party("warcinfo", b"software: x\r\n", ("Content-Type", "application/warc-fields")),
        third_party("response", http + body, http_type, ("WARC-Payload-Digest", f"sha1:{b32(sha1(body))}"),
                    ("WARC-Block-Digest", f"sha256:{sha256(http + body).hexdigest()}")),
        third_party("response", http + chunked, http_type, ("WARC-Payload-Digest", f"SHA-256:{sha256(b'hello world').hexdigest()}")),
        third_party("response", http + body, http_type, ("WARC-Payload-Digest", f"md5:{hashlib.md5(http + body).hexdigest()}")),
        third_party("resource", body, ("WARC-Payload-Digest", "blake9:abc"), ("X-Long", "y" * 200_000)),
        third_party("resource", body).replace(b"WARC-Record-ID: <", b"WARC-Record-ID:\r\n\t<"),
    ]
    bad = third_party("resource", body, ("WARC-Block-Digest", f"sha1:{b32(sha1(b'other'))}"))
    path = tmp_path / "other.warc"
    path.write_bytes(b"".join(warc.member(r) if compress else r for r in [*records, bad]))
    system, name = warc.file_system(str(path))
    with system.open_input_file(name) as file:
        rows = list(warc.salvage(file))
    assert [r.get("gap") for r in rows] == [None] * len(records) + ["block digest differs"]
    assert [r["payload"] for r in rows[1:-1]] == [body, chunked, body, body, body]
    assert rows[-2]["record_id"] == f"<urn:{len(body)}>"


def test_a_lost_record_is_an_error(spark):
    manifest = warc.write_archives(pages(spark), scratch(spark, "w"))
    assert warc.read_archives(manifest, whole=True).count() == len(PAGES)
    with pytest.raises(Exception, match="records instead of"):
        warc.read_archives(manifest.withColumn("n_records", F.col("n_records") + 1), whole=True).count()
