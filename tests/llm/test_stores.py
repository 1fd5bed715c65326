"""WARC packages and embedding links against plain versions."""

import base64
import gzip
import hashlib
import io
import json
import random
import zipfile

import numpy as np
import pytest

from screenmart.llm import embedding, warc_zip
from screenmart.llm.common import shared_path


def reader(data: bytes):
    return lambda offset, length: data[offset : offset + length]


def test_directory_of_plain_and_zip64_archives():
    plain = io.BytesIO()
    with zipfile.ZipFile(plain, "w") as z:
        z.writestr("a.txt", b"alpha")
        z.writestr("dir/b.bin", bytes(range(256)))
        with z.open("c.big", "w", force_zip64=True) as f:
            f.write(b"gamma")
        z.comment = b"a comment of some length"
    members = [("archive/data.warc.gz", b"payload" * 9), ("indexes/index.cdxj", b"")]
    for data in (plain.getvalue(), warc_zip.package(members)):
        read = reader(data)
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            assert z.testzip() is None
            want = {i.filename: z.read(i) for i in z.infolist()}
        found = warc_zip.directory(read, len(data))
        assert {m.name: read(warc_zip.data_offset(read, m), m.size) for m in found} == want


def test_directory_rejects_other_files():
    with pytest.raises(ValueError, match="ZIP"):
        warc_zip.directory(reader(b"x" * 99), 99)
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a", b"a" * 99)
    data = packed.getvalue()
    with pytest.raises(ValueError, match="stored"):
        warc_zip.data_offset(reader(data), warc_zip.directory(reader(data), len(data))[0])


def test_records_come_back(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(k, f"http://x/{k}", f"<p>{rng.randrange(12)}</p>" * rng.randint(1, 3)) for k in range(60)]
    rows += [(100, None, None), (101, "http://\n é", ""), (None, "u", "no id"), (None, "u", "no id"), (102, "u", "no id"), (5, rows[5][1], rows[5][2])]
    rows += [(200, "u", "long é" * 100_000)]
    monkeypatch.setattr(warc_zip, "PACKAGE_BYTES", 400)
    monkeypatch.setattr(warc_zip, "SLICE_BYTES", 200)
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as _n", "'x' as refers_to").repartition(3)
    for least in (0, 12):
        packages = warc_zip.write_packages(warc_zip.with_revisits(pages, least), shared_path(spark, "test_warc"))
        got = warc_zip.read_records(packages).collect()
        top = {}
        for i, _, html in rows:
            if i is not None:
                top[html or ""] = max(i, top.get(html or "", i))
        want = []
        for i, _, html in rows:
            raw = (html or "").encode()
            first = top.get(html or "")
            revisit = first is not None and i != first and len(raw) >= least
            digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
            want.append((i, "revisit" if revisit else "response", first if revisit else None, digest, len(raw), None if revisit else raw))
        assert sorted(((*tuple(r)[:5], None if r.payload is None else bytes(r.payload)) for r in got), key=str) == sorted(want, key=str)


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    packages = warc_zip.write_packages(warc_zip.with_revisits(pages), shared_path(spark, "test_warc"))
    assert warc_zip.read_records(packages).count() == 0


def links_plainly(rows, least):
    def usable(r):
        return r[0] is not None and r[1] and r[2] is not None and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])

    n, root = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    unit = [np.float32(r[1]).astype(float) / np.linalg.norm(np.float32(r[1]).astype(float)) if usable(r) else None for r in rows]
    for a in range(len(rows)):
        for b in range(a):
            if unit[a] is not None and unit[b] is not None and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= least:
                n[a] += 1
                n[b] += 1
                root[find(a)] = find(b)
    low = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            low[find(k)] = min(r[0], low.get(find(k), r[0]))
    return sorted(((r[0], n[k], low.get(find(k)), r[0] is not None and r[0] == low.get(find(k))) for k, r in enumerate(rows)), key=str)


def test_embedding_links(spark, monkeypatch):
    monkeypatch.setattr(embedding, "CHUNK", 40)  # many blocks
    rng = np.random.default_rng(3)
    base, rows = rng.standard_normal((12, 24)), []
    for k in range(300):
        v = base[rng.integers(12)] + rng.standard_normal(24) * rng.choice([0.02, 0.1, 0.14, 0.2, 1.0])
        rows.append((k, [float(x) for x in v.astype(np.float32)], int(rng.integers(2))))
    rows += [(1000 + k, rows[0][1], rows[0][2]) for k in range(9)] + [rows[7]]
    rows += [(2000, None, 1), (2001, [], 1), (2002, [0.0] * 24, 1), (2003, [float("nan")] * 24, 1), (2004, rows[3][1], None)]
    rows += [(2005, [None, *rows[3][1][1:]], 1), (2006, [1.0, 2.0], 1), (2007, [2.0, 4.0], 1), (None, rows[0][1], rows[0][2]), (2008, [1e30, 2e30], 1), (2009, [float("inf"), 1.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "7 as node", "8 as n_links").repartition(4)
    got = sorted((tuple(r) for r in embedding.near_duplicates(frame, 0.98).collect()), key=str)
    assert got == links_plainly(rows, 0.98) and sum(g[1] for g in got) > 500
    assert embedding.near_duplicates(frame.limit(0)).count() == 0


def test_collision_count_is_calibrated():
    rng, least = np.random.default_rng(2), embedding.least_collisions()
    inside = np.abs(rng.standard_normal((200_000, embedding.PROJECTIONS))) <= embedding.WINDOW_SIGMAS
    assert (inside.sum(axis=1) >= least).mean() > 0.9999
    assert least > embedding.PROJECTIONS / 2


def test_packages_of_others(spark, tmp_path):
    """Two archives under other names, a compressed index with a header line and an index as plain text."""
    records = [warc_zip.record(k, f"http://x/{k}", f"<p>{k}</p>".encode() * 3, None) for k in range(5)]
    first, second = records[:3], records[3:]
    lines, at = ["!meta {}"], 0
    for k, r in enumerate(first):
        lines.append(f"x,{k} 2020 " + json.dumps({"offset": str(at), "length": str(len(r)), "filename": "rec-a.warc.gz"}))
        at += len(r)
    at, other = 0, []
    for k, r in enumerate(second):
        other.append(f"x,{k} 2020 " + json.dumps({"offset": at, "length": len(r), "filename": "archive/rec-b.warc.gz"}))
        at += len(r)
    members = [
        ("archive/rec-a.warc.gz", b"".join(first)), ("deep/er/rec-b.warc.gz", b"".join(second)), ("pages/pages.jsonl", b"{}"),
        ("indexes/a.cdxj.gz", gzip.compress("\n".join(lines).encode())), ("indexes/b.cdxj", "\n".join(other).encode()),
    ]
    path = tmp_path / "theirs.wacz"
    path.write_bytes(warc_zip.package(members))
    packages = spark.createDataFrame([(f"file:{path}",)], "path string")
    got = {r.page_id: bytes(r.payload) for r in warc_zip.read_records(packages).collect()}
    assert got == {k: f"<p>{k}</p>".encode() * 3 for k in range(5)}
    with pytest.raises(ValueError, match="index"):
        data = warc_zip.package(members[:2])
        warc_zip.located(reader(data), len(data))
