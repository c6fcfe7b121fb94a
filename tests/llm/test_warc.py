import base64
import gzip
import glob
import hashlib
from collections import defaultdict

import pytest

from voxlens.llm.warc import parse, payload_table, read_archives, resolve_revisits, write_archives
from voxlens.session import fresh_path


def run(spark, pages, **options):
    raw, clean = fresh_path(spark, "warc"), fresh_path(spark, "warc")
    write_archives(pages, raw)
    resolve_revisits(spark, raw, clean, **options)
    return clean, sorted((tuple(r) for r in payload_table(spark, clean).collect()), key=repr)


def brute(rows, least=0):
    groups, out = defaultdict(list), []
    for i, html in rows:
        groups[(html or "").encode()].append(i)
    for payload, ids in groups.items():
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        first = min((i for i in ids if i is not None), default=None)
        open_ = True
        for i in sorted(ids, key=lambda i: (i is None, i)):
            response = open_ or len(payload) < least
            out.append((i, len(payload), digest, "response" if response else "revisit", None if response else first))
            open_ = False
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def odd(spark):
    page = "é\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"
    return spark.createDataFrame([
        (1, "u", page, 9), (2, None, None, 1), (3, "a\r\nX: b", "", 2), (4, "u", page, 2), (5, "", page, 2), (5, "", page, 2),
        (None, "", page, 2), (6, "u", "x" * 300000, 2),
    ], "page_id bigint, url string, html string, digest int")


def test_given_pages(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    twice = pages.union(pages.withColumn("page_id", pages.page_id + 10**6))
    assert run(spark, twice)[1] == brute([(r.page_id, r.html) for r in twice.collect()])


def test_odd_pages(spark, odd):
    rows = [(r.page_id, r.html) for r in odd.collect()]
    clean, got = run(spark, odd)
    assert got == brute(rows)
    assert run(spark, odd, min_bytes=1)[1] == brute(rows, 1)
    assert run(spark, odd.limit(0))[1] == []
    headers = [h for f in glob.glob(f"{clean.removeprefix('file:')}/part-*") for h, _ in parse(gzip.open(f).read())]
    ids = {h["warc-record-id"] for h in headers if h["warc-type"] == "response"}
    revisits = [h for h in headers if h["warc-type"] == "revisit"]
    assert revisits and all(h["warc-refers-to"] in ids and h["warc-profile"].endswith("identical-payload-digest") for h in revisits)
    assert all("x" not in h for h in headers)  # the line break in an address makes no header


def test_a_changed_payload_is_noticed(spark, odd):
    path = fresh_path(spark, "warc")
    write_archives(odd, path)
    name = max(glob.glob(f"{path.removeprefix('file:')}/part-*"), key=lambda f: len(open(f, "rb").read()))
    data = gzip.open(name).read()
    with gzip.open(name, "wb") as f:
        f.write(data.replace(b"xxxx", b"yyyy").replace(b"W", b"W"))
    with pytest.raises(Exception):
        read_archives(spark, path).collect()
