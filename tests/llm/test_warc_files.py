"""WARC archives against a plain computation, read back from the files."""

from __future__ import annotations

import base64
import hashlib

from lakegate.llm import token_files, warc


def test_archives_round_trip(spark):
    rows = [(1, "http://a/1", "<p>one</p>"), (2, "http://a/2", "<p>one</p>"), (3, "http://a/3", None), (4, "http://a/4", ""), (5, "http://a/5", "é" * 50_000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    folder = token_files.new_folder(spark, "test-warc")
    warc.write_warc(pages, folder)
    got = warc.read_warc(spark.read.parquet(f"{folder}/index"), with_payload=False).collect()
    want = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        last = max(i for i, _, h in rows if (h or "") == (html or ""))
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        kind = ("response", None) if page_id == last else ("revisit", last)
        want.append((page_id, len(payload), digest, *kind))
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(tuple(g[c] for c in columns) for g in got) == want
