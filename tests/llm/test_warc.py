import gzip
import hashlib
import os

import duckdb
from propweave.llm import common, warc


def test_round_trip(spark, tmp_path):
    big = "x é" * 700
    rows = [(1, "u1", big), (2, "u2\r\nX: y", "small"), (3, None, "small"), (4, "u4", big), (5, "u5", None), (6, "u6", big + "z"), (7, "u7", ""), (None, "n", big), (8, "u8", big), (8, "u8", big), (9, "", "a\r\n\r\nb" * 400), (10, "long", "abc " * 1_000_000)]
    df = spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, digest string")
    files = []
    for k in range(2):
        folder = f"file://{tmp_path}/w{k}"
        manifest = warc.write(df, folder, shard=400)
        got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload).decode()) for r in warc.read(manifest, folder).collect()]
        want = []
        for page, _, html in rows:
            data = (html or "").encode()
            revisit = html == big and page not in (None, 8)
            want.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", 8 if revisit else None, None if revisit else html or ""))
        key = lambda x: (x[0] or 0, x[1])
        assert sorted(got, key=key) == sorted(want, key=key)
        names = sorted(x for x in os.listdir(f"{tmp_path}/w{k}") if x.endswith(".gz"))
        assert len(names) == manifest.count() > 1 and not os.listdir(f"{tmp_path}/w{k}/_temporary")
        files.append([(n, open(f"{tmp_path}/w{k}/{n}", "rb").read()) for n in names])
        assert all(gzip.decompress(x).startswith(b"WARC/1.1\r\n") for _, x in files[-1])
    assert files[0] == files[1]
    folder = f"file://{tmp_path}/none"
    assert warc.read(warc.write(df.limit(0), folder), folder).count() == 0


def test_sql(spark):
    d = "/root/testdata/sf0.01"
    c = duckdb.connect()
    c.sql(f"create view pages as select * from '{d}/pages.parquet'")
    assert sorted(map(tuple, warc.op2_warc(spark, d).collect())) == sorted(c.sql(warc.SQL).fetchall())
