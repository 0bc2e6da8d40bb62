import re
import random
from collections import Counter

import duckdb
from propweave.llm import quality
from pyspark.sql import functions as F


def brute(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    g = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    c = Counter(g)
    rep = {i + k for i, x in enumerate(g) if c[x] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t), len(lines) - len(set(lines)), len(rep)


def test_measures(spark):
    r = random.Random(2)
    texts = [None, "", " \n\t", "a", "a b c a b c", "a a a a", "x\n\nx\n \ny\nx \u0085  ", "é$ # 漢\n" * 40, "q" * 100000]
    texts += ["".join(r.choice(["a", "b", "c", "dd", " ", " ", "\n", "\x0b", "#", "|"]) for _ in range(r.randrange(400))) for _ in range(200)]
    df = spark.createDataFrame([(i, t, None if i % 3 else "h", "z") for i, t in enumerate(texts)], "doc_id long, text string, source string, host string")
    got = {x.doc_id: x for x in quality.judged(df).collect()}
    for i, t in enumerate(texts):
        x = got[i]
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == brute(t), t
    assert quality.judged(df.limit(0)).count() == 0
    assert quality.judged(df.union(df)).count() == 2 * len(texts)


def test_a_bad_host_takes_its_documents_along(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, good if i % 10 == 0 or i >= 100 else "short", "bad" if i < 100 else f"h{i % 9}") for i in range(400)]
    rows += [(1000, good, None), (1001, "short", None)]
    got = {x.doc_id: x.kept for x in quality.judged(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert not any(got[i] for i in range(100)) and all(got[i] for i in range(100, 400)) and got[1000] and not got[1001]


def test_sql(spark):
    d = "/root/testdata/sf0.001"
    c = duckdb.connect()
    c.sql(f"create view documents as select * from '{d}/documents.parquet'")
    want = sorted(c.sql(quality.SQL).fetchall())
    assert sorted(map(tuple, quality.op9_host_rules(spark, d).collect())) == want


def test_windows_whose_hashes_collide_are_compared_as_words(spark, monkeypatch):
    """With hashes of 4 bits nearly all windows collide."""
    monkeypatch.setattr(quality, "HASH_BITS", 4)
    r = random.Random(3)
    texts = [" ".join(r.choice(["a", "b", "cc", "d", "e"]) for _ in range(r.randrange(60))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("source", F.lit("x"))
    assert {x.doc_id: x.n_repeat_words for x in quality.measures(df).collect()} == {i: brute(t)[4] for i, t in enumerate(texts)}
