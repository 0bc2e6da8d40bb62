import random
import re

import numpy as np
from propweave.llm import ngram_join as nj


def brute(rows):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), t or ""))
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) or (frozenset([tuple(w)]) if w else frozenset())
    comp = {i: i for i in sets}

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i
    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                p, q = root(a), root(b)
                comp[max(p, q)] = min(p, q)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in nj.near_duplicate_classes(df).collect()}
    assert got == brute(rows)


def test_brute_force(spark, monkeypatch):
    monkeypatch.setattr(nj, "BLOCK", 8)
    r = random.Random(3)
    word = lambda: r.choice(["the", "of", "on", *(f"w{k}" for k in range(40))])
    base = [[word() for _ in range(r.choice([3, 5, 8, 30, 80, 150]))] for _ in range(25)]
    rows, shared = [], [word() for _ in range(60)]
    for k in range(220):
        w = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 1, 2, 3])):
            w[r.randrange(len(w))] = word()
        if r.random() < 0.2:
            w = w + shared
        rows.append((k, " ".join(w).upper() if r.random() < 0.2 else "  ".join(w)))
    rows += [(1000, None), (1001, ""), (1002, " \n "), (1003, "a b c d"), (1004, "a b c d"), (1005, "a b c"), (1006, "É é e x")]
    check(spark, rows)


def test_chain_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(nj, "BLOCK", 4)
    w, rows = [f"x{k}" for k in range(120)], []
    for k in range(40):  # neighbours link, far ones don't
        rows.append((k, " ".join(w)))
        w[(k * 13) % 120] = f"y{k}"
    random.Random(1).shuffle(rows)
    check(spark, [(i, t) for i, t in rows])


def test_edges(spark):
    schema = "doc_id long, text string, component_id string, n long, token string"
    df = spark.createDataFrame([(None, "a b c d e f", "x", 1, "y"), (5, "a b c d e f", None, 2, None), (5, "a b c d e f", None, 2, None), (4, "q r s", "x", 3, "z")], schema)
    got = sorted((x.doc_id or 0, x.n_shingles, x.component_id) for x in nj.near_duplicate_classes(df).collect())
    assert got == [(0, 2, None), (4, 1, 4), (5, 2, 5), (5, 2, 5)]
    assert nj.near_duplicate_classes(df.limit(0)).count() == 0
    assert nj.keep_one(df).columns == df.columns and nj.keep_one(df).count() == 4


def test_bound_is_never_below_the_overlap():
    r = np.random.default_rng(0)
    for _ in range(50):
        a, b = (np.unique(r.integers(0, 3000, r.integers(1, 2500)).astype(np.uint64) << np.uint64(40)) for _ in range(2))
        assert nj.most_shared(*(np.frombuffer(nj.bitmap(x), np.uint64) for x in (a, b)), len(a), len(b)) >= len(np.intersect1d(a, b))
        maps = [np.frombuffer(nj.bitmap(x), np.uint64) for x in (a, b)]
        words = min(map(len, maps))
        t = [nj.Tree(np.array([len(x)]), nj.folded(m, words)[None], np.array([k])) for k, (x, m) in enumerate(zip((a, b), maps))]
        linked = 100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b))
        z = np.zeros(1, np.int64)
        assert not linked or nj.possible(t[0], 0, z, t[1], 0, z)[0]


def test_sql(spark):
    import duckdb
    d = "/root/testdata/sf0.001"
    c = duckdb.connect()
    c.sql(f"create view documents as select * from '{d}/documents.parquet'")
    assert sorted(map(tuple, nj.op8_ngram_join(spark, d).collect())) == sorted(c.sql(nj.SQL).fetchall())


def test_near_copies_of_all_texts_of_an_id(spark):
    """Each text of a repeated doc_id is searched, also where the id is the smallest of several texts."""
    r = random.Random(6)
    texts = [[f"{k}x{r.randrange(10**6)}" for _ in range(60)] for k in range(4)]
    near = lambda w: " ".join([*w[:-1], "other"])
    rows = [(1, " ".join(w)) for w in texts] + [(10 + k, near(w)) for k, w in enumerate(texts)] + [(30, "nothing like these at all")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: x.component_id for x in nj.near_duplicate_classes(df).collect()}
    assert got == {1: 1, 10: 1, 11: 1, 12: 1, 13: 1, 30: 30}


def test_clashing_columns_and_repeated_rows(spark):
    """Columns with the names that the operator uses; a row that is there a hundred times; a very long text."""
    w = [f"w{k}" for k in range(60)]
    long = [f"v{k}" for k in range(30_000)]
    rows = [(1, " ".join(w))] * 100 + [(2, " ".join([*w[:-1], "x"])), (3, " ".join([*w[:40], "y"])), (4, " ".join(long)), (5, " ".join([*long[:-100], "z"]))]
    df = spark.createDataFrame([(i, t, 7, 8, 9) for i, t in rows], "doc_id long, text string, __id long, id long, rep long")
    out = nj.keep_one(df)
    assert out.columns == df.columns and sorted(x.doc_id for x in out.collect()) == [1] * 100 + [3, 4]


def test_buckets_with_the_same_nodes(spark, monkeypatch):
    """Copies that share most shingles but link only to some: each set of nodes is searched once, no link is lost."""
    monkeypatch.setattr(nj, "BLOCK", 4)
    r = random.Random(12)
    w, rows = [f"x{k}" for k in range(200)], []
    for k in range(30):
        own = list(w)
        at = r.randrange(150)
        for p in range(at, at + 3 * (k % 8)):
            own[p] = f"y{k}z{p}"
        rows.append((k, " ".join(own)))
    check(spark, rows)
