import random
import sys

import numpy as np

from propweave.llm import tokens, toxicity


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_automaton_against_distances():
    r = random.Random(4)
    terms = {"".join(r.choice("abc") for _ in range(r.randrange(3, 8))): r.random() + 1 for _ in range(30)}
    stems = {"cabc*": 3.5, "bbba*": 4.0}
    lex = toxicity.FuzzyLexicon({**terms, **stems})
    for _ in range(3000):
        w = "".join(r.choice("abcd") for _ in range(r.randrange(1, 10)))
        want = max([t * (1 if w == k else 0.7) for k, t in terms.items() if w == k or len(k) >= 5 and distance(w, k) == 1] + [v for k, v in stems.items() if w.startswith(k[:-1]) and len(w) >= len(k)], default=0.0)
        assert abs(lex.weight(w) - want) < 1e-12, w


def test_quotation_is_told_from_abuse():
    w = toxicity.Weights(toxicity.FuzzyLexicon({"idiot": 4.0}))
    f = lambda t: toxicity.features(tokens.split(t), w)
    abuse, quote = f("you are an idiot and an id1ot too"), f('they wrote "you are an idiot" in a note')
    assert abuse[1] > 0 and abuse[4] == 0 and quote[1] == 0 and quote[4] > 0
    assert f("") [1] == 0 and f('"x" idiot')[1] > 0


def test_held_out_rows(spark):
    d = "/root/testdata/sf0.1"
    rows = {r.doc_id: r for r in toxicity.op5_toxicity(spark, d).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    held = [(rows[i].score, y, rows[i].predicted) for i, y in labels.items() if rows[i].held_out]
    pos, neg = [s for s, y, _ in held if y], [s for s, y, _ in held if not y]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg)
    found = sum(p for _, y, p in held if y) / len(pos)
    false = sum(p for _, y, p in held if not y) / len(neg)
    print("auc", auc, "found", found, "false", false)
    assert auc > 0.9 and found > 0.8 and false < 0.01


def test_query_against_plain_search(spark):
    """Scores from the fitted terms and coefficients, with each word held against each term by its distance."""
    d = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    source = docs.select("doc_id", "text", (toxicity.common.fold("doc_id", 5) == 0).alias("held_out"))
    terms, beta = toxicity.fit(source, labels) or ({"stupid": 3.0, "idio*": 2.0}, None)
    if beta is None:  # too few labels here: the automaton alone
        beta = np.array([-3.0, 1, 1, 0.5, 0.2, 1, 1])

    class Plain(dict):
        def __missing__(self, token):
            w = toxicity.normal(token)
            near = lambda k: len(k) >= 5 and abs(len(k) - len(w)) < 2 and distance(w, k) <= 1
            self[token] = max([t * (1 if w == k else 0.7) for k, t in terms.items() if not k.endswith("*") and (w == k or near(k))] + [t for k, t in terms.items() if k.endswith("*") and w.startswith(k[:-1]) and len(w) >= len(k)], default=0.0)
            return self[token]

    plain, fast = Plain(), toxicity.Weights(toxicity.FuzzyLexicon(terms))
    rows = docs.collect()
    for r in rows[:60]:
        words = tokens.split(r.text)
        assert np.allclose(toxicity.features(words, plain), toxicity.features(words, fast))
    got = {r.doc_id: r for r in toxicity.scored(docs, labels).collect()}
    if toxicity.fit(source, labels):
        for r in rows[:60]:
            p = 1 / (1 + np.exp(-toxicity.features(tokens.split(r.text), plain) @ beta))
            assert abs(got[r.doc_id].score - p) < 1e-9 and got[r.doc_id].predicted == int(p >= 0.5)


def test_ties_and_long_texts(spark):
    """Labels that contradict each other, a word of 200,000 characters, a text of 100,000 words with one bad one at its end."""
    bad, good = "you are a stupid stupid fool today", "a fine day it is my friend"
    rows = [(i, bad if i % 4 == 0 else good) for i in range(400)] + [(901, "x" * 200_000), (902, "fine " * 100_000 + bad), (903, good)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(3, 0), (3, 0)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.scored(docs, labels).collect()}
    assert got[901].predicted == 0 and got[903].predicted == 0 and got[902].score > got[903].score


def test_edges(spark):
    bad, good = "you are a stupid stupid fool today", "a fine day it is my friend"
    rows = [(i, bad if i % 4 == 0 else good) for i in range(400)] + [(900, None), (901, ""), (None, "stupid"), (900, None), (902, "stupyd " * 3)]
    docs = spark.createDataFrame([(i, t, "x", i) for i, t in rows], "doc_id long, text string, score string, label long")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    out = toxicity.flagged(docs, labels)
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect() if r.doc_id is not None) == sorted([i for i in range(400) if i % 4] + [900, 900, 901])
    assert toxicity.scored(docs.limit(0), labels).count() == 0
    assert {r.score for r in toxicity.scored(docs, labels.limit(0)).collect()} == {0.0}


def test_all_labelled_rows_count(spark):
    """A word only in those of 9000 labelled rows whose ids have the largest hashes; weights against plain counts."""
    ids = [r.id for r in spark.range(11_300).orderBy(toxicity.F.xxhash64("id")).collect()]
    folds = {r.id: r.f for r in spark.range(11_300).select("id", toxicity.common.fold("id", 5).alias("f")).collect()}
    bad = set(ids[-300:])
    rows = [(i, "you are a zorgleton today" if i in bad else f"a fine day it is my friend number{i % 7}") for i in ids] + [(20_000, "what a zorgleton"), (20_001, "what a day")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i in bad)) for i in ids], "doc_id long, toxic int")
    assert sum(folds[i] != 0 for i in ids) > 8_999
    terms, _ = toxicity.fit(docs.withColumn("held_out", toxicity.common.fold("doc_id", 5) == 0), labels)
    x = sum(folds[i] != 0 for i in bad)
    n0 = sum(folds[i] != 0 for i in ids) - x
    assert abs(terms["zorgleton"] - np.log((x + 0.5) / (x + 1)) + np.log(0.5 / (n0 + 1))) < 1e-9
    got = {r.doc_id: r.predicted for r in toxicity.scored(docs, labels).collect()}
    assert got[20_000] == 1 and got[20_001] == 0


def test_states_are_small():
    """A large lexicon's states take a few bytes for each node that they reach."""
    r = random.Random(5)
    lex = toxicity.FuzzyLexicon({"".join(r.choice("abcdefgh") for _ in range(8)): 2.0 for _ in range(3000)})
    for _ in range(300):
        lex.weight("".join(r.choice("abcdefgh") for _ in range(8)))
    held = sum(map(sys.getsizeof, lex.sets)) + sum(sys.getsizeof(x) for s in lex.sets if not isinstance(s, bytes) for x in s)
    reached = sum(len(s) // 4 if isinstance(s, bytes) else len(s) for s in lex.sets)
    assert reached > 10 * len(lex.sets) and held < 12 * reached
