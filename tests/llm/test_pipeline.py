import base64

import corpus_pipeline
import numpy as np
import public_tokenizers
import test_line_dedup
import test_ngram_join
import tiktoken
from propweave.llm import bpe, common, line_dedup, toxicity
from propweave.llm import decontamination as dc

D = "/root/testdata/sf0.001"


def test_each_stage_against_brute_force(spark):
    docs = common.table(spark, D, "documents")
    columns = docs.columns
    rows = {r.doc_id: r.text for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "byte-level BPE"]

    def step(name, df):
        out = common.cut(stages[name](spark, df, D), "stage")
        return out, {r.doc_id: r.text for r in out.collect()} if "text" in out.columns else None

    labels = common.table(spark, D, "labels")
    want = {r.doc_id for r in toxicity.scored(docs, labels).collect() if not r.predicted}
    df, got = step("toxicity", docs)
    assert df.columns == columns and got == {i: rows[i] for i in want}

    want = test_line_dedup.brute(sorted(got.items()))
    df, got = step("line dedup", df)
    assert df.columns == columns and got == want
    sizes = {r.doc_id: r.n_chars for r in df.collect()}
    assert all(sizes[i] == len(t) for i, t in got.items() if t != rows[i])

    want = test_ngram_join.brute(sorted(got.items()))
    before = got
    df, got = step("n-gram Jaccard join", df)
    assert df.columns == columns and got == {i: before[i] for i, (_, c) in want.items() if i == c}

    before = got
    df, got = step("benchmark decontamination", df)
    items = [(r.item_id, dc.clean_words(r.text)) for r in common.table(spark, D, "benchmark").collect()]
    answers = {k: dc.tokens.split(" ".join(map(bytes.decode, dc.answer(r.text)))) for k, r in enumerate(common.table(spark, D, "benchmark").collect())}
    leaked, possible = set(), set()  # what must go, and what may: windows at every word, paraphrases with the answer
    for i, t in before.items():
        w = dc.clean_words(t)
        for k, (_, q) in enumerate(items):
            reach, places = len(q) * 3 // 2 + 1, dc.bits_of(q)
            for a in range(0, max(1, len(w) - len(q) // 2)):
                n = dc.lcs(len(q), w[a : a + reach], places) if i not in leaked else 0
                if n >= dc.COPY * len(q):
                    leaked.add(i)
                elif n >= dc.PARAPHRASE * len(q) and answers[k] and dc.lcs(len(answers[k]), w[a : a + reach], dc.bits_of(answers[k])) >= dc.ANSWER * len(answers[k]):
                    possible.add(i)
    gone = set(before) - set(got)
    assert df.columns == columns and leaked and len(gone & leaked) >= 0.9 * len(leaked)
    assert gone <= leaked | possible

    out = stages["byte-level BPE"](spark, df, D).collect()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(bpe.default_path(), "rb"))}
    oracle = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in out} == {i: oracle.encode_ordinary(t or "") for i, t in got.items()}


def test_columns_survive(spark):
    rows = [(1, "a b c d e f\nx", "en", "s", 13, "q"), (2, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, predicted string")
    assert line_dedup.dedup_documents(df).columns == df.columns and line_dedup.dedup_documents(df).count() == 2


def test_odd_rows_through_all_stages(spark):
    """Null and empty texts, a null id, repeated rows, a very long text, extra columns with the operators' names; then none."""
    long = " ".join(f"w{k}" for k in range(40_000))
    texts = [(1, "a b c d e f g h\nx y"), (2, None), (3, ""), (None, "of no id at all, is it"), (4, "a text that is there twice in the table"), (4, "a text that is there twice in the table"), (5, long), (6, long + " more")]
    rows = [(i, t, "en", "s", None if t is None else len(t), "q", 0.5, 1, 2, 3, [4]) for i, t in texts]
    schema = "doc_id long, text string, lang string, source string, n_chars long, predicted string, score double, held_out int, id long, __id long, __lines array<long>"
    docs = df = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        df = common.cut(stage(spark, df, D), "stage")
        assert df.columns == docs.columns, name
    left = df.collect()
    assert sorted((r.doc_id or 0, r.text if r.doc_id != 5 else "") for r in left) == [(0, texts[3][1]), (1, texts[0][1]), (2, None), (3, ""), (4, texts[4][1]), (4, texts[4][1]), (5, ""), (6, "")]  # the last one's only line is like an earlier one
    assert all((r.predicted, r.score, r.held_out, r.id, r["__id"], r["__lines"]) == ("q", 0.5, 1, 2, 3, [4]) for r in left)
    assert corpus_pipeline.STAGES[-1][1](spark, df, D).count() == len(left)
    df = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        df = common.cut(stage(spark, df, D), "stage")
    assert df.columns == docs.columns and corpus_pipeline.STAGES[-1][1](spark, df, D).count() == 0
