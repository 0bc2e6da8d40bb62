import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from propweave.llm import bpe

PATH = bpe.default_path()


@pytest.fixture(scope="module")
def oracle():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_same_ids_as_the_library(oracle):
    r = random.Random(7)
    texts = ["", " ", "\n\n", "it's  we'll ''s 's's 'really x''d \n'm", "a" * 5000, "!" * 3000 + " 'tis", "Grüße 123 漢字　x y  z", "it's\t\n 'll", "\x1c \x85x"]
    texts += ["".join(r.choice(["a", "B", "s", "t", "re", "ll", "'", "'", " ", "  ", "\n", "1", "é", "!", " ", "漢", "😀", "\U0010ffff"]) for _ in range(r.randrange(80))) for _ in range(3000)]
    for text, ids in zip(texts, bpe.encode_texts(texts, PATH), strict=True):
        assert ids.tolist() == oracle.encode_ordinary(text), text


def test_every_assigned_code_point_is_classed_alike(oracle):
    import unicodedata
    texts = ["a" + chr(c) + "1" + chr(c) + " " + chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) != "Cn"]
    wrong = [t for t, ids in zip(texts, bpe.encode_texts(texts, PATH), strict=True) if ids.tolist() != oracle.encode_ordinary(t)]
    assert not wrong, [hex(ord(t[1])) for t in wrong[:20]]


def test_short_and_long_merging_agree():
    m = bpe.Merger(PATH)
    r = random.Random(1)
    for _ in range(300):
        piece = bytes(r.choice(b"thern an\xc3\xa9") for _ in range(r.randrange(1, 60)))
        assert m.short(piece) == m.long(piece)


def test_frames(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", None), (3, "it's", "x"), (3, "it's", "x")], "doc_id long, text string, ids string")
    rows = sorted(bpe.decode(bpe.encode(df, PATH), PATH).collect())
    assert [(x.doc_id, x.n_tokens, bytes(x.decoded)) for x in rows] == [(1, 0, b""), (2, 0, b""), (3, 2, b"it's"), (3, 2, b"it's")]
    assert bpe.encode(df.limit(0), PATH).count() == 0


def test_query_against_the_library(spark, oracle):
    got = {x.doc_id: x for x in bpe.op3_byte_bpe(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = oracle.encode_ordinary(d.text or "")
        assert got[d.doc_id].n_tokens == len(ids)
        assert got[d.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[d.doc_id].decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()
