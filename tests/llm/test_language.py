import zlib

import numpy as np
from propweave.llm import language


def test_codewords_are_far_apart():
    for n in (2, 3, 4, 5, 9, 40):
        c = language.codewords(n)
        d = (c[:, None] != c[None]).sum(2) + 1000 * np.eye(n)
        assert d.min() >= max(1, c.shape[1] // 4), n


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    rows = language.op4_language(spark, d).collect()
    held = [r for r in rows if r.held_out]
    right = np.mean([r.lang_pred == lang[r.doc_id] for r in held])
    print("accuracy", right, "ambiguous", np.mean([r.ambiguous for r in held]))
    assert len(rows) == len(lang) and right > 0.97 and all(0 <= r.score <= 1 for r in rows)


def test_edges(spark):
    rows = [(i, "the cat and the dog were there" if i % 2 else "der hund und die katze waren da", "en" if i % 2 else "de") for i in range(60)]
    rows += [(900, None, "en"), (901, "", "en"), (902, "12 !", None), (902, "12 !", None), (None, "the the", None), (903, "x" * 3_000_000, None)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, lang string, score string, held_out int")
    got = language.predicted(df).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows) and by[900].lang_pred == by[901].lang_pred == by[902].lang_pred == "und"
    assert all(by[i].lang_pred == ("en" if i % 2 else "de") for i in range(60)) and by[903].lang_pred in ("en", "de")
    assert language.predicted(df.limit(0)).count() == 0
    assert {r.lang_pred for r in language.predicted(df.where("lang is null")).collect()} == {"und"}


def plain_grams(text):
    """Counts of the n-grams, one after the other."""
    kept = [b if b >= 0x80 or ord("a") <= b <= ord("z") else 32 for b in f" {text.lower()} ".encode()]
    kept = [b for i, b in enumerate(kept) if not i or b != 32 or kept[i - 1] != 32]
    counts = np.zeros(language.SLOTS, np.int64)
    for n in (2, 3, 4):
        for i in range(len(kept) - n + 1):
            h = kept[i]
            for b in kept[i + 1 : i + n]:
                h = (h * 0x01000193 & 0xFFFFFFFF) ^ b
            h = (h ^ ((n - 1) * 0x9E3779B1 & 0xFFFFFFFF)) * 0x85EBCA6B & 0xFFFFFFFF
            counts[h >> 16] += 1
    return counts


def test_query_against_brute_force(spark):
    """Counts, margins and losses made one row and one language after the other; ties and the flag too."""
    d = "/root/testdata/sf0.001"
    rows = [r for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text", "lang").collect()]
    fold = lambda i: zlib.crc32(str(i).encode()) % 4
    counts = {}
    grams = {r.doc_id: plain_grams(r.text) for r in rows if r.text}
    for r in rows:
        if fold(r.doc_id) != 2 and r.text and r.lang:
            counts[r.lang] = counts.get(r.lang, 0) + grams[r.doc_id]
    model = language.Model(counts)
    margins = lambda x: (x.astype(np.float64) @ model.odds.astype(np.float64)) / max(1, x.sum())
    learned = sorted([(r.lang, list(margins(grams[r.doc_id]))) for r in rows if fold(r.doc_id) != 2 and r.text and r.lang])
    model.calibrate(np.array([m for _, m in learned]), [x for x, _ in learned])
    got = {r.doc_id: r for r in language.op4_language(spark, d).collect()}
    flags = 0
    for r in rows:
        if not r.text or not any(map(str.isalpha, r.text)):
            assert got[r.doc_id].lang_pred == "und" and got[r.doc_id].score == 0
            continue
        f = np.clip(model.scale * margins(grams[r.doc_id]) + model.offset, -30, 30)
        loss = [sum(w * np.log1p(np.exp(-(2 * bit - 1) * x)) for w, bit, x in zip(model.weight, code, f)) / model.weight.sum() for code in model.code]
        share = np.exp(-(np.array(loss) - min(loss)) * len(f))
        share /= share.sum()
        assert abs(got[r.doc_id].score - share.max()) < 1e-3
        if abs(share.max() - language.CLEAR) > 1e-3:
            assert got[r.doc_id].ambiguous == (share.max() < language.CLEAR)
        if np.sort(share)[-2] < share.max() - 1e-3:
            assert got[r.doc_id].lang_pred == model.langs[int(np.argmin(loss))]
        flags += got[r.doc_id].ambiguous
    assert len(got) == len(rows) and flags < len(rows) // 2


def test_mixed_text_is_ambiguous(spark):
    rows = [(i, "the cat and the dog were there" if i % 2 else "der hund und die katze waren da", "en" if i % 2 else "de") for i in range(60)]
    df = spark.createDataFrame(rows + [(700, "zzz", None), (701, rows[1][1], None)], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language.predicted(df).collect()}
    assert got[700].ambiguous and not got[701].ambiguous
