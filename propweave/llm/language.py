"""Language identification by error-correcting output codes (operator 4).

Each learned language has a codeword of BITS bits.  For each bit a binary n-gram classifier tells the
languages with a 1 from those with a 0: a naive Bayes log odds over hashed byte n-grams (2 to 4
bytes, words padded with blanks), averaged over the n-grams of the whole text.  Counts of n-grams by
language come from all learning rows, in tables of fixed size; scale, offset and weight of each bit are fitted
on at most SAMPLE learning rows, those with the smallest hashes of doc_id.  Decoding adds up each
codeword's weighted logistic loss and takes the least; near ties are flagged as ambiguous.

Defined results: null texts, and texts without a letter, are `und` with score 0; with no learned language every
row is; equal losses go to the language first in order; repeated rows score alike; very long texts are read
whole; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propweave.llm import common

SLOTS = 1 << 16
#: Parts of a language's table, summed apart, so that a language with most of the rows is many tasks.
SLICES = 32
SAMPLE = 4000
#: Bytes of a text taken into n-grams at once; the whole text is taken, in blocks.
BLOCK = 1 << 20
SMOOTH = 0.5
#: A best share below this is ambiguous.
CLEAR = 0.8


def grams(text: str) -> np.ndarray:
    """Occurrences of each n-gram slot in the text: lower-cased letters, anything else a blank."""
    counts = np.zeros(SLOTS, np.int64)
    # str.lower() keeps the letters; other characters part words
    data = np.frombuffer(f" {text.lower()} ".encode(), np.uint8)
    keep = (data >= 0x80) | (data >= ord("a")) & (data <= ord("z"))
    data = np.where(keep, data, 32).astype(np.uint32)
    data = data[np.concatenate([[True], (data[1:] != 32) | (data[:-1] != 32)])]
    for s in range(0, len(data), BLOCK):
        part = data[s : s + BLOCK + 3]
        n = min(BLOCK, len(part))
        h = part.copy()
        for k in range(1, 4):
            h = (h[:-1] * np.uint32(0x01000193)) ^ part[k:]
            own = h[:n]
            mixed = (own ^ np.uint32(k * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
            counts += np.bincount(mixed >> np.uint32(16), None, SLOTS)
    return counts


def codewords(n: int) -> np.ndarray:
    """n codewords: all different splits for up to five languages, then random ones, far apart."""
    if n <= 1:
        return np.ones((n, 1), np.int64)
    if n <= 5:
        return np.array([[1 if i == 0 else (b >> (i - 1)) & 1 for b in range(2 ** (n - 1) - 1)] for i in range(n)])
    bits = max(15, int(np.ceil(10 * np.log2(n))))
    r, best, far = np.random.default_rng(n), None, -1
    for _ in range(200):
        code = r.integers(0, 2, (n, bits))
        code[:, code.sum(0) % n == 0] = (np.arange(n) % 2)[:, None]
        d = (code[:, None] != code[None]).sum(2) + bits * np.eye(n, dtype=np.int64)
        if d.min() > far:
            best, far = code, d.min()
    return best


def _gram_counts(learn: DataFrame) -> dict[str, np.ndarray]:
    """Summed n-gram counts by language; partial sums before the shuffle, SLICES rows a language after."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if text:
                    sums[lang] = sums.get(lang, 0) + grams(text)
        for lang, x in sums.items():
            parts = [own.astype("<i8").tobytes() for own in x.reshape(SLICES, -1)]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * SLICES), pa.array(range(SLICES), pa.int32()), pa.array(parts, pa.binary())], ["lang", "k", "x"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, None
        out = lambda: pa.RecordBatch.from_arrays([pa.array([at[0]]), pa.array([at[1]], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["lang", "k", "x"])
        for batch in batches:
            for *key, x in zip(*(c.to_pylist() for c in batch.columns)):
                if key != at:
                    if at is not None:
                        yield out()
                    at, total = key, np.zeros(SLOTS // SLICES, np.int64)
                total += np.frombuffer(x, "<i8")
        if at is not None:
            yield out()

    kind = "lang string, k int, x binary"
    sums = learn.select("text", "lang").mapInArrow(run, kind).repartition("lang", "k").sortWithinPartitions("lang", "k").mapInArrow(add, kind)
    found: dict[str, np.ndarray] = {}
    for r in sums.collect():  # one row for each language and slice
        found.setdefault(r.lang, np.zeros((SLICES, SLOTS // SLICES), np.int64))[r.k] = np.frombuffer(r.x, "<i8")
    return {lang: x.ravel() for lang, x in found.items()}


class Model:
    def __init__(self, counts: dict[str, np.ndarray]):
        self.langs = sorted(counts)
        n = len(self.langs)
        self.code = codewords(n)
        # each language weighs the same in the classifiers
        p = np.array([(counts[x] + SMOOTH) / (counts[x].sum() + SMOOTH * SLOTS) for x in self.langs]) if n else np.zeros((0, SLOTS))
        self.odds = np.stack([np.log(p[c == 1].mean(0)) - np.log(p[c == 0].mean(0)) if 0 < c.sum() < n else np.zeros(SLOTS) for c in self.code.T], 1).astype(np.float32) if n else None
        bits = self.code.shape[1] if n else 0
        self.scale, self.offset, self.weight = np.full(bits, 20.0), np.zeros(bits), np.ones(bits)

    def margins(self, text: str) -> np.ndarray:
        x = grams(text)
        at = np.flatnonzero(x)
        return x[at].astype(np.float32) @ self.odds[at] / max(1, x.sum())

    def calibrate(self, margins: np.ndarray, langs: list[str]) -> None:
        """Scale and offset by a few Newton steps; weight by how well the bit tells on the sample."""
        y = self.code[[self.langs.index(x) for x in langs]]
        for b in range(y.shape[1]):
            m, t = margins[:, b].astype(np.float64), y[:, b]
            spread = m.std() or 1.0
            x = np.stack([m / spread, np.ones(len(m))], 1)
            beta = np.zeros(2)
            for _ in range(25):
                p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
                beta += np.clip(np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(2), x.T @ (t - p) - 0.05 * beta), -3, 3)
            self.scale[b], self.offset[b] = max(beta[0], 1e-3) / spread, beta[1]
            right = ((self.scale[b] * m + self.offset[b] > 0) == (t == 1)).mean()
            self.weight[b] = max(0.05, 2 * right - 1)

    def decode(self, margins: np.ndarray) -> tuple[str, float, bool]:
        f = np.clip(self.scale * margins + self.offset, -30, 30)
        loss = (self.weight * np.logaddexp(0, -(2 * self.code - 1) * f)).sum(1) / self.weight.sum()
        share = np.exp(-(loss - loss.min()) * len(f))
        share /= share.sum()
        k = int(loss.argmin())
        return self.langs[k], float(share[k]), bool(share[k] < CLEAR)


def predicted(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text, lang) to (doc_id, held_out, lang_pred, score, ambiguous)."""
    spark = docs.sparkSession
    common.small_batches(spark)
    source = docs.select("doc_id", (common.fold("doc_id", 4) == 2).alias("held_out"), "text", "lang")
    learn = source.where("not held_out and lang is not null and text is not null")
    model = Model(_gram_counts(learn))
    if len(model.langs) > 1:
        h = F.xxhash64("doc_id")
        ids = learn.select("doc_id", h.alias("h")).distinct().orderBy("h", "doc_id").limit(SAMPLE).select("doc_id")
        first = spark.sparkContext.broadcast(model)

        def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [first.value.margins(t) for t in batch.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array([r.astype(np.float64) for r in rows], pa.list_(pa.float64())), batch.column(1)], ["m", "lang"])

        rows = [r for r in learn.join(F.broadcast(ids), "doc_id").select("text", "lang").mapInArrow(margins, "m array<double>, lang string").collect() if r.lang in set(model.langs)]
        rows.sort(key=lambda r: (r.lang, r.m))
        model.calibrate(np.array([r.m for r in rows]), [r.lang for r in rows])
    ready = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = ready.value
        for batch in batches:
            out = [own.decode(own.margins(t)) if t and own.langs and any(map(str.isalpha, t)) else ("und", 0.0, False) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64()), pa.array([x[2] for x in out], pa.bool_())], ["doc_id", "held_out", "lang_pred", "score", "ambiguous"])

    return source.select("doc_id", "held_out", "text").mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predicted(common.table(spark, sf_dir, "documents"))
