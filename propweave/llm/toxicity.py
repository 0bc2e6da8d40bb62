"""Toxicity by fuzzy lexicon matching with context windows (operator 5).

The lexicon is learned: words, and stems (word beginnings that any ending may follow), whose
document frequency differs between the two labels.  It becomes a trie, and a Levenshtein automaton
is intersected with it: a state is the set of trie nodes reached, each with its fewest errors.  The
intersection is a deterministic automaton, made as words need it and kept, so a word costs one step
for each character.  Words of five letters or more match with one error.

A match counts by its term's weight.  Matches add up in windows of words; those between quotation
marks, which are the same in all languages, are summed apart, so that quotation and abuse have weights of
their own in a logistic regression that gives the score.

Lexicon and regression are fitted on all labelled rows whose fold isn't held out: term weights for the regression
come from one half of them, by the hash of doc_id, its coefficients from the other.  Terms are counted in toxic rows
first; of the others' terms only those that share a slot of a bitmap of fixed size with one that is in MIN_ROWS toxic
rows are counted, as no other can pass.  Newton's steps are sums over all rows.  Every whole text is scored.

Defined results: null and blank texts score as texts without a match; repeated rows score alike; a doc_id with
several labels has the largest; a score of just 0.5 is toxic; very long texts are scored whole; an empty table gives an empty table; without any usable label
all scores are 0; other columns pass through flagged() and are ignored by scored().
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propweave.llm import common, tokens

#: Labels that are broadcast at most; more are joined by a shuffle.
FEW = 1 << 19
#: Log2 of the bits of the map of terms that may pass.
MAP_BITS = 23
#: Different terms that a task counts before it gives them out.
FLUSH = 200_000
#: Tasks of a pass over the regression's rows.
TASKS = 48
#: Characters of the beginnings of words that may become terms.
STEMS = range(4, 10)
#: A term's two-proportion z score (5: one in three million by chance), the toxic rows it occurs in and its log
#: ratio are at least these; all terms that pass are kept.
MIN_Z, MIN_ROWS, MIN_RATIO = 5.0, 5, 1.5
ERRORS, FUZZY_FROM = 1, 5
WINDOW = 12
EDGES = b".,;:!?\"'()[]{}<>*#$%&|`~^_-+=/\\"
#: Words, and automaton states, that a worker keeps.
CACHE, STATES = 400_000, 50_000
#: Words whose terms a worker keeps.
TERMS = 50_000
FEATURES = 7


class FuzzyLexicon:
    """Terms {word or stem + "*": weight} as a trie, intersected with a Levenshtein automaton."""

    def __init__(self, terms: dict[str, float]):
        self.children: list[dict[str, int]] = [{}]
        self.word: dict[int, tuple[float, int]] = {}
        self.stem: dict[int, float] = {}
        for term, weight in sorted(terms.items()):
            node = 0
            for ch in term.rstrip("*"):
                if ch not in self.children[node]:
                    self.children[node][ch] = len(self.children)
                    self.children.append({})
                node = self.children[node][ch]
            if term.endswith("*"):
                self.stem[node] = max(weight, self.stem.get(node, 0.0))
            else:
                self.word[node] = (weight, len(term))
        self.clear()

    def clear(self) -> None:
        # each state's nodes and errors as sorted 32-bit numbers: workers outlive a step, so what they keep is small
        self.ids: dict[bytes, int] = {}
        self.sets: list[bytes] = []
        self.steps: list[dict[str, int]] = []
        self.ends: list[float] = []
        self.stems: list[float] = []
        self.start = self.state({0: 0})

    def state(self, reached: dict[int, int]) -> int:
        """The number of a state, closed under leaving out characters of a term."""
        todo = list(reached.items())
        while todo:
            node, e = todo.pop()
            if e < ERRORS and reached.get(node) == e:
                for child in self.children[node].values():
                    if reached.get(child, ERRORS + 1) > e + 1:
                        reached[child] = e + 1
                        todo.append((child, e + 1))
        key = array("i", sorted(node * (ERRORS + 1) + e for node, e in reached.items())).tobytes()
        if key not in self.ids:
            self.ids[key] = len(self.sets)
            self.sets.append(key)
            self.steps.append({})
            words = [w * (1.0 if e == 0 else 0.7) for node, e in reached.items() if node in self.word for w, n in [self.word[node]] if e == 0 or n >= FUZZY_FROM]
            self.ends.append(max(words, default=0.0))
            self.stems.append(max((self.stem[node] for node, e in reached.items() if e == 0 and node in self.stem), default=0.0))
        return self.ids[key]

    def step(self, at: int, ch: str) -> int:
        reached: dict[int, int] = {}
        for node, e in (divmod(x, ERRORS + 1) for x in memoryview(self.sets[at]).cast("i")):
            child = self.children[node].get(ch)
            if child is not None:
                reached[child] = min(e, reached.get(child, e))
            if e < ERRORS:
                for other in (node, *self.children[node].values()):
                    reached[other] = min(e + 1, reached.get(other, e + 1))
        return self.state(reached)

    def weight(self, word: str) -> float:
        """The largest weight of a term that the word matches, 0.0 if none."""
        if len(self.sets) > STATES:
            self.clear()
        at, best, last = self.start, 0.0, len(word) - 1
        for i, ch in enumerate(word):
            after = self.steps[at].get(ch)
            if after is None:
                after = self.steps[at][ch] = self.step(at, ch)
            at = after
            if not self.sets[at]:
                return best
            if i < last and self.stems[at] > best:
                best = self.stems[at]
        return max(best, self.ends[at])


def normal(token: bytes) -> str:
    return token.strip(EDGES).decode().lower()


class Weights(dict):
    """Weights by token as split from the text."""

    def __init__(self, lexicon: FuzzyLexicon):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, token: bytes) -> float:
        if len(self) >= CACHE:
            self.clear()
        w = self.lexicon.weight(normal(token))
        if len(token) <= 100:
            self[token] = w
        return w


def quoted(words: list[bytes], hits: np.ndarray) -> np.ndarray:
    """Which hits stand between quotation marks."""
    marks = np.fromiter((w.count(b'"') + w.count("“".encode()) + w.count("”".encode()) for w in words), np.int64, len(words))
    before = np.cumsum(marks) - marks
    # an opening mark may be on the word itself; a last mark without a partner opens nothing
    inside = (before % 2 == 1) & (before < marks.sum()) | np.fromiter((w[:1] == b'"' and w.rstrip(b".,;:!?")[-1:] == b'"' for w in words), bool, len(words))
    inside |= (before % 2 == 0) & (marks % 2 == 1) & (before + 1 < marks.sum())
    return inside[hits]


def features(words: list[bytes], weights: Weights) -> np.ndarray:
    n = len(words)
    w = np.fromiter(map(weights.__getitem__, words), np.float64, n)
    hits = np.flatnonzero(w)
    out = np.zeros(FEATURES)
    out[0] = 1
    if len(hits):
        q = quoted(words, hits)
        own, spoken = w[hits] * ~q, w[hits] * q
        total = np.concatenate([[0], np.cumsum(own)])
        low, high = np.searchsorted(hits, hits - WINDOW), np.searchsorted(hits, hits + WINDOW, "right")
        out[1:] = np.log1p(own.sum()), np.log1p((total[high] - total[low]).max()), np.log1p(100 * own.sum() / max(n, 20)), np.log1p(spoken.sum()), np.log1p((own > 0).sum()), w.max()
    return out


class Terms(dict):
    """The terms of a token, as split from the text; with a bitmap, those that have their bit set."""

    def __init__(self, bits: np.ndarray | None = None):
        super().__init__()
        self.bits = bits

    def __missing__(self, token: bytes) -> tuple[str, ...]:
        if len(self) >= TERMS:
            self.clear()
        w, own = normal(token), ()
        if len(w) >= 3:
            own = (w, *(w[:k] + "*" for k in STEMS if len(w) > k))
            if self.bits is not None:
                own = tuple(t for t in own if self.bits[(x := spot(t)) >> 3] >> (x & 7) & 1)
        if len(token) <= 100:
            self[token] = own
        return own


def spot(term: str) -> int:
    return xxhash.xxh64_intdigest(term) >> (64 - MAP_BITS)


def _counted(rows: DataFrame, bits=None) -> DataFrame:
    """(term, c0, c1: rows (text, half) of each half with it), of all terms or those in a broadcast bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = Terms(None if bits is None else bits.value), (Counter(), Counter())

        def out() -> Iterator[pa.RecordBatch]:
            terms = list(set().union(*counts))
            for s in range(0, len(terms), 20000):
                part = terms[s : s + 20000]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), *(pa.array([c[t] for t in part], pa.int64()) for c in counts)], ["term", "c0", "c1"])
            for c in counts:
                c.clear()

        for batch in batches:
            for text, half in zip(*(c.to_pylist() for c in batch.columns)):
                counts[half].update(set().union(*map(known.__getitem__, set(tokens.split(text)))))
                if sum(map(len, counts)) > FLUSH:
                    yield from out()
        yield from out()

    return rows.select("text", "half").mapInArrow(run, "term string, c0 long, c1 long").groupBy("term").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1"))


def _bitmap(terms: DataFrame) -> np.ndarray:
    """The terms' bits, a byte for eight of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(1 << MAP_BITS, bool)
        for batch in batches:
            own[[spot(t) for t in batch.column(0).to_pylist()]] = True
        own = np.packbits(own, bitorder="little").reshape(64, -1)
        for k in np.flatnonzero(own.any(1)).tolist():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([own[k].tobytes()], pa.binary())], ["k", "x"])

    out = np.zeros((64, (1 << MAP_BITS) // 512), np.uint8)
    for row in terms.select("term").coalesce(8).mapInArrow(run, "k int, x binary").collect():  # eight bitmaps at most
        out[row.k] |= np.frombuffer(row.x, np.uint8)
    return out.ravel()


def _learn_terms(rows: DataFrame) -> tuple[dict, dict]:
    """Lexicons from the first half, and from all rows (text, label, half)."""
    n = Counter({(r.label, r.half): r["count"] for r in rows.groupBy("label", "half").count().collect()})
    toxic = common.cut(_counted(rows.where("label = 1")).where(f"c0 + c1 >= {MIN_ROWS}"), "terms")
    bits = rows.sparkSession.sparkContext.broadcast(_bitmap(toxic))
    other = _counted(rows.where("label = 0"), bits).select("term", F.col("c0").alias("o0"), F.col("c1").alias("o1"))
    sums = common.cut(toxic.join(other, "term", "left").na.fill(0, ["o0", "o1"]), "terms")
    bits.destroy()
    out = []
    for halves in ((0,), (0, 1)):
        n1, n0 = (max(1, sum(n[label, h] for h in halves)) for label in (1, 0))
        x, y = (sum((F.col(f"{c}{h}") for h in halves), F.lit(0)) for c in "co")
        p = (x + y) / (n1 + n0)
        z = (x / n1 - y / n0) / F.sqrt(F.greatest(p * (1 - p), F.lit(1e-9)) * (1 / n1 + 1 / n0))
        weight = F.log((x + 0.5) / (n1 + 1.0)) - F.log((y + 0.5) / (n0 + 1.0))
        found = sums.select("term", z.alias("z"), weight.alias("weight"), x.alias("x")).where(f"z >= {MIN_Z} and weight >= {MIN_RATIO} and x >= {MIN_ROWS}")
        out.append({r.term: float(r.weight) for r in found.collect()})  # terms that differ by label
    return out[0], out[1]


def _newton(rows: DataFrame, beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss, its gradient and its second derivatives at beta, summed over all rows (x, label, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + FEATURES + FEATURES * FEATURES)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy().reshape(-1, FEATURES)
            y, n = (batch.column(k).to_numpy().astype(np.float64) for k in (1, 2))
            z = x @ beta
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            total += np.concatenate([[(n * np.logaddexp(0, -(2 * y - 1) * z)).sum()], x.T @ (n * (y - p)), ((x * (n * p * (1 - p))[:, None]).T @ x).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], ["x"])

    total = np.sum([r.x for r in rows.mapInArrow(run, "x array<double>").collect()], 0)  # a row for each of TASKS
    return total[0], total[1 : 1 + FEATURES], total[1 + FEATURES :].reshape(FEATURES, FEATURES)


def fit_logistic(rows: DataFrame, ridge: float = 0.1) -> np.ndarray:
    """Newton's method over rows (x, label, n: how often), with halved steps where the loss would grow."""
    at = lambda b: ((s := _newton(rows, b))[0] + ridge * (b @ b) / 2, *s[1:])
    beta = np.zeros(FEATURES)
    loss, up, bend = at(beta)
    for _ in range(30):
        step = np.linalg.solve(bend + ridge * np.eye(FEATURES), up - ridge * beta)
        there = at(beta + step)
        while np.abs(step).max() > 1e-6 and there[0] > loss + 1e-12 * abs(loss):  # not for what sums are rounded by
            step = step / 2
            there = at(beta + step)
        beta = beta + step
        loss, up, bend = there
        if np.abs(step).max() < 1e-6:
            break
    return beta


_open: list = [None, None]


def _weights(terms) -> Weights:
    """The automaton for broadcast terms, one for each worker."""
    if _open[0] is not terms:
        _open[:] = [terms, Weights(FuzzyLexicon(terms))]
    return _open[1]


def fit(docs: DataFrame, labels: DataFrame, held_out: str = "held_out") -> tuple[dict, np.ndarray] | None:
    """Terms and coefficients; docs has doc_id, text and held_out, labels doc_id and toxic."""
    spark = docs.sparkSession
    usable = labels.where("doc_id is not null and toxic is not null").select("doc_id", (F.col("toxic") >= 1).cast("int").alias("label"))
    usable = usable.groupBy("doc_id").agg(F.max("label").alias("label")).where(common.fold("doc_id", 5) != 0)
    usable = common.cut(usable.select("doc_id", "label", F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int").alias("half")), "labels")
    few = usable.limit(FEW + 1).count() <= FEW
    rows = docs.where(~F.col(held_out)).select("doc_id", "text").join(F.broadcast(usable) if few else usable, "doc_id").select("text", "label", "half")
    rows = common.cut(rows, "learning")
    first, every = _learn_terms(rows)
    if not every:
        return None
    terms = spark.sparkContext.broadcast(first or every)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = _weights(terms.value)
        for batch in batches:
            found = [features(tokens.split(t), weights) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.float64())), batch.column(1)], ["x", "label"])

    x = rows.where("half = 1").select("text", "label").mapInArrow(run, "x array<double>, label int")
    x = common.cut(x.groupBy("x", "label").agg(F.count("*").alias("n")), "features")
    if x.isEmpty():
        return None
    return every, fit_logistic(x.coalesce(TASKS))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds held_out, score and predicted to docs (doc_id, text, anything else); the text stays."""
    spark = docs.sparkSession
    common.small_batches(spark)
    own = [f"`{c}`" for c in docs.columns if c.lower() not in ("held_out", "score", "predicted")]
    source = docs.select(*own, (common.fold("doc_id", 5) == 0).alias("held_out"))
    model = spark.sparkContext.broadcast(fit(source, labels) or ({}, None))
    schema = source.select("*", F.lit(0.0).alias("score"), F.lit(0).alias("predicted")).schema
    at, names = source.columns.index("text"), [*source.columns, "score", "predicted"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, beta = model.value
        weights = _weights(terms)
        for batch in batches:
            if beta is None:
                score = np.zeros(batch.num_rows)
            else:
                x = np.array([features(tokens.split(t), weights) for t in batch.column(at).to_pylist()]).reshape(-1, FEATURES)
                score = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score), pa.array(score >= 0.5).cast(pa.int32())], names)

    return source.mapInArrow(run, schema)


def flagged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without the rows predicted to be toxic."""
    taken = [c for c in docs.columns if c.lower() in ("held_out", "score", "predicted")]
    names = dict(zip(taken, common.fresh(docs, *(f"own_{c}" for c in taken))))
    out = scored(docs.withColumnsRenamed(names), labels).where("predicted = 0")
    return out.select(*[F.col(f"`{names.get(c, c)}`").alias(c) for c in docs.columns])


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return scored(docs, common.table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")
