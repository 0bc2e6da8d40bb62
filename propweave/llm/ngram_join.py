"""N-gram Jaccard join over word shingles with signature trees (operator 8).

Two documents link when 100 * |A & B| >= 80 * |A | B| for their sets of five-word shingles.  All
links between different texts are found, exactly; only classes are returned, never all pairs.

1. A count sketch of all shingles (2**20 counters, whatever the input) tells the frequent ones.
2. Each document yields its set's size and 128-bit digest, a token bitmap, and the prefix of
   its set: the n - ceil(0.8 n) + 1 rarest shingles.  Linked sets share a prefix shingle.  Equal
   sets form one node, with a number of its own, whatever doc_ids have it.
3. Nodes are dealt out by prefix shingle.  A bucket is the nodes with one prefix shingle; it is read
   as a sorted stream, so its size doesn't matter for memory.  Buckets of one node go.
4. Leaders: each bucket's smallest node is its tree's first leaf; every other node is held against
   it, first by bitmap (maximum possible overlap), then exactly.  Links give classes for the moment.
5. Signature trees: in buckets whose nodes still are of more than one class, nodes are sorted by
   size into blocks; in each pair of blocks two trees, whose inner nodes hold OR-combined bitmaps,
   size ranges and the class that all below share, are traversed together.  A pair of tree nodes
   goes if its sizes can't fit, if the maximum possible overlap is too small, or if both sides are
   one class already.  Of buckets with the same nodes one is taken; bitmaps travel folded to PAIR_WORDS at most.
   What remains is held against whole bitmaps, each pair once, and verified exactly.
6. Components over both kinds of links and over the nodes that share a doc_id, and back to all documents.

A hot group of near copies thus costs work in proportion to its size: its nodes link to a leader
and are one class before step 5.

Defined results: null, empty and blank texts have n_shingles 0 and are components of their own;
rows that repeat a doc_id are of one component, with all their texts (rows stay, each with its own n_shingles); null doc_ids
are kept with a null component_id; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propweave.llm import common, tokens
from propweave.operators.components import connected_components

#: Bits of a bitmap: a power of two, four times the set's size or more, within these.
LEAST_BITS, MOST_BITS = 1 << 9, 1 << 17
SKETCH = 1 << 20
#: Nodes in a block of a bucket; a pair of blocks is one unit of work.
BLOCK = 512
LEAF, FANOUT = 8, 8
#: 64-bit words of a tree's bitmaps at most, and of those that its pairs are held against; pairs that are left are held
#: against their whole bitmaps after, apart.
TREE_WORDS, PAIR_WORDS = 64, 128
#: Hash positions for picking the documents whose sets are fetched; bounds the broadcast.
PICK = 1 << 20
PERCENT = 80


def _sketch(texts: DataFrame) -> np.ndarray:
    """Documents per shingle, summed by hash slot over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SKETCH, np.int64)
        for batch in batches:
            if batch.num_rows:
                every = np.concatenate(tokens.shingle_sets(batch.column(0).to_pylist()))
                counts += np.bincount((every & np.uint64(SKETCH - 1)).astype(np.int64), None, SKETCH)
        # 256 slices, so that sums meet in many tasks
        for k, part in enumerate(counts.reshape(256, -1)):
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([part.astype("<i8").tobytes()], pa.binary())], ["k", "part"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, None
        for batch in batches:
            for k, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if k != at:
                    if at is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["k", "part"])
                    at, total = k, np.zeros(SKETCH // 256, np.int64)
                total += np.frombuffer(part, "<i8")
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["k", "part"])

    parts = texts.mapInArrow(run, "k int, part binary").repartition(16, "k").sortWithinPartitions("k").mapInArrow(add, "k int, part binary")
    out = np.zeros((256, SKETCH // 256), np.int64)
    for row in parts.toLocalIterator():  # 256 rows
        out[row.k] = np.frombuffer(row.part, "<i8")
    return out.ravel()


def rarity(counts: np.ndarray) -> np.ndarray:
    """A level for each slot: 0 up to 4 times the mean slot, one more for each doubling, 31 at most."""
    usual = max(4.0, 4 * counts.mean())
    return np.clip(np.ceil(np.log2(np.maximum(counts, 1) / usual)), 0, 31).astype(np.uint64)


def prefix_size(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1 if n else 0


def bitmap(own: np.ndarray) -> bytes:
    size = min(MOST_BITS, max(LEAST_BITS, 1 << (4 * len(own) - 1).bit_length()))
    bits = np.zeros(size, np.uint8)
    bits[(own >> np.uint64(40)).astype(np.int64) % size] = 1
    return np.packbits(bits).tobytes()


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """A bitmap (64-bit words) as if made with fewer bits."""
    return np.bitwise_or.reduce(bits.reshape(-1, words)) if len(bits) > words else bits


def most_shared(x: np.ndarray, y: np.ndarray, nx: int, ny: int) -> int:
    """The maximum possible overlap of two sets by their bitmaps."""
    words = min(len(x), len(y))
    x, y = folded(x, words), folded(y, words)
    excess = min(nx - int(_popcount(x)), ny - int(_popcount(y)))
    return min(nx, ny, int(_popcount(x & y)) + excess)


def _features(texts: DataFrame, levels) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = levels.value
        for batch in batches:
            n, digest, prefix, bits = [], [], [], []
            for own in tokens.shingle_sets(batch.column(1).to_pylist()):
                n.append(len(own))
                digest.append(xxhash.xxh128_digest(own.tobytes()) if len(own) else None)
                bits.append(bitmap(own) if len(own) else None)
                key = (level[(own & np.uint64(SKETCH - 1)).astype(np.int64)] << np.uint64(58)) | (own >> np.uint64(6))
                p = prefix_size(len(own))
                key = np.partition(key, p - 1)[:p] if p else key
                prefix.append(key.view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(prefix, pa.list_(pa.int64())), pa.array(bits, pa.binary())], ["doc_id", "n", "digest", "prefix", "bits"])

    return texts.mapInArrow(run, "doc_id long, n long, digest binary, prefix array<long>, bits binary")


def _buckets(rows: DataFrame) -> DataFrame:
    """Rows (token, rep, n) to rows with the bucket's leader, its size, and pos; buckets of one go.

    The leader is the smallest rep; buckets are streams, and a row waits only for its successor."""
    names = ["token", "rep", "n", "leader", "leader_n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, opened = None, None  # the last row, not yet given out; the first row of its run
        for batch in batches:
            t, r, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if not len(t):
                continue
            if held is not None:
                t, r, n = (np.concatenate([[a], b]) for a, b in zip(held, (t, r, n)))
            once = np.concatenate([[True], (t[1:] != t[:-1]) | (r[1:] != r[:-1])])  # rows that repeat a doc_id and a text
            t, r, n = t[once], r[once], n[once]
            first = np.concatenate([[True], t[1:] != t[:-1]])
            start = np.maximum.accumulate(np.where(first, np.arange(len(t)), 0))
            lead, lead_n = r[start], n[start]
            if held is not None and opened[0] == t[0]:
                own = t == t[0]
                lead, lead_n = np.where(own, opened[1], lead), np.where(own, opened[2], lead_n)
            more = np.append(t[:-1] == t[1:], False)
            keep = more | ~first
            if held is not None and (held[1] != opened[1]):
                keep[0] = True
            keep[-1] = False
            held, opened = (t[-1], r[-1], n[-1]), (t[-1], lead[-1], lead_n[-1])
            k = np.flatnonzero(keep)
            if len(k):
                yield pa.RecordBatch.from_arrays([pa.array(x[k], pa.int64()) for x in (t, r, n, lead, lead_n)], names)
        if held is not None and held[1] != opened[1]:
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (*held, *opened[1:])], names)

    dealt = rows.select("token", "rep", "n").repartition("token").sortWithinPartitions("token", "rep")
    return dealt.mapInArrow(run, "token long, rep long, n long, leader long, leader_n long")


def _popcount(a: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a).sum(-1, dtype=np.int64)


class Tree:
    """A signature tree over nodes sorted by size.  level[0] holds the documents."""

    def __init__(self, n: np.ndarray, bits: np.ndarray, cls: np.ndarray):
        excess = n - _popcount(bits)
        self.levels = [(bits, n, n, excess, cls)]
        while len(n) > 1:
            step = LEAF if len(self.levels) == 1 else FANOUT
            at = np.arange(0, len(self.levels[-1][1]), step)
            bits, low, high, excess, cls = self.levels[-1]
            lo, hi = np.minimum.reduceat(cls, at), np.maximum.reduceat(np.where(cls == NONE, np.iinfo(np.int64).max, cls), at)
            self.levels.append((np.bitwise_or.reduceat(bits, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.maximum.reduceat(excess, at), np.where(lo == hi, lo, NONE)))
            n = self.levels[-1][1]

    def below(self, level: int, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For entries i of a level: (index into i, child)."""
        step = LEAF if level == 1 else FANOUT
        child = (i[:, None] * step + np.arange(step)).ravel()
        who = np.repeat(np.arange(len(i)), step)
        ok = child < len(self.levels[level - 1][1])
        return who[ok], child[ok]


#: The class of a tree node with documents of more than one class.
NONE = np.iinfo(np.int64).min


def possible(a: Tree, la: int, i: np.ndarray, b: Tree, lb: int, j: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Which pairs of tree nodes can hold a link between different classes."""
    bits_a, low_a, high_a, ex_a, cls_a = a.levels[la]
    bits_b, low_b, high_b, ex_b, cls_b = b.levels[lb]
    ok = (100 * high_a[i] >= percent * low_b[j]) & (100 * high_b[j] >= percent * low_a[i]) & ~((cls_a[i] == cls_b[j]) & (cls_a[i] != NONE))
    k = np.flatnonzero(ok)
    step = max(1, (1 << 21) // bits_a.shape[1])  # pairs whose bitmaps are held at once
    shared = np.concatenate([np.zeros(0, np.int64), *(_popcount(bits_a[i[k[s : s + step]]] & bits_b[j[k[s : s + step]]]) for s in range(0, len(k), step))])
    most = np.minimum(shared + np.minimum(ex_a[i[k]], ex_b[j[k]]), np.minimum(high_a[i[k]], high_b[j[k]]))
    # |A & B| >= s * |A | B|  <=>  (1 + s) * |A & B| >= s * (|A| + |B|)
    ok[k] = (100 + percent) * most >= percent * (low_a[i[k]] + low_b[j[k]])
    return ok


#: Pairs of tree nodes held at once in a traversal.
FRONT = 1 << 16


def dual_traversal(a: Tree, b: Tree, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of documents (index in a, index in b) that survive; with same, each unordered pair once."""
    zero = np.zeros(1, np.int64)
    stack = [(len(a.levels) - 1, len(b.levels) - 1, zero, zero)]
    while stack:
        la, lb, i, j = stack.pop()
        ok = possible(a, la, i, b, lb, j)
        i, j = i[ok], j[ok]
        if not len(i):
            continue
        if la == lb == 0:
            if same:
                i, j = i[i < j], j[i < j]
            if len(i):
                yield i, j
            continue
        for s in range(0, len(i), FRONT // 64):
            x, y, to_a, to_b = i[s : s + FRONT // 64], j[s : s + FRONT // 64], la, lb
            if la >= lb:
                who, x = a.below(la, x)
                y, to_a = y[who], la - 1
            if lb >= la:
                who, y = b.below(lb, y)
                x, to_b = x[who], lb - 1
            if same and to_a == to_b:
                x, y = x[x <= y], y[x <= y]
            stack.append((to_a, to_b, x, y))


def _tree_pairs(rows: DataFrame) -> DataFrame:
    """Rows (token, i, j, block, rep, n, cls, leader, bits), one run for each pair of blocks, to pairs (a, b)."""

    def pairs(run: list[tuple]) -> Iterator[pa.RecordBatch]:
        blocks = {}
        for _, _, _, block, rep, n, cls, leader, bits in run:
            blocks.setdefault(block, []).append((n, rep, cls, bits, leader))
        trees = []
        for own in (sorted(blocks[k], key=lambda x: x[:2]) for k in sorted(blocks)):
            n, rep, cls = (np.array([x[k] for x in own], np.int64) for k in range(3))
            trees.append((rep, n, [np.frombuffer(x[3], np.uint64) for x in own], cls))
        # one size for all of a tree's bitmaps; pairs of documents are held against their own after
        words = min(TREE_WORDS, min(len(x) for _, _, full, _ in trees for x in full))
        whole = [full for _, _, full, _ in trees]
        sizes = [n for _, n, _, _ in trees]
        trees = [(rep, Tree(n, np.array([folded(x, words) for x in full]), cls)) for rep, n, full, cls in trees]
        leader, two = run[0][7], len(trees) == 2
        if not two and run[0][1] != run[0][2]:
            return
        (ra, a), (rb, b) = trees[0], trees[-1]
        for i, j in dual_traversal(a, b, not two):
            x, y = ra[i], rb[j]
            new = (x != leader) & (y != leader)
            for k in np.flatnonzero(new).tolist():
                nx, ny = int(sizes[0][i[k]]), int(sizes[-1][j[k]])
                new[k] = (100 + PERCENT) * most_shared(whole[0][i[k]], whole[-1][j[k]], nx, ny) >= PERCENT * (nx + ny)
            if new.any():
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)[new]), pa.array(np.maximum(x, y)[new])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_run: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if open_run and open_run[0][:3] != row[:3]:
                    yield from pairs(open_run)
                    open_run = []
                open_run.append(row)
        if open_run:
            yield from pairs(open_run)

    return rows.mapInArrow(run, "a long, b long")


def _tree_bits(bits: DataFrame) -> DataFrame:
    """(rep, bits): bitmaps of PAIR_WORDS at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            small = [folded(np.frombuffer(x, np.uint64), PAIR_WORDS).tobytes() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(small, pa.binary())], ["rep", "bits"])

    return bits.select("rep", "bits").mapInArrow(run, "rep long, bits binary")


def _sets(texts: DataFrame, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(rep, own): the shingle sets of the nodes in pairs, from their smallest doc_ids.  A broadcast of at most PICK
    hash positions keeps most other texts from being read into sets; no other use is made of them."""
    spot = F.pmod(F.xxhash64("doc_id"), F.lit(PICK))
    ends = pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).distinct()
    wanted = common.cut(nodes.join(ends, "rep", "left_semi"), "wanted")
    spots = wanted.select(spot.alias("spot")).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = tokens.shingle_sets(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([xxhash.xxh128_digest(x.tobytes()) for x in own], pa.binary()), pa.array([x.view(np.int64) for x in own], pa.list_(pa.int64()))], ["doc_id", "digest", "own"])

    picked = texts.select("doc_id", "text", spot.alias("spot")).join(F.broadcast(spots), "spot", "left_semi").select("doc_id", "text")
    made = picked.mapInArrow(run, "doc_id long, digest binary, own array<long>")
    # rows with other texts of these ids, and ids that only share a spot, go here
    return made.join(wanted, ["doc_id", "digest"]).select("rep", "own").dropDuplicates(["rep"])


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    a = sets.select(F.col("rep").alias("a"), F.col("own").alias("own_a"))
    b = sets.select(F.col("rep").alias("b"), F.col("own").alias("own_b"))
    both = pairs.join(a, "a").join(b, "b").select("a", "b", F.size("own_a").alias("na"), F.size("own_b").alias("nb"), F.size(F.array_intersect("own_a", "own_b")).alias("common"))
    return both.where((100 + PERCENT) * F.col("common") >= PERCENT * (F.col("na") + F.col("nb"))).select(F.col("b").alias("src"), F.col("a").alias("dst"))


def _one_each(bits: DataFrame, reps: DataFrame) -> DataFrame:
    """The rows of bits of these reps, one for each."""
    return bits.join(reps.distinct(), "rep", "left_semi").dropDuplicates(["rep"])


def _bitmap_filter(pairs: DataFrame, bits: DataFrame) -> DataFrame:
    """Of pairs (a, b), those whose maximum possible overlap by bitmap is enough."""
    bits = _one_each(bits, pairs.select(F.col("a").alias("rep")).union(pairs.select("b")))
    a = bits.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("bits").alias("bits_a"))
    b = bits.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("bits_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = zip(*(batch.column(i).to_pylist() for i in range(2, 6)))
            ok = pa.array([(100 + PERCENT) * most_shared(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), na, nb) >= PERCENT * (na + nb) for na, nb, x, y in rows], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(ok), batch.column(1).filter(ok)], ["a", "b"])

    return pairs.join(a, "a").join(b, "b").select("a", "b", "na", "nb", "bits_a", "bits_b").mapInArrow(run, "a long, b long")


def near_duplicate_classes(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row for each row of docs (doc_id long, text string)."""
    spark = docs.sparkSession
    common.small_batches(spark)
    texts = docs.select("doc_id", "text")
    levels = spark.sparkContext.broadcast(rarity(_sketch(texts.select("text"))))
    made = common.cut(_features(texts, levels), "shingles")
    known = made.where("doc_id is not null and n > 0")
    # one node for each different set: its number (rep, in the order of doc_ids), its smallest doc_id and its digest
    nodes = common.cut(known.groupBy("digest", "n").agg(F.min("doc_id").alias("doc_id")).repartitionByRange("doc_id", "digest").sortWithinPartitions("doc_id", "digest").select(F.monotonically_increasing_id().alias("rep"), "doc_id", "digest"), "nodes")
    first = known.join(nodes, ["doc_id", "digest"])
    postings = first.select("rep", "n", F.explode("prefix").alias("token"))
    buckets = common.cut(_buckets(postings), "buckets")
    bits = first.select("rep", "n", "bits")

    fits = (100 * F.least("n", "leader_n") >= PERCENT * F.greatest("n", "leader_n")) & (F.col("rep") != F.col("leader"))
    led = buckets.where(fits).select(F.col("leader").alias("a"), F.col("rep").alias("b")).distinct()
    led = common.cut(_bitmap_filter(led, bits), "led")
    links = common.cut(_verified(led, common.cut(_sets(texts, led, nodes), "sets")), "links")
    # an id's nodes, one with each of its texts, belong together
    held = common.cut(known.select("doc_id", "digest").distinct().join(nodes.select("rep", "digest"), "digest").select("doc_id", "rep"), "held")
    same = held.join(held.groupBy("doc_id").agg(F.min("rep").alias("dst")), "doc_id").where("rep <> dst").select(F.col("rep").alias("src"), "dst")
    classes = connected_components(links)

    named = buckets.where("rep <> leader").join(classes.withColumnRenamed("node", "rep"), "rep", "left").select("token", "rep", "n", "leader", F.coalesce("component", "rep").alias("cls"))
    # of buckets with the same nodes one is enough
    members = [F.count("*").alias("m"), F.min("cls").alias("low"), F.max("cls").alias("high"), F.bit_xor(F.xxhash64("rep")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "rep")).alias("y")]
    mixed = named.groupBy("token").agg(*members).where("low <> high").groupBy("m", "low", "high", "x", "y").agg(F.min("token").alias("token"))
    open_rows = common.cut(named.join(mixed.select("token", "m"), "token"), "mixed")
    if not open_rows.isEmpty():
        # blocks by a hash salt only where a bucket is larger than a block; every pair of blocks is kept
        count = F.ceil(F.col("m") / BLOCK).cast("int")
        block = F.pmod(F.xxhash64("rep"), count).cast("int")
        other = F.explode(F.sequence(F.lit(0), count - 1))
        dealt = open_rows.withColumn("block", block).withColumn("other", other).select("token", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "rep", "n", "cls", "leader")
        small = _tree_bits(_one_each(bits, open_rows.select("rep")))
        wide = dealt.join(small, "rep").select("token", "i", "j", "block", "rep", "n", "cls", "leader", "bits")
        pairs = common.cut(_tree_pairs(wide.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")).distinct(), "pairs")
        pairs = common.cut(_bitmap_filter(pairs, bits), "pairs")
        links = links.union(common.cut(_verified(pairs, _sets(texts, pairs, nodes)), "links"))
        classes = connected_components(links.union(same))
    else:
        classes = connected_components(links.union(same))
    # back from nodes to doc_ids: a component is called by the smallest of them
    placed = held.join(classes.withColumnRenamed("node", "rep"), "rep", "left").select("doc_id", F.coalesce("component", "rep").alias("cls"))
    label = placed.groupBy("cls").agg(F.min("doc_id").alias("component_id"))
    labels = placed.distinct().join(label, "cls").select("doc_id", "component_id")
    out = made.select("doc_id", F.col("n").alias("n_shingles")).join(labels, "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """Of each class its smallest doc_id stays; so do rows without an id, and all repeats of a row."""
    (own,) = common.fresh(docs, "id")
    kept = near_duplicate_classes(docs).where("doc_id = component_id").select(F.col("doc_id").alias(own)).distinct()
    keyed = docs.join(kept, F.col("doc_id") == F.col(own), "left")
    return keyed.where(F.col(own).isNotNull() | F.col("doc_id").isNull()).select(*[f"`{c}`" for c in docs.columns])


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(common.table(spark, sf_dir, "documents"))


SQL = r"""
with recursive w as (select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from documents),
s as (select distinct doc_id, g from (
  select doc_id, array_to_string(ws[i:i + 4], chr(10)) as g from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) as i from w where len(ws) > 0))),
n as (select doc_id, count(*) as n from s group by doc_id),
c as (select a.doc_id as x, b.doc_id as y, count(*) as k from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by all),
e as (select x, y from c join n p on p.doc_id = x join n q on q.doc_id = y where 100 * k >= 80 * (p.n + q.n - k)),
e2 as (select x, y from e union all select y, x from e),
cc(d, l) as (select x, x from e2 union select e2.y, cc.l from cc join e2 on e2.x = cc.d),
m as (select d, min(l) as l from cc group by d)
select w.doc_id, coalesce(n.n, 0) as n_shingles, coalesce(m.l, w.doc_id) as component_id
from w left join n on n.doc_id = w.doc_id left join m on m.d = w.doc_id
"""
