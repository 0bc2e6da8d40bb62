"""Byte-level BPE encoding and decoding (operator 3).

Pre-tokenisation uses no regex.  A text becomes an array of code points and, through a table, of
symbols (letter, number, other, kinds of white space, apostrophe that can begin a contraction).  A
nine-symbol automaton decides where pieces start.  Its transition functions form a small monoid, so
its states are found by an associative scan: compose the functions inside each block for all blocks
at once, scan the block totals, then replay the blocks in parallel.  The pieces, cut out of the UTF-8
bytes, go through pair merging with a bounded cache.

Defined results: a null text counts as empty; an empty text has no ids and decodes to no bytes;
repeated rows give repeated rows; extra columns pass through unless they are named like an output,
in which case the output replaces them.
"""

from __future__ import annotations

import base64
import functools
import heapq
import itertools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propweave.llm import common

L, N, P, SPACE_LAST, WS_LAST, WS_MID, APOS_1, APOS_2, END = range(9)
RESET, IN_L, IN_N, IN_P, PENDING, IN_WS, LEFT_2, LEFT_1 = range(8)
#: White space as the pattern's \s has it, besides U+0009 to U+000D and the space (fixed values).
MORE_SPACE = (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
APOSTROPHE, SENTINEL = 0x27, 0x110000
BLOCK = 256
#: Code points handled in one scan, unless one text is longer.
CHUNK = 1 << 20
#: Pieces that a worker's cache holds; a full cache is emptied.
CACHE = 300_000


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """The next state, and whether a piece starts at this symbol."""
    if symbol == END:
        return RESET, False
    if state in (LEFT_2, LEFT_1):
        return (LEFT_1 if state == LEFT_2 else RESET), False
    if symbol in (APOS_1, APOS_2) and state not in (IN_P, PENDING):
        return (LEFT_1 if symbol == APOS_1 else LEFT_2), True
    if symbol in (P, APOS_1, APOS_2):
        return IN_P, state not in (IN_P, PENDING)
    if symbol in (L, N):
        same = IN_L if symbol == L else IN_N
        return same, state not in (same, PENDING)
    if symbol == WS_MID:
        return IN_WS, state != IN_WS
    return (PENDING if symbol == SPACE_LAST else RESET), True


@functools.lru_cache(1)
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """next[state, symbol], starts[state, symbol], compose[f, g] (f, then g) and apply[f, state]
    over the monoid of transition functions; function k below 9 is that of symbol k, 9 the identity."""
    step = np.array([[_step(q, s)[0] for s in range(9)] for q in range(8)], np.uint8)
    starts = np.array([[_step(q, s)[1] for s in range(9)] for q in range(8)])
    known = {tuple(step[:, s]): s for s in reversed(range(9))}
    functions = [tuple(step[:, s]) for s in range(9)] + [tuple(range(8))]
    known.setdefault(functions[9], 9)
    i = 0
    while i < len(functions):
        for s in range(9):
            made = tuple(step[q, s] for q in functions[i])
            if made not in known:
                known[made] = len(functions)
                functions.append(made)
        i += 1
    compose = np.array([[known[tuple(g[q] for q in f)] for g in functions] for f in functions], np.uint16)
    return step, starts, compose, np.array(functions, np.uint8)


@functools.lru_cache(1)
def classes() -> np.ndarray:
    """Letter, number, other or white space (WS_MID) of every code point; the sentinel ends a text."""
    out = np.full(SENTINEL + 1, P, np.uint8)
    for cp in range(SENTINEL):
        kind = unicodedata.category(chr(cp))[0]
        if kind in "LN":
            out[cp] = L if kind == "L" else N
    out[[*range(9, 14), 32, *MORE_SPACE]] = WS_MID
    out[SENTINEL] = END
    return out


def symbols(cps: np.ndarray) -> np.ndarray:
    """Symbols of code points; texts are separated, and closed, by the sentinel."""
    sym = classes()[cps]
    after = np.append(sym[1:], END)
    last = (sym == WS_MID) & (after != WS_MID) & (after != END)
    sym[last] = np.where(cps[last] == 32, SPACE_LAST, WS_LAST)
    at = np.flatnonzero(cps == APOSTROPHE)
    if len(at):
        far = np.append(cps, [0, 0])
        one, two = far[at + 1], far[at + 2]
        sym[at[np.isin(one, [ord(c) for c in "stmd"])]] = APOS_1
        pair = (one == ord("r")) & (two == ord("e")) | (one == ord("v")) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        sym[at[pair]] = APOS_2
    return sym


def piece_starts(sym: np.ndarray) -> np.ndarray:
    """Positions where pieces start, by a blocked associative scan over transition functions."""
    step, starts, compose, apply = automaton()
    n = len(sym)
    blocks = -(-n // BLOCK)
    padded = np.full(blocks * BLOCK, 9, np.uint16)
    padded[:n] = sym
    columns = np.ascontiguousarray(padded.reshape(blocks, BLOCK).T)
    flat, width = compose.ravel(), compose.shape[1]
    total = columns[0].astype(np.int64)
    for k in range(1, BLOCK):
        total = flat[total * width + columns[k]].astype(np.int64)
    state, at_block = RESET, np.empty(blocks, np.int64)
    for b, f in enumerate(total.tolist()):
        at_block[b] = state
        state = apply[f, state]
    wide_step = np.concatenate([step, np.arange(8, dtype=np.uint8)[:, None]], 1).ravel()
    before, state = np.empty((BLOCK, blocks), np.uint8), at_block
    for k in range(BLOCK):
        before[k] = state
        state = wide_step[state * 10 + columns[k]].astype(np.int64)
    before = before.T.ravel()[:n].astype(np.int64)
    return np.flatnonzero(starts.ravel()[before * 9 + sym])


def pieces(texts: list[str]) -> Iterator[list[bytes]]:
    """The pieces of each text, as UTF-8."""
    joined = "\U0010ffff".join(texts)  # a place holder: its positions are overwritten below
    raw = np.frombuffer(joined.encode("utf-32-le"), "<u4")
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(lengths + 1) - 1
    cps = np.empty(len(raw) + 1, np.uint32)
    cps[:-1] = raw
    cps[ends] = SENTINEL
    starts = piece_starts(symbols(cps))
    data = b"".join(t.encode() for t in texts)
    size = 1 + (cps >= 0x80) + (cps >= 0x800) + (cps >= 0x10000).astype(np.int64)
    size[ends] = 0
    offset = np.concatenate([[0], np.cumsum(size)])
    cuts = offset[starts].tolist() + [len(data)]
    first = np.searchsorted(starts, np.concatenate([[0], ends + 1])).tolist()
    for i in range(len(texts)):
        a, b = first[i], first[i + 1]
        yield [data[x:y] for x, y in zip(cuts[a:b], cuts[a + 1 : b + 1])]


class Merger(dict):
    """Maps a piece to its ids; merges on a miss, always the lowest-ranked leftmost pair."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(None, map(bytes.strip, lines)))}
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.lengths = np.fromiter(map(len, self.tokens), np.int64, len(self.tokens))

    def __missing__(self, piece: bytes) -> tuple[int, ...]:
        if len(self) >= CACHE:
            self.clear()
        found = self.ranks.get(piece)
        ids = (found,) if found is not None else tuple(self.short(piece) if len(piece) <= 40 else self.long(piece))
        if len(piece) <= 200:
            self[piece] = ids
        return ids

    def short(self, piece: bytes) -> list[int]:
        get, far = self.ranks.get, len(self.tokens)
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pair = [get(a + b, far) for a, b in zip(parts, parts[1:])]
        while pair and (low := min(pair)) < far:
            i = pair.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pair[i]
            if i < len(pair):
                pair[i] = get(parts[i] + parts[i + 1], far)
            if i:
                pair[i - 1] = get(parts[i - 1] + parts[i], far)
        return [self.ranks[p] for p in parts]

    def long(self, piece: bytes) -> list[int]:
        """The same by a heap and a linked list: n log n for very long pieces."""
        n, get = len(piece), self.ranks.get
        end, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
        alive = bytearray(b"\1") * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not alive[i] or (j := after[i]) >= n or end[j] != stop:
                continue
            alive[j], end[i], after[i] = 0, stop, after[j]
            if after[i] < n:
                before[after[i]] = i
                if (r := get(piece[i : end[after[i]]])) is not None:
                    heapq.heappush(heap, (r, i, end[after[i]]))
            if (h := before[i]) >= 0 and (r := get(piece[h:stop])) is not None:
                heapq.heappush(heap, (r, h, stop))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i : end[i]]])
            i = after[i]
        return out


@functools.lru_cache(2)
def merger(path: str) -> Merger:
    return Merger(path)


def encode_texts(texts: list[str], path: str) -> Iterator[np.ndarray]:
    """The ids of each text, as little-endian unsigned 32-bit integers."""
    merges, flat = merger(path), itertools.chain.from_iterable
    part, size = [], 0
    for text in [*texts, None]:
        if text is None or part and size + len(text) > CHUNK:
            for found in pieces(part) if part else ():
                yield np.fromiter(flat(map(merges.__getitem__, found)), "<u4")
            part, size = [], 0
        if text is not None:
            part.append(text)
            size += len(text)


def encode(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Adds n_tokens (long), ids (binary: little-endian unsigned 32-bit) and ends (binary, likewise 64-bit: the
    byte offset at which each token ends); the text itself is dropped."""
    common.small_batches(df.sparkSession)
    keep = [c for c in df.columns if c not in (text, "n_tokens", "ids", "ends")]
    (own,) = common.fresh(df, "own_text")
    named = [f"`{c}`" for c in keep]
    source = df.select(*named, F.coalesce(F.col(f"`{text}`"), F.lit("")).alias(own))
    schema = source.select(*named, F.lit(0).cast("long").alias("n_tokens"), F.lit(b"").alias("ids"), F.lit(b"").alias("ends")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = merger(path).lengths
        for batch in batches:
            found = list(encode_texts(batch.column(len(keep)).to_pylist(), path))
            columns = [*batch.columns[: len(keep)], pa.array(map(len, found), pa.int64()), pa.array([x.tobytes() for x in found], pa.binary()), pa.array([np.cumsum(lengths[x]).astype("<i8").tobytes() for x in found], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "n_tokens", "ids", "ends"])

    return source.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids: str = "ids", ends: str = "ends") -> DataFrame:
    """Adds decoded (binary): the tokens' bytes; the retained offsets are checked against it."""
    keep = [c for c in df.columns if c not in (ids, ends, "decoded")]
    named = [f"`{c}`" for c in keep]
    source = df.select(*named, ids, ends)
    schema = source.select(*named, F.lit(b"").alias("decoded")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = merger(path).tokens
        for batch in batches:
            out = []
            for own, stops in zip(batch.column(len(keep)).to_pylist(), batch.column(len(keep) + 1).to_pylist()):
                made = b"".join(map(tokens.__getitem__, np.frombuffer(own or b"", "<u4").tolist()))
                if stops and int.from_bytes(stops[-8:], "little") != len(made):
                    raise ValueError("the retained offsets don't fit the decoded bytes")
                out.append(made)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(out, pa.binary())], [*keep, "decoded"])

    return source.mapInArrow(run, schema)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = default_path()
    encoded = encode(common.table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    packed = encoded.withColumn("ids_sha256", F.sha2(F.col("ids"), 256))
    return decode(packed, path).select("doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
