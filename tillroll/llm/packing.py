"""Packing documents into windows of tokens by a non-negative least squares plan.

A document is cut into whole windows and a tail. Only the histogram of tail lengths (window - 1
numbers at most) comes to the driver. There, combinations of two or three lengths that fill a window
are enumerated, their repeat counts are fitted to the histogram under x >= 0 and rounded down, and
what remains is packed greedily. The plan names tails by length and rank, so every task places its own.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm import hashing as H
from tillroll.llm import tokens
from tillroll.llm.store import stored

WINDOW = 2048
#: Lengths of combinations of three are multiples of this, but for the last one's rest.
GRID = 32
STEPS = 400

PIECE = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def combinations(window: int, present: np.ndarray) -> np.ndarray:
    """Rows of up to three lengths (0: none) that sum to ``window``, all of them present."""
    have = np.zeros(window + 1, bool)
    have[present] = True
    have[0] = False
    a = np.arange(1, window // 2 + 1)
    pairs = np.stack([a, window - a, np.zeros_like(a)], axis=1)
    grid = np.arange(GRID, window, GRID)
    x, y = np.meshgrid(grid, grid, indexing="ij")
    z = window - x - y
    right = (x <= y) & (y <= z)
    triples = np.stack([x[right], y[right], z[right]], axis=1)
    both = np.concatenate([pairs, triples])
    return both[(have[both] | (both == 0)).all(axis=1)]


def non_negative_least_squares(combos: np.ndarray, histogram: np.ndarray) -> np.ndarray:
    """x >= 0 that brings the number of uses of each length near ``histogram``: accelerated projected
    gradient steps on |A x - h|^2, where column c of A counts the lengths in combination c."""
    used = combos > 0

    def uses(x: np.ndarray) -> np.ndarray:
        return np.bincount(combos[used], np.broadcast_to(x[:, None], combos.shape)[used], minlength=len(histogram))

    def back(r: np.ndarray) -> np.ndarray:
        return (r[combos] * used).sum(axis=1)

    v = np.ones(len(combos))
    for _ in range(30):
        v = back(uses(v))
        v /= np.linalg.norm(v)
    step = 0.95 / np.linalg.norm(back(uses(v)))
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(STEPS):
        new = np.maximum(0, y - step * back(uses(y) - histogram))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        x, y, t = new, new + (t - 1) / t_new * (new - x), t_new
    return x


class Plan:
    """Where the tail of each length and rank goes. ``first``: the first free sequence number."""

    def __init__(self, histogram: np.ndarray, window: int, first: int):
        self.window = window
        left = histogram.astype(np.int64).copy()
        taken = np.zeros_like(left)
        #: By length: first rank, sequence (or start in the stream of the rest), offset, whether rest.
        self.entries: list[list[tuple[int, int, int, bool]]] = [[] for _ in range(window)]
        combos = combinations(window, np.flatnonzero(left))
        if len(combos):
            repeats = np.floor(non_negative_least_squares(combos, left.astype(float)) + 1e-6).astype(np.int64)
            for c in np.argsort(-repeats, kind="stable").tolist():
                lengths = [x for x in combos[c].tolist() if x]
                n = min(int(repeats[c]), *(int(left[x]) // lengths.count(x) for x in lengths))
                if n < 1:
                    continue
                offset = 0
                for x in lengths:
                    self.entries[x].append((int(taken[x]), first, offset, False))
                    taken[x] += n
                    left[x] -= n
                    offset += x
                first += n
        # The rest, longest first, fills one window after the other; a tail is cut where one is full.
        self.rest, position = first, 0
        for x in np.flatnonzero(left)[::-1].tolist():
            self.entries[x].append((int(taken[x]), position, 0, True))
            position += x * int(left[x])
        self.first_ranks = [[e[0] for e in es] for es in self.entries]

    def place(self, length: int, rank: int) -> list[tuple[int, int, int]]:
        """(sequence, offset, ids) of the pieces of a tail."""
        start, at, offset, rest = self.entries[length][bisect_right(self.first_ranks[length], rank) - 1]
        if not rest:
            return [(at + rank - start, offset, length)]
        position, out = at + (rank - start) * length, []
        while length:
            offset = position % self.window
            n = min(length, self.window - offset)
            out.append((self.rest + position // self.window, offset, n))
            position, length = position + n, length - n
        return out


def encoded(docs: DataFrame, path: str, end: int, window: int) -> DataFrame:
    """The ids of each row with ``end`` after them, written once: part, doc_id, n, tail, rank of the
    tail among those of its length in the part, whole windows before it in the part, ids (16 bits)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, ranks, blocks = TaskContext.get().partitionId(), np.zeros(window, np.int64), 0
        encoder = tokens.encoder(path)
        for batch in H.blocks(batches, limit=tokens.BLOCK_BYTES):
            ids, counts = tokens.with_end(*encoder.block(batch.column("text")), end)
            tail = counts % window
            order = np.argsort(tail, kind="stable")
            run_start = np.searchsorted(tail[order], tail[order], "left")
            rank = np.empty(len(tail), np.int64)
            rank[order] = np.arange(len(tail)) - run_start + ranks[tail[order]]
            ranks += np.bincount(tail, minlength=window)
            whole = counts // window
            before = blocks + np.cumsum(whole) - whole
            blocks += int(whole.sum())
            ends = np.concatenate(([0], np.cumsum(counts))) * 2
            raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(ids)]).cast(pa.binary())
            columns = [pa.array(np.full(len(counts), part, np.int32)), batch.column("doc_id"), pa.array(counts), pa.array(tail.astype(np.int32)), pa.array(rank), pa.array(before), raw]
            yield pa.RecordBatch.from_arrays(columns, ["part", "doc_id", "n", "tail", "rank", "blocks", "ids"])

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return stored(rows.mapInArrow(H.trimmed(run), "part int, doc_id long, n long, tail int, rank long, blocks long, ids binary"))


def packed(docs: DataFrame, path: str, end: int = 1, window: int = WINDOW) -> DataFrame:
    """One row per piece: doc_id, start and length in its document's ids, doc_tokens, sequence_id,
    offset there, ids (little-endian, 32 bits).

    Every sequence but the last is full. A null text is the end id alone; a null doc_id is carried;
    repeated rows are packed as often; an empty table gives no piece; other columns are not read.
    """
    rows = encoded(docs, path, end, window)
    counts = rows.groupBy("part", "tail").agg(F.count("*").alias("n_tails"))
    earlier = Window.partitionBy("tail").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select("part", "tail", F.coalesce(F.sum("n_tails").over(earlier), F.lit(0)).alias("shift"))
    histogram = np.zeros(window, np.int64)
    for length, n in counts.groupBy("tail").agg(F.sum("n_tails")).collect():
        histogram[length] = n
    histogram[0] = 0
    # One number per part.
    first_block, total = {}, 0
    for part, n in sorted(rows.groupBy("part").agg(F.sum(F.expr(f"n div {window}"))).collect()):
        first_block[part] = total
        total += n
    plan = Plan(histogram, window, total)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in H.blocks([batch], "ids", 4 << 20):
                out = []
                for part, doc_id, n, tail, rank, block, raw, more in zip(*(some.column(x).to_pylist() for x in ("part", "doc_id", "n", "tail", "rank", "blocks", "ids", "shift")), strict=True):
                    ids = np.frombuffer(raw, np.uint16).astype("<u4").tobytes()
                    places = [(first_block[part] + block + i, 0, window) for i in range(n // window)]
                    if tail:
                        places += plan.place(tail, rank + more)
                    start = 0
                    for sequence, offset, size in places:
                        out.append((doc_id, start, size, n, sequence, offset, ids[4 * start : 4 * (start + size)]))
                        start += size
                columns = list(zip(*out, strict=True)) or [()] * 7
                kinds = [pa.int64()] * 6 + [pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [x.split()[0] for x in PIECE.split(", ")])

    return rows.join(shift, ["part", "tail"]).mapInArrow(H.trimmed(run), PIECE)
