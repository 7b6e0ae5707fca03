"""Benchmark passages in documents: CGK random walks, bit sampling, edit distance.

A CGK walk reads a word sequence once per step and goes on to the next word or stays, as a random
bit of the word says; sequences within a small edit distance fall into step again, so their walks
agree at most steps (the Hamming distance follows the edit distance). Each table samples a few
steps of a walk as its key. Walks take as many steps as the shortest items of their class have words.
In items of 24 words and more they start at words that are the least of some four in a row, which an
item and a document choose alike; in shorter ones they start at every word. There are as many walks as
random items with as many edits as are allowed need to be found at ``TARGET``. Items too short for any
edit are looked up by the hash of all their words.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm import hashing as H
from tillroll.llm.columns import rows_of
from tillroll.llm.store import stored

#: Words of benchmark items held by a task at once; larger benchmarks are searched in several passes.
BLOCK_WORDS = 1_000_000
SIMILARITY = 0.8
#: Share of items with the most edits that the walks are to find.
TARGET = 0.98
#: Random items that the share is taken from.
TRIALS = 1000
TABLES = 3
SAMPLES = 4
#: Words an item has at least, and steps of its walks.
STEPS = ((24, 20), (8, 8), (3, 3))
#: Walks of at least so many steps start at chosen words, shorter ones at every word.
CHOSEN_FROM = 20
NEIGHBOURS = 4
#: Items of fewer words are not looked for: too many texts have them by chance.
LEAST_WORDS = 3

CANDIDATE = "doc_id long, item_id long, diagonal long, first long, words binary, item binary"
FOUND = "doc_id long, item_id long, edits long, similarity double, first_word long, n_words long"


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a block (letters and digits, A-Z as a-z), and where each text's begin."""
    words = H.Words(H.LOWER[data], offsets, H.LETTERS)
    return words.hashes(), words.first


def start_words(hashes: np.ndarray) -> np.ndarray:
    """Positions that hold the least hash of some ``NEIGHBOURS`` words in a row."""
    n = len(hashes) - NEIGHBOURS + 1
    if n < 1:
        return np.arange(len(hashes))
    order = H.mix(hashes ^ np.uint64(0x5851F42D4C957F2D))
    least = reduce(np.minimum, (order[k : k + n] for k in range(NEIGHBOURS)))
    chosen = np.zeros(len(hashes), bool)
    for k in range(NEIGHBOURS):
        chosen[k : k + n] |= order[k : k + n] == least
    return np.flatnonzero(chosen)


def starts_of(hashes: np.ndarray, steps: int) -> np.ndarray:
    return start_words(hashes) if steps >= CHOSEN_FROM else np.arange(len(hashes))


def walk_keys(hashes: np.ndarray, starts: np.ndarray, steps: int, walks: range) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each walk and table a key per start, and where that walk ended."""
    padded = np.concatenate((hashes, np.zeros(steps, np.uint64)))
    cuts = np.linspace(0, steps, SAMPLES + 1).astype(int)
    for walk in walks:
        rng = np.random.default_rng([steps, walk, TABLES, SAMPLES])
        turns = H.mix(padded ^ np.uint64(rng.integers(1 << 62)))
        # One sampled step from each part of the walk.
        chosen = [[int(rng.integers(a, b)) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b > a] for _ in range(TABLES)]
        wanted = {t for steps_of in chosen for t in steps_of}
        at, seen = starts.copy(), {}
        for t in range(steps):
            if t in wanted:
                seen[t] = padded[at]
            at += ((turns[at] >> np.uint64(t)) & np.uint64(1)).astype(at.dtype)
        for table, steps_of in enumerate(chosen):
            key = np.full(len(starts), 1 + walk * TABLES + table, np.uint64)
            for t in steps_of:
                key = key * np.uint64(0x9E3779B97F4A7C15) + seen[t]
            yield H.mix(key), at


def edits_allowed(size: int, similarity: float) -> int:
    return math.floor((1 - similarity) * size + 1e-9)


@lru_cache(maxsize=4096)
def walks_needed(size: int, edits: int, steps: int, target: float = TARGET) -> int:
    """Walks after which a share of ``target`` of random items of ``size`` words is found in a text that
    holds them with ``edits`` random edits."""
    rng = np.random.default_rng([size, edits, steps])
    gap = 2 * steps
    items, texts = [], []
    for _ in range(TRIALS):
        item = rng.integers(1, 1 << 62, size).astype(np.uint64)
        words = item.tolist()
        for _ in range(edits):
            at, kind, new = int(rng.integers(len(words))), int(rng.integers(3)), int(rng.integers(1, 1 << 62))
            words[at : at + 1] = [[], [new], [words[at], new]][kind]
        items.append(item)
        # Other words before and after, as in a document.
        around = rng.integers(1, 1 << 62, 2 * gap).tolist()
        texts.append(np.array(around[:gap] + words + around[gap:], np.uint64))
    whole, text = np.concatenate(items), np.concatenate(texts)
    owner = np.repeat(np.arange(TRIALS), [len(t) for t in texts])
    starts = np.concatenate([n * size + starts_of(item, steps) for n, item in enumerate(items)])
    text_starts = starts_of(text, steps)
    number = starts // size
    found = np.zeros(TRIALS, bool)
    walk = 0
    while found.mean() < target:
        ours, theirs = (walk_keys(x, at, steps, range(walk, walk + 1)) for x, at in ((whole, starts), (text, text_starts)))
        for (key, stop), (other, _) in zip(ours, theirs, strict=True):
            inside = stop <= (number + 1) * size
            pairs = (key ^ H.mix(number.astype(np.uint64)))[inside]
            same = np.isin(pairs, other ^ H.mix(owner[text_starts].astype(np.uint64)))
            found[number[inside][same]] = True
        walk += 1
    return walk


def steps_of(size: int, similarity: float) -> int:
    """Steps of the walks of an item of ``size`` words; none for one without edits."""
    return next(steps for least, steps in STEPS if least <= size) if edits_allowed(size, similarity) else 0


def walks_of(sizes: Iterable[int], similarity: float) -> dict[int, int]:
    """The walks that items of these sizes need, by the steps of their walks."""
    walks: dict[int, int] = {}
    for size in {size for size in sizes if size >= LEAST_WORDS}:
        if steps := steps_of(size, similarity):
            walks[steps] = max(walks.get(steps, 0), walks_needed(size, edits_allowed(size, similarity), steps))
    return walks


class Index:
    """The keys of a block of benchmark items; ``walks`` has the number of walks by their steps, if it is known."""

    def __init__(self, items: list[tuple[int, str]], similarity: float = SIMILARITY, walks: dict[int, int] | None = None):
        texts = pa.array([text for _, text in items], pa.large_string())
        hashes, first = word_hashes(*H.text_bytes(texts))
        self.item_ids = [item for item, _ in items]
        self.words = [hashes[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
        #: Items without edits by their size, the others by the steps of their walks.
        whole: dict[int, list[int]] = {}
        walked: dict[int, list[int]] = {}
        for number, words in enumerate(self.words):
            size = len(words)
            if size < LEAST_WORDS:
                continue
            steps = steps_of(size, similarity)
            (walked.setdefault(steps, []) if steps else whole.setdefault(size, [])).append(number)
        self.whole = {size: _table([self._whole(size, np.array(numbers, np.int32))]) for size, numbers in whole.items()}
        self.walks = walks if walks is not None else walks_of(map(len, self.words), similarity)
        self.tables = {steps: _table(self._entries(steps, np.array(numbers, np.int32))) for steps, numbers in walked.items()}

    def _whole(self, size: int, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys = H.gram_hashes(np.concatenate([self.words[n] for n in numbers]), size)[::size]
        return keys, numbers, np.zeros(len(numbers), np.int32)

    def _entries(self, steps: int, numbers: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Keys, items and positions in them of each walk and table, of all items at once."""
        words = [self.words[n] for n in numbers]
        # Behind each item as many empty words as a walk may take beyond its end.
        begin = np.concatenate(([0], np.cumsum([len(w) + steps for w in words])))
        laid_out = np.zeros(begin[-1], np.uint64)
        for a, w in zip(begin.tolist(), words, strict=False):
            laid_out[a : a + len(w)] = w
        offsets = [starts_of(w, steps) for w in words]
        owner = np.repeat(np.arange(len(words), dtype=np.int32), [len(x) for x in offsets])
        offset = np.concatenate(offsets).astype(np.int32)
        for key, stop in walk_keys(laid_out, begin[owner] + offset, steps, range(self.walks[steps])):
            inside = stop <= begin[owner + 1] - steps
            yield key[inside], numbers[owner[inside]], offset[inside]

    def hits(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word positions, item numbers and positions in the items, of all equal keys."""
        out = []
        for size, table in self.whole.items():
            keys = H.gram_hashes(hashes, size)
            out.append(_look_up(table, keys, np.arange(len(keys))))
        for steps, table in self.tables.items():
            starts = starts_of(hashes, steps)
            for key, _ in walk_keys(hashes, starts, steps, range(self.walks[steps])):
                out.append(_look_up(table, key, starts))
        if not out:
            return (np.zeros(0, np.int64),) * 3
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _table(entries: Iterable[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, ...]:
    """Sorted distinct keys, and for the entries of each key the items and positions."""
    key, number, offset = (np.concatenate(x) for x in zip(*entries, strict=True))
    order = np.argsort(key, kind="stable")
    unique, first_entry = np.unique(key[order], return_index=True)
    return unique, np.append(first_entry, len(key)), number[order], offset[order]


def _look_up(table: tuple[np.ndarray, ...], key: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    unique, first, number, offset = table
    if not len(unique):
        return (np.zeros(0, np.int64),) * 3
    slot = np.minimum(np.searchsorted(unique, key), len(unique) - 1)
    hit = np.flatnonzero(unique[slot] == key)
    count = first[slot[hit] + 1] - first[slot[hit]]
    entry = H.ranges(first[slot[hit]], count)
    return np.repeat(starts[hit], count), number[entry], offset[entry]


def nearest(item: np.ndarray, words: np.ndarray) -> tuple[int, int]:
    """The least edit distance of ``item`` to any stretch of ``words``, and where that stretch ends.

    Bit-parallel: one integer holds a column of the dynamic programme.
    """
    masks: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        masks[w] = masks.get(w, 0) | 1 << i
    full, top = (1 << len(item)) - 1, 1 << (len(item) - 1)
    plus, minus, score = full, 0, len(item)
    best, end = score, 0
    for j, w in enumerate(words.tolist()):
        match = masks.get(w, 0)
        zero = ((((match & plus) + plus) ^ plus) | match | minus) & full
        up, down = (minus | ~(zero | plus)) & full, plus & zero
        score += bool(up & top) - bool(down & top)
        up, down = (up << 1) & full, (down << 1) & full
        plus, minus = (down | ~(zero | up)) & full, up & zero
        if score < best:
            best, end = score, j + 1
    return best, end


@lru_cache(maxsize=1)
def _index(items: bytes, walks: tuple[tuple[int, int], ...], similarity: float) -> Index:
    """The index of a packed block, which a worker makes once for its tasks."""
    with pa.ipc.open_stream(pa.py_buffer(items)) as reader:
        index = Index([tuple(r.values()) for r in reader.read_all().to_pylist()], similarity, dict(walks))
    H.trim()
    return index


def _packed(items: DataFrame) -> bytes:
    """The items, sorted, as bytes for the tasks."""
    rows = sorted(((r[0], r[1]) for r in items.collect()), key=str)
    table = pa.table([pa.array([x[k] for x in rows], kind) for k, kind in enumerate((pa.int64(), pa.large_string()))], ["item_id", "text"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _sizes(items: DataFrame, parts: int) -> dict[int, list[int]]:
    """The different numbers of words of each block's items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in H.blocks(batches):
            _, first = word_hashes(*H.text_bytes(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("part"), pa.array(np.diff(first).astype(np.int64))], ["part", "size"])

    rows = items.select(_part(parts).cast("long").alias("part"), "text").mapInArrow(H.trimmed(run), "part long, size long")
    found: dict[int, list[int]] = {}
    for part, size in rows.distinct().collect():
        found.setdefault(part, []).append(size)
    return found


def _part(parts: int) -> Column:
    return F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))


def _candidates(docs: DataFrame, items: bytes, walks: tuple[tuple[int, int], ...], similarity: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(items, walks, similarity)
        for batch in H.blocks(batches):
            hashes, first = word_hashes(*H.text_bytes(batch.column("text")))
            position, number, offset = index.hits(hashes)
            doc = np.searchsorted(first, position, "right") - 1
            diagonal = position - offset - first[doc]
            doc, number, diagonal = np.unique(np.stack([doc, number, diagonal]), axis=1)
            # One window for the hits of a document and item whose diagonals lie close together.
            rows, last = [], None
            ids = batch.column("doc_id").to_pylist()
            for d, k, g in zip(doc.tolist(), number.tolist(), diagonal.tolist(), strict=True):
                size = len(index.words[k])
                slack = edits_allowed(size, similarity)
                if last and last[:2] == (d, k) and g - last[2] <= slack:
                    continue
                last = (d, k, g)
                low = max(int(first[d]), int(first[d]) + g - slack)
                high = min(int(first[d + 1]), int(first[d]) + g + size + 3 * slack)
                if high > low:
                    rows.append((ids[d], index.item_ids[k], g, low - int(first[d]), hashes[low:high].tobytes(), index.words[k].tobytes()))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), [pa.int64()] * 4 + [pa.binary()] * 2, strict=True)],
                    ["doc_id", "item_id", "diagonal", "first", "words", "item"],
                )

    return docs.mapInArrow(H.trimmed(run), CANDIDATE)


def _verified(candidates: DataFrame, similarity: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, item_id, _, first, words, item in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                pattern = np.frombuffer(item, np.uint64)
                edits, end = nearest(pattern, np.frombuffer(words, np.uint64))
                close = 1 - edits / len(pattern)
                if close >= similarity - 1e-9:
                    rows.append((doc_id, item_id, edits, close, max(0, first + end - len(pattern)), len(pattern)))
            kinds = [pa.int64()] * 3 + [pa.float64()] + [pa.int64()] * 2
            columns = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], [x.split()[0] for x in FOUND.split(", ")]
            )

    return candidates.mapInArrow(H.trimmed(run), FOUND)


def leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document and benchmark item found in it: doc_id, item_id, edits, similarity,
    first_word, n_words; the best place of each.

    An item of n words is in a document if some stretch of its words is within (1 - similarity) * n
    word edits (so items of fewer than five words must be there as they are, and are then always found).
    Of those with the most edits ``TARGET`` are found, of those with fewer, more. Items of fewer than
    three words, empty or null ones are not looked for; null texts have no words; a null doc_id or
    item_id is carried like any other; repeated rows give one row; empty tables give an empty result.
    The benchmark is the query set: it is held by the tasks in blocks of ``block_words`` words, each
    of which is one pass over all documents. The driver holds the texts of one block at a time, and the
    tasks make its index.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    items = benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("long"), "text").distinct()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, math.ceil(total / (5 * block_words)))
    sizes = _sizes(items, parts)
    found = []
    for part in range(parts):
        walks = tuple(sorted(walks_of(sizes.get(part, []), similarity).items()))
        hits = _candidates(texts, _packed(items.where(_part(parts) == part)), walks, similarity)
        # Stored, so that the block can go before the next one comes.
        found.append(stored(hits) if parts > 1 else hits)
    candidates = reduce(DataFrame.union, found).dropDuplicates()
    best = F.min(F.struct("edits", "first_word", "similarity", "n_words")).alias("best")
    return (
        _verified(candidates, similarity)
        .groupBy("doc_id", "item_id")
        .agg(best)
        .select("doc_id", "item_id", "best.edits", "best.similarity", "best.first_word", "best.n_words")
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` whose doc_id has no benchmark passage."""
    return rows_of(docs, leaks(docs, benchmark, similarity), "left_anti")
