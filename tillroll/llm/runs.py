"""Periodic runs of words, by internal pattern matching.

The words of a block of documents are one sequence. Every block of 2**k words at a multiple of 2**k
asks for its occurrences in the window after it where a period that fits its size would repeat it: the
occurrences are the starts in a range of the suffix array, and a wavelet tree over the suffix array
counts and finds those inside the window. They form one arithmetic progression, whose members are
candidate periods. Neighbouring blocks with one candidate are joined and extended to a maximal run.

A run of period q and 4q words or more holds such a block of L words, L the largest power of two up to
(3q+1)/2, at one of its first L places, and that block occurs again q words on, still in the run. So a
block of L words need only look for periods from (2L-1)/3 to (4L-2)/3. Of three or more occurrences
(they then lie in a run of the block's own smaller period p) only the first one and those that match
the ends of the two p-runs can be the period.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm import hashing as H

#: A run has so many words and so many times its period at least.
LEAST_WORDS = 6
LEAST_TIMES = 4
#: Bytes of text that share a suffix array; a longer text has its own, at about 100 bytes a word.
BLOCK_BYTES = 2 << 20
#: Words compared at once where a run is extended.
STRETCH = 1 << 20


class WaveletTree:
    """Order statistics over stretches of a sequence of numbers below 2**bits, for many queries at once."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits = bits
        self.zeros: list[np.ndarray] = []
        for bit in reversed(range(bits)):
            one = (values >> bit & 1).astype(bool)
            before = np.zeros(len(values) + 1, np.int32)
            np.cumsum(~one, out=before[1:])
            self.zeros.append(before)
            values = np.concatenate((values[~one], values[one]))

    def below(self, lo: np.ndarray, hi: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """How many numbers of each stretch [lo, hi) are below ``limit``."""
        found = np.where(limit >> self.bits > 0, hi - lo, 0)
        lo, hi = lo.copy(), np.where(limit >> self.bits > 0, lo, hi)
        for level, before in enumerate(self.zeros):
            one = (limit >> (self.bits - 1 - level) & 1).astype(bool)
            lo0, hi0 = before[lo], before[hi]
            found += np.where(one, hi0 - lo0, 0)
            lo = np.where(one, before[-1] + lo - lo0, lo0)
            hi = np.where(one, before[-1] + hi - hi0, hi0)
        return found

    def nth(self, lo: np.ndarray, hi: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The n-th smallest number (from 0) of each stretch."""
        found = np.zeros(len(lo), np.int64)
        for level, before in enumerate(self.zeros):
            lo0, hi0 = before[lo], before[hi]
            one = n >= hi0 - lo0
            found |= one.astype(np.int64) << (self.bits - 1 - level)
            n = np.where(one, n - (hi0 - lo0), n)
            lo = np.where(one, before[-1] + lo - lo0, lo0)
            hi = np.where(one, before[-1] + hi - hi0, hi0)
        return found


def periods_of(size: int) -> tuple[int, int]:
    """The periods that blocks of ``size`` words look for."""
    return -(-(2 * size - 1) // 3), (4 * size - 2) // 3


def suffix_ranges(words: np.ndarray, longest: int) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]]:
    """The suffix array, sorted as deep as runs in ``longest`` words need, and for each block size the
    blocks that occur twice or more with their range in it.

    Prefixes are doubled; only suffixes that share theirs with another one are sorted again. The last
    number of ``words`` must be unique, as must one between any two documents.
    """
    n = len(words)
    suffixes = np.argsort(words, kind="stable")
    new = np.ones(n, bool)
    new[1:] = words[suffixes[1:]] != words[suffixes[:-1]]
    slots = np.arange(n)
    rank = np.empty(n, np.int64)
    rank[suffixes] = np.maximum.accumulate(np.where(new, slots, 0))
    alone = new & np.append(new[1:], True)
    slots = slots[~alone]
    levels = []
    size = 2
    while len(slots) and LEAST_TIMES * periods_of(size)[0] <= longest:
        own = suffixes[slots]
        key = rank[own] * n + rank[own + size // 2]
        order = np.argsort(key, kind="stable")
        own, key = own[order], key[order]
        suffixes[slots] = own
        new = np.ones(len(own), bool)
        new[1:] = key[1:] != key[:-1]
        first = np.flatnonzero(new)
        count = np.diff(first, append=len(own))
        rank[own] = np.repeat(slots[first], count)
        counts = np.repeat(count, count)
        block = (counts > 1) & (own % size == 0)
        levels.append((size, own[block], rank[own[block]], rank[own[block]] + counts[block]))
        slots = slots[counts > 1]
        size *= 2
    return suffixes, levels


def reach(words: np.ndarray, at: np.ndarray, shift: np.ndarray, step: int, limit: int | None = None) -> np.ndarray:
    """How far words[i] == words[i + shift] holds for i = at, at + step, ... (step 1 or -1)."""
    n = len(words)
    found = np.zeros(len(at), np.int64)
    left = np.arange(len(at))
    width = 8
    while len(left):
        width = max(1, min(width, STRETCH // len(left)))
        i = (at[left] + step * found[left])[:, None] + step * np.arange(width)
        j = i + shift[left][:, None]
        inside = (i >= 0) & (i < n) & (j >= 0) & (j < n)
        same = inside & (words[np.where(inside, i, 0)] == words[np.where(inside, j, 0)])
        equal = np.where(same.all(axis=1), width, same.argmin(axis=1))
        found[left] += equal
        left = left[equal == width]
        if limit is not None:
            left = left[found[left] < limit]
        width *= 2
    return found


def candidates(words: np.ndarray, tree: WaveletTree, size: int, at: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Blocks of ``size`` words and the distances to their later occurrences that may be periods."""
    least, most = periods_of(size)
    before = tree.below(lo, hi, at + least)
    count = tree.below(lo, hi, at + most + 1) - before
    some = count > 0
    at, lo, hi, before, count = at[some], lo[some], hi[some], before[some], count[some]
    first = tree.nth(lo, hi, before) - at
    last = tree.nth(lo, hi, before + count - 1) - at
    found = [(at, first), (at[count == 2], last[count == 2])]
    many = count > 2
    if many.any():
        at, first, last = at[many], first[many], last[many]
        step = (last - first) // (count[many] - 1)
        # The run of period ``step`` around the block, and the one around its occurrences.
        again = at + first
        starts = [p - reach(words, p - 1, step, -1, 2 * size) for p in (at, again)]
        ends = [p + size + reach(words, p + size - step, step, 1, 2 * size) for p in (at, again)]
        for distance in (starts[1] - starts[0], ends[1] - ends[0]):
            fits = (distance >= first) & (distance <= last) & ((distance - first) % step == 0)
            found.append((at[fits], distance[fits]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def periodic_runs(words: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """start, length and smallest period of all maximal runs, by start, then period."""
    suffixes, levels = suffix_ranges(words, longest)
    tree = WaveletTree(suffixes, max(1, int(len(words)).bit_length()))
    found = []
    for size, at, lo, hi in levels:
        block, period = candidates(words, tree, size, at, lo, hi)
        if not len(block):
            continue
        order = np.lexsort((block, period))
        block, period = block[order], period[order]
        follows = np.zeros(len(block), bool)
        follows[1:] = (period[1:] == period[:-1]) & (block[1:] - block[:-1] <= size)
        first = np.flatnonzero(~follows)
        ends = np.append(first[1:], len(block)) - 1
        period = period[first]
        start = block[first] - reach(words, block[first] - 1, period, -1)
        end = block[ends] + size
        end = end + reach(words, end, period, 1) + period
        enough = end - start >= np.maximum(LEAST_WORDS, LEAST_TIMES * period)
        found.append((start[enough], (end - start)[enough], period[enough]))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    start, length, period = (np.concatenate(x) for x in zip(*found, strict=True))
    # A run found by a multiple of its period has the same start and length.
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def runs_of_block(texts: pa.Array) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """Number of words, runs and collapsed text of each text."""
    data, offsets = H.text_bytes(texts)
    words = H.Words(data, offsets, H.VISIBLE)
    n_docs, n = len(texts), len(words.starts)
    sizes = words.ends - words.starts
    at = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    raw = np.ascontiguousarray(data[words.inside])
    coded = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(at), pa.py_buffer(raw)]).dictionary_encode()
    # A number of its own after each text parts it from the next one.
    place = np.arange(n) + words.doc
    sequence = np.empty(n + n_docs, np.int64)
    sequence[place] = coded.indices.to_numpy(zero_copy_only=False)
    sequence[words.first[1:] + np.arange(n_docs)] = len(coded.dictionary) + np.arange(n_docs)
    start, length, period = periodic_runs(sequence, int(words.counts.max(initial=0)))

    shift = words.first[:-1] + np.arange(n_docs)
    doc = np.searchsorted(shift, start, "right") - 1
    cover = np.zeros(n + n_docs + 1, np.int64)
    np.add.at(cover, start + period, 1)
    np.add.at(cover, start + length, -1)
    kept = np.flatnonzero(np.cumsum(cover)[place] == 0)
    # The kept words with a space before all but the first of a text; the space is read from one in front.
    own = words.doc[kept]
    gap = np.zeros(len(kept), np.int64)
    gap[1:] = own[1:] == own[:-1]
    out = np.full(int(sizes[kept].sum() + gap.sum()), 0x20, np.uint8)
    ends = np.cumsum(sizes[kept] + gap)
    source = H.ranges(at[:-1][kept], sizes[kept])
    out[H.ranges(ends - sizes[kept], sizes[kept])] = raw[source]
    text_ends = np.concatenate(([0], ends))[np.searchsorted(own, np.arange(n_docs + 1))].astype(np.int64)
    collapsed = pa.Array.from_buffers(pa.large_string(), n_docs, [None, pa.py_buffer(text_ends), pa.py_buffer(out)])

    structs = pa.StructArray.from_arrays([pa.array(x) for x in (start - shift[doc] if len(start) else start, length, period)], ["start", "length", "period"])
    cuts = np.searchsorted(doc, np.arange(n_docs + 1)).astype(np.int32)
    return words.counts.astype(np.int64), pa.ListArray.from_arrays(pa.array(cuts), structs), collapsed.cast(pa.string())


def runs(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, runs, collapsed.

    ``runs`` are the maximal stretches of words with smallest period q and max(6, 4q) words or more
    (start, length, period; by start, then period). ``collapsed`` is the text, its words parted by one
    space, without the words that some run holds after its first q. A null text has no words; a null
    doc_id stays null; repeated rows are treated alike; an empty table gives an empty result; other columns
    are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in H.blocks(batches, limit=BLOCK_BYTES):
            counts, found, collapsed = runs_of_block(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts), found, collapsed], ["doc_id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def repeating(text: str, h: int) -> str:
    """The text whose words from the a-th on repeat p words (see ``with_repeats``)."""
    words = _WORD.findall(text)
    n, g = len(words), h // 10
    if not n:
        return text
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return " ".join(words[:a] + [words[a + i % p] for i in range(n - a)])


def with_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and text of ``docs``, the text of each tenth doc_id (by its crc32) made periodic in part, so
    that there are runs of all sizes; a null doc_id leaves its text as it is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in H.blocks(batches):
            texts = batch.column("text").to_pylist()
            for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
                if h % 10 == 0:
                    texts[i] = repeating(texts[i], h)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, "doc_id long, text string")
