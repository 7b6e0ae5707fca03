"""Token files compressed by Re-Pair: frequent pairs of ids become nonterminals, shard by shard."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm import hashing as H
from tillroll.llm import tokens
from tillroll.llm.store import shuffle_partitions, stored

#: A shard is closed once it has so many ids; it ends with a document.
SHARD_IDS = 1 << 20
#: The least number of places of a pair that is replaced.
LEAST_PLACES = 24
MAGIC = b"RPR1"
_HEAD = struct.Struct("<4sIIII")


def _overlapping(seq: np.ndarray) -> np.ndarray:
    """Places of pairs of equal symbols that overlap the pair before: every other one of a row."""
    at = np.flatnonzero(seq[1:] == seq[:-1])
    first = np.ones(len(at), bool)
    first[1:] = at[1:] != at[:-1] + 1
    run = at[np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))] if len(at) else at
    return at[(at - run) % 2 == 1]


def _chosen_pairs(keys: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (left << 16 | right) to replace in one round: frequent ones, most frequent first, such
    that no symbol is on the left of one and on the right of another, so no two places overlap; a pair
    of equal symbols shares its symbol with no other. And the frequent pairs left for later rounds."""
    slots = (keys * np.uint32(0x9E3779B1)) >> np.uint32(12)
    often = np.bincount(slots, minlength=1 << 20) >= LEAST_PLACES
    pairs, places = np.unique(keys[often[slots]], return_counts=True)
    pairs, places = pairs[places >= LEAST_PLACES], places[places >= LEAST_PLACES]
    side: dict[int, int] = {}
    chosen, later = [], []
    for pair in pairs[np.argsort(-places, kind="stable")].tolist():
        left, right = pair >> 16, pair & 0xFFFF
        if left == right:
            free = side.setdefault(left, 3) == 3
        elif free := side.get(left, 1) == 1 and side.get(right, 2) == 2:
            side[left], side[right] = 1, 2
        (chosen if free and len(chosen) < room else later).append(pair)
    return np.array(sorted(chosen), np.uint32), np.array(later, np.uint32)


def _sides(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols on the left of some pair, and those on the right."""
    left, right = np.zeros(1 << 16, bool), np.zeros(1 << 16, bool)
    left[pairs >> np.uint32(16)] = True
    right[pairs & np.uint32(0xFFFF)] = True
    return left, right


def compress(ids: np.ndarray, first_rule: int) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and rules (pairs of symbols) that expand to ``ids``; rule i is symbol first_rule + i.
    Pairs are replaced until none has ``LEAST_PLACES`` places, or all 16-bit symbols are used.

    A pair gets no more places by replacing others, so after the first round only pairs with a symbol of
    the round before, and those that were left over, are counted again.
    """
    seq, rules = ids.astype(np.uint16), np.zeros(0, np.uint32)
    newest, sides = 0, (np.zeros(1 << 16, bool), np.zeros(1 << 16, bool))
    while len(seq) > 1 and (room := (1 << 16) - first_rule - len(rules)) > 0:
        new = seq >= newest
        counted = new[:-1] | new[1:] | (sides[0].take(seq[:-1]) & sides[1].take(seq[1:]))
        counted[_overlapping(seq)] = False
        at = np.flatnonzero(counted)
        keys = seq[at].astype(np.uint32) << np.uint32(16) | seq[at + 1]
        pairs, later = _chosen_pairs(keys, room)
        if not len(pairs):
            break
        left, right = _sides(pairs)
        near = np.flatnonzero(left.take(keys >> np.uint32(16)) & right.take(keys & np.uint32(0xFFFF)))
        at, keys = at[near], keys[near]
        slot = np.minimum(np.searchsorted(pairs, keys), len(pairs) - 1)
        hit = pairs[slot] == keys
        at, slot = at[hit], slot[hit]
        newest = first_rule + len(rules)
        sides = _sides(later)
        seq[at] = (newest + slot).astype(np.uint16)
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq, rules = seq[keep], np.concatenate((rules, pairs))
    return seq, rules


def rule_sizes(rules: np.ndarray, first_rule: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of ids of every symbol, and how deep the rules of each go."""
    sizes, depth = [1] * first_rule, [0] * first_rule
    for left, right in zip((rules >> np.uint32(16)).tolist(), (rules & np.uint32(0xFFFF)).tolist(), strict=True):
        sizes.append(sizes[left] + sizes[right])
        depth.append(max(depth[left], depth[right]) + 1)
    return np.array(sizes, np.int64), np.array(depth, np.int64)


def expansions(rules: np.ndarray, first_rule: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of ids of every symbol, and the rules' expansions, one after the other."""
    sizes, depth = rule_sizes(rules, first_rule)
    begins = np.cumsum(sizes) - sizes
    text = np.empty(int(sizes.sum()), np.uint16)
    text[:first_rule] = np.arange(first_rule)
    sides = (rules >> np.uint32(16)).astype(np.int64), (rules & np.uint32(0xFFFF)).astype(np.int64)
    order = np.argsort(depth[first_rule:], kind="stable")
    # Rules as deep as each other need only those less deep.
    for level in np.split(order, np.flatnonzero(np.diff(depth[first_rule:][order])) + 1) if len(order) else ():
        to = begins[first_rule + level]
        for side in sides:
            symbols = side[level]
            text[H.ranges(to, sizes[symbols])] = text[H.ranges(begins[symbols], sizes[symbols])]
            to = to + sizes[symbols]
    return sizes, text[first_rule:]


class Shard:
    """A file of documents: head, doc_ids, numbers of ids, rules, expansion lengths, symbols."""

    def __init__(self, raw: bytes):
        magic, docs, rules, symbols, self.first_rule = _HEAD.unpack_from(raw)
        if magic != MAGIC:
            raise ValueError("not a token file")
        at = _HEAD.size

        def take(kind, n):
            nonlocal at
            out = np.frombuffer(raw, kind, n, at)
            at += out.nbytes
            return out

        self.doc_ids, self.counts = take("<i8", docs), take("<i8", docs)
        self.rules, self.sizes, self.symbols = take("<u4", rules), take("<u4", rules), take("<u2", symbols)

    @staticmethod
    def pack(doc_ids: np.ndarray, counts: np.ndarray, ids: np.ndarray, first_rule: int) -> bytes:
        symbols, rules = compress(ids, first_rule)
        sizes, _ = rule_sizes(rules, first_rule)
        head = _HEAD.pack(MAGIC, len(doc_ids), len(rules), len(symbols), first_rule)
        parts = (doc_ids, "<i8"), (counts, "<i8"), (rules, "<u4"), (sizes[first_rule:], "<u4"), (symbols, "<u2")
        return head + b"".join(x.astype(kind).tobytes() for x, kind in parts)

    def ids(self) -> np.ndarray:
        return self._expand(self.symbols)

    def read(self, start: int, length: int) -> np.ndarray:
        """``length`` ids from the ``start``-th on; only the symbols that cover them are expanded."""
        ends = np.cumsum(self._sizes()[self.symbols])
        first = int(np.searchsorted(ends, start, "right"))
        last = int(np.searchsorted(ends, start + length, "left")) + 1
        before = int(ends[first - 1]) if first else 0
        return self._expand(self.symbols[first:last])[start - before : start - before + length]

    def _sizes(self) -> np.ndarray:
        return np.concatenate((np.ones(self.first_rule, np.int64), self.sizes.astype(np.int64)))

    def _expand(self, symbols: np.ndarray) -> np.ndarray:
        sizes, text = expansions(self.rules, self.first_rule)
        all_ids = np.concatenate((np.arange(self.first_rule, dtype=np.uint16), text))
        begins = np.cumsum(sizes) - sizes
        lengths = sizes[symbols]
        return all_ids[H.ranges(begins[symbols], lengths)]


def write_shards(docs: DataFrame, path: str, end: int = 0, first_rule: int | None = None) -> DataFrame:
    """Encode ``docs`` (doc_id, text) in ascending doc_id order and write them as token files.

    One row is one file: part, number in the part, ids before it in the part, n_ids, file. Parts are
    ranges of doc_id in order, so a doc_id's rows meet in one part; within it rows are sorted, and
    shards are made as the sorted rows stream by. A null doc_id comes first, a null text is empty,
    repeated rows are written as often, an empty table gives no file, other columns are not read.
    """
    parts = shuffle_partitions(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, before = TaskContext.get().partitionId(), 0, 0
        encoder = tokens.encoder(path)
        rule = first_rule or encoder.tokenizer.get_vocab_size()
        waiting: list[tuple[np.ndarray, ...]] = []
        size = 0

        def shard() -> pa.RecordBatch:
            nonlocal number, before, waiting, size
            doc_ids, counts, ids = (np.concatenate(x) for x in zip(*waiting, strict=True))
            raw = Shard.pack(doc_ids, counts, ids, rule)
            out = pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "number": pa.array([number]), "before": pa.array([before]), "n_ids": pa.array([len(ids)]), "file": pa.array([raw], pa.binary())})
            number, before, waiting, size = number + 1, before + len(ids), [], 0
            return out

        for batch in H.blocks(batches, limit=tokens.BLOCK_BYTES):
            ids, counts = tokens.with_end(*encoder.block(batch.column("text")), end)
            own = batch.column("doc_id").fill_null(NULL_ID).to_numpy(zero_copy_only=False)
            ends = np.concatenate(([0], np.cumsum(counts)))
            first = 0
            while first < len(counts):
                last = int(np.searchsorted(ends, ends[first] + SHARD_IDS - size, "left"))
                last = min(max(last, first + 1), len(counts))
                waiting.append((own[first:last], counts[first:last], ids[ends[first] : ends[last]]))
                size += int(ends[last] - ends[first])
                first = last
                if size >= SHARD_IDS:
                    yield shard()
        if waiting:
            yield shard()

    ordered = rows.repartitionByRange(parts, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    return stored(ordered.mapInArrow(run, "part int, number long, before long, n_ids long, file binary"))


#: Stands for a null doc_id inside files.
NULL_ID = -(1 << 63)


def read_shards(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, and its place: part, number of the file
    and first id in it; read back from the files. The only thing gathered is one number per part."""
    totals = {r[0]: r[1] for r in files.groupBy("part").agg(F.sum("n_ids")).collect()}
    base, seen = {}, 0
    for part in sorted(totals):
        base[part] = seen
        seen += totals[part]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, number, before, raw = (batch.column(x)[row].as_py() for x in ("part", "number", "before", "file"))
                shard = Shard(raw)
                ids = shard.ids().astype("<u4")
                begins = np.cumsum(shard.counts) - shard.counts
                crc = [zlib.crc32(ids[a : a + n]) for a, n in zip(begins.tolist(), shard.counts.tolist(), strict=True)]
                n = len(crc)
                columns = [
                    pa.array(shard.doc_ids, mask=shard.doc_ids == NULL_ID), pa.array(begins + before + base[part]), pa.array(shard.counts),
                    pa.array(crc, pa.int64()), pa.array(np.full(n, part, np.int32)), pa.array(np.full(n, number)), pa.array(begins),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32", "part", "number", "first"])

    return files.select("part", "number", "before", "file").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long, part int, number long, first long"
    )
