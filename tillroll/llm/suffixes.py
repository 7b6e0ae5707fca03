"""Exact substring de-duplication by a sparse suffix array, sorted deep-shallow.

Every ``LENGTH``-byte string has an anchor: its least-hashed ``GRAM``-byte gram, the leftmost of equal
ones. Equal strings have equal anchors at equal places, so only strings around anchors that several
documents have can occur twice; that is decided from packed anchor hashes. Hashes of the bytes around
those anchors are brought together by anchor: mostly the same bytes lie around it everywhere, as in
copies. Where they differ, at the ends of what is shared, the bytes are fetched and their suffixes
sorted: multikey quicksort, eight bytes a character, to a shallow depth, then blind tries for groups whose
common prefix is longer. Suffixes that agree on ``LENGTH`` bytes are one class, and a string is removed wherever its class has a smaller doc_id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm import hashing as H
from tillroll.llm.store import shuffle_partitions

LENGTH = 50
GRAM = 20
#: Bytes that multikey quicksort looks at before blind tries take over.
SHALLOW = 24
#: Rows around anchors that are sorted at once.
ROWS_AT_ONCE = 150_000
#: Stands for a null doc_id: smaller than all others.
NULL_ID = -(1 << 63)

SHARED = "doc_id long, anchor long"
AROUND = "anchor long, doc_id long, copy long, start int, size int, hash long"
DECIDED = "anchor long, doc_id long, copy long, low long, high long, open boolean"
CONTEXT = "anchor long, doc_id long, copy long, start long, context binary"
CUT = "doc_id long, copy long, low long, high long"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<low: long, high: long>>"


# -- sorting ------------------------------------------------------------------------------------


class BlindTrie:
    """Strings of one length, ordered by a trie that keeps only the places where they branch."""

    def __init__(self):
        self.strings: list[bytes] = []
        self.root: list | int | None = None

    def insert(self, text: bytes) -> int:
        """The number of ``text`` among the distinct strings so far."""
        if self.root is None:
            self.strings.append(text)
            self.root = 0
            return 0
        node = self.root
        while not isinstance(node, int):  # blindly: only branching bytes are looked at
            depth, children = node
            node = children.get(text[depth], next(iter(children.values())))
        other = self.strings[node]
        if other == text:
            return node
        common = next(i for i, (a, b) in enumerate(zip(other, text, strict=True)) if a != b)
        number = len(self.strings)
        self.strings.append(text)
        parent, node = None, self.root
        while not isinstance(node, int) and node[0] < common:
            parent, node = node, node[1][text[node[0]]]
        if not isinstance(node, int) and node[0] == common:
            node[1][text[common]] = number
            return number
        branch = [common, {other[common]: node, text[common]: number}]
        if parent is None:
            self.root = branch
        else:
            parent[1][text[parent[0]]] = branch
        return number

    def ranks(self) -> list[int]:
        """The place of each distinct string in order."""
        out, stack, place = [0] * len(self.strings), [self.root] if self.root is not None else [], 0
        while stack:
            node = stack.pop()
            if isinstance(node, int):
                out[node], place = place, place + 1
            else:
                stack.extend(node[1][b] for b in sorted(node[1], reverse=True))
        return out


def sort_suffixes(data: np.ndarray, starts: np.ndarray, group: np.ndarray, length: int, shallow: int = SHALLOW) -> np.ndarray:
    """For the suffixes of ``data`` at ``starts``, the rank of their first ``length`` bytes within
    their group; ranks rise with (group, bytes), and equal bytes of a group have equal ranks."""
    n = len(starts)
    rank = np.zeros(n, np.int64)
    if not n:
        return rank
    padded = np.concatenate((data, np.zeros(length + 8, np.uint8)))
    eight = np.lib.stride_tricks.sliding_window_view(padded, 8)
    _, rank = np.unique(group, return_inverse=True)
    first = np.searchsorted(np.sort(rank), np.arange(n + 1))
    rank = first[rank]  # a rank is the number of suffixes in classes before
    active = _tied(rank)
    depth = 0
    while depth < min(shallow, length) and len(active):
        take = min(8, length - depth)
        chars = eight[starts[active] + depth].copy()
        chars[:, take:] = 0
        words = chars.view(">u8").ravel()
        order = np.lexsort((words, rank[active]))
        r, w = rank[active][order], words[order]
        fresh = np.ones(len(order), bool)
        fresh[1:] = (r[1:] != r[:-1]) | (w[1:] != w[:-1])
        new_class = np.concatenate(([True], r[1:] != r[:-1]))
        at = np.arange(len(order))
        class_start = np.maximum.accumulate(np.where(new_class, at, 0))
        sub_start = np.maximum.accumulate(np.where(fresh, at, 0))
        rank[active[order]] = r + sub_start - class_start
        depth += take
        active = active[np.isin(active, _tied(rank), assume_unique=True)]
    if depth < length and len(active):
        _deep(padded, starts, rank, active, depth, length)
    return rank


def _tied(rank: np.ndarray) -> np.ndarray:
    """Entries whose rank is not theirs alone."""
    counts = np.bincount(rank, minlength=len(rank) + 1)
    return np.flatnonzero(counts[rank] > 1)


def _deep(data: np.ndarray, starts: np.ndarray, rank: np.ndarray, active: np.ndarray, depth: int, length: int) -> None:
    """Order the groups that agree on ``depth`` bytes by blind tries, in place."""
    order = active[np.argsort(rank[active], kind="stable")]
    r = rank[order]
    bounds = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1], [True])))
    tails = np.lib.stride_tricks.sliding_window_view(data, length - depth)[starts[order] + depth]
    head = np.repeat(bounds[:-1], np.diff(bounds))
    differs = np.add.reduceat((tails != tails[head]).any(axis=1).astype(np.int64), bounds[:-1]) > 0
    for a, b in zip(bounds[:-1][differs].tolist(), bounds[1:][differs].tolist(), strict=True):
        trie = BlindTrie()
        numbers = [trie.insert(t.tobytes()) for t in tails[a:b]]
        places = np.array(trie.ranks())[numbers]
        rank[order[a:b]] += np.searchsorted(np.sort(places), places)


# -- anchors ------------------------------------------------------------------------------------


def _least_ahead(h: np.ndarray, width: int, pick=np.minimum) -> np.ndarray:
    """The least of each ``width`` entries in a row (by doubling)."""
    have, out = 1, h
    while have < width:
        step = min(have, width - have)
        out = pick(out[: len(out) - step], out[step:])
        have += step
    return out


def anchors(h: np.ndarray, n_windows: int, width: int) -> np.ndarray:
    """Positions that hold the least hash of some window: all anchors, and ties of theirs."""
    least = _least_ahead(h[: n_windows + width - 1], width)
    edge = np.zeros(width - 1, h.dtype)
    return np.flatnonzero(h[: n_windows + width - 1] == _least_ahead(np.concatenate((edge, least, edge)), width, np.maximum))


def owners(h: np.ndarray, width: int) -> np.ndarray:
    """The position of the leftmost least hash of each window of ``width`` entries."""
    value, at, have = h, np.arange(len(h), dtype=np.int32), 1
    while have < width:
        step = min(have, width - have)
        left = value[: len(value) - step] <= value[step:]
        at = np.where(left, at[: len(at) - step], at[step:])
        value = np.minimum(value[: len(value) - step], value[step:])
        have += step
    return at


WIDTH = LENGTH - GRAM + 1


def _code(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """An anchor's number: 32 bits of its hash, and the bucket that other 32 bits fall into."""
    return (hashes >> np.uint64(32)).astype(np.int64) * buckets + (hashes & np.uint64(0xFFFFFFFF)).astype(np.int64) % buckets


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _packed_anchors(docs: DataFrame, buckets: int) -> DataFrame:
    """Anchor hashes of each block, by bucket. A hash that several documents of a block have is known to
    be shared at once, and goes on with the block's first document only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in H.blocks(batches):
            data, offsets = H.text_bytes(batch.column("text"))
            h, windows, begins = H.Rolling(data).grams(GRAM), np.maximum(np.diff(offsets) - LENGTH + 1, 0), offsets[:-1]
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            parts = []
            for i in np.flatnonzero(windows).tolist():
                own = h[begins[i] : begins[i] + windows[i] + WIDTH - 1]
                at = anchors(own, int(windows[i]), WIDTH)
                parts.append((own[at], np.full(len(at), ids[i])))
            if not parts:
                continue
            hashes, doc = (np.concatenate(x) for x in zip(*parts, strict=True))
            code = _code(hashes, buckets)
            order = np.lexsort((doc, code))
            code, doc = code[order], doc[order]
            fresh = np.concatenate(([True], (code[1:] != code[:-1]) | (doc[1:] != doc[:-1])))
            code, doc = code[fresh], doc[fresh]
            head = np.concatenate(([True], code[1:] != code[:-1]))
            many = np.repeat(np.diff(np.append(np.flatnonzero(head), len(code))) > 1, np.diff(np.append(np.flatnonzero(head), len(code))))
            yield from _by_bucket(code, doc, head, many, buckets)

    return docs.mapInArrow(run, "bucket int, codes binary, docs binary, known binary, known_docs binary")


def _by_bucket(code, doc, head, many, buckets: int) -> Iterator[pa.RecordBatch]:
    bucket = code % buckets
    order = np.lexsort((doc, bucket))
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    rows = []
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        own = order[cuts[b] : cuts[b + 1]]
        first, known = own[head[own]], own[many[own]]
        rows.append((b, (code[first] // buckets).astype(np.uint32).tobytes(), doc[first].tobytes(), code[known].tobytes(), doc[known].tobytes()))
    kinds = [pa.int32()] + [pa.binary()] * 4
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["bucket", "codes", "docs", "known", "known_docs"])


def shared_anchors(docs: DataFrame) -> DataFrame:
    """(doc_id, anchor) for all anchors that more than one document has (and, as hashes are cut to 32
    bits and the bucket, a few that only one has)."""
    buckets = 4 * shuffle_partitions(docs.sparkSession)

    def run(table: pa.Table) -> pa.Table:
        def joined(name: str, kind) -> np.ndarray:
            return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)

        bucket = table.column("bucket")[0].as_py()
        code, doc = joined("codes", np.uint32), joined("docs", np.int64)
        order = np.argsort(code, kind="stable")
        same = code[order][1:] == code[order][:-1]
        shared = np.zeros(len(code), bool)
        shared[order[1:]] |= same
        shared[order[:-1]] |= same
        found = code[shared].astype(np.int64) * buckets + bucket
        return pa.table({"doc_id": np.concatenate((doc[shared], joined("known_docs", np.int64))), "anchor": np.concatenate((found, joined("known", np.int64)))})

    return _packed_anchors(docs, buckets).groupBy("bucket").applyInArrow(run, SHARED)


def around_anchors(docs: DataFrame, shared: DataFrame) -> DataFrame:
    """The stretch of all strings of LENGTH bytes that have a shared anchor, with a hash of its bytes:
    one row per anchor and place."""
    buckets = 4 * shuffle_partitions(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in H.blocks(batches):
            data, offsets = H.text_bytes(batch.column("text"))
            rolling = H.Rolling(data)
            h, windows, begins = rolling.grams(GRAM), np.maximum(np.diff(offsets) - LENGTH + 1, 0), offsets[:-1]
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            copies = batch.column("copy").to_numpy(zero_copy_only=False)
            lists = batch.column("anchors")
            out = []
            for i in np.flatnonzero(windows).tolist():
                own = h[begins[i] : begins[i] + windows[i] + WIDTH - 1]
                owner = owners(own, WIDTH)
                low = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
                high = np.append(low[1:], len(owner)) - 1 + LENGTH
                code = _code(own[owner[low]], buckets)
                hit = np.isin(code, lists[i].values.to_numpy(zero_copy_only=False))
                if hit.any():
                    out.append((code[hit], np.full(hit.sum(), ids[i]), np.full(hit.sum(), copies[i]), low[hit], begins[i] + low[hit], begins[i] + high[hit]))
            if out:
                code, doc, copy, start, low, high = (np.concatenate(x) for x in zip(*out, strict=True))
                hashes = rolling.between(low, high).view(np.int64)
                columns = (code, doc, copy, start.astype(np.int32), (high - low).astype(np.int32), hashes)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], _names(AROUND))

    own = shared.groupBy("doc_id").agg(F.collect_set("anchor").alias("anchors"))
    return docs.join(own, "doc_id").select("doc_id", "copy", "text", "anchors").mapInArrow(run, AROUND)


def decided(around: DataFrame) -> DataFrame:
    """Stretches to remove whole, as the same bytes lie around the same anchor in a document before; and
    ``open`` ones, the first of each kind where different bytes lie around one anchor.

    Rows of an anchor stream by in doc_id order; what is kept of those gone by are the first ones of
    each kind of the anchor at hand.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: pa.Table | None = None
        opened = False
        for block in _whole_blocks(batches, ROWS_AT_ONCE):
            table = block if before is None else pa.concat_tables([before, block]).combine_chunks()
            carried = 0 if before is None else before.num_rows
            code, doc, copy, start, size, kind = (table.column(x).to_numpy() for x in _names(AROUND))
            n = len(code)
            at = np.arange(n)
            order = np.lexsort((at, kind, size, code))
            fresh = np.zeros(n, bool)
            fresh[:1] = True
            for key in (code, size, kind):
                fresh[1:] |= key[order][1:] != key[order][:-1]
            rep = np.empty(n, np.int64)
            rep[order] = order[np.maximum.accumulate(np.where(fresh, at, 0))]
            _, group = np.unique(code, return_inverse=True)
            crowded = np.bincount(group[rep == at])[group] > 1
            new = at >= carried
            # Rows carried over are open already if their anchor was crowded then.
            fine = crowded & (doc == doc[rep]) & (new | (not opened))
            whole = new & (doc > doc[rep])
            some = np.flatnonzero(fine | whole)
            if len(some):
                low = start[some].astype(np.int64)
                columns = (code[some], doc[some], copy[some], low, low + size[some], fine[some])
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], _names(DECIDED))
            # Of the last anchor: the first row of each kind, and its repeats in the same document.
            last = np.flatnonzero((code == code[-1]) & (doc == doc[rep]))
            before, opened = table.take(pa.array(last)).combine_chunks(), bool(crowded[-1])

    parts = shuffle_partitions(around.sparkSession)
    return around.repartition(parts, "anchor").sortWithinPartitions("anchor", "doc_id").mapInArrow(run, DECIDED)


def _whole_blocks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """The rows of ``batches``, at least so many at a time but for the last."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def contexts(docs: DataFrame, open_: DataFrame) -> DataFrame:
    """The bytes of the open stretches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in H.blocks(batches):
            data, offsets = H.text_bytes(batch.column("text"))
            wanted = batch.column("wanted")
            row = np.repeat(np.arange(batch.num_rows), np.diff(wanted.offsets.to_numpy()))
            anchor, copy, low, high = (x.to_numpy(zero_copy_only=False) for x in wanted.flatten().flatten())
            own = copy == batch.column("copy").to_numpy(zero_copy_only=False)[row]
            row, anchor, copy, low, high = (x[own] for x in (row, anchor, copy, low, high))
            if not len(row):
                continue
            raw = data[H.ranges(offsets[row] + low, high - low)]
            ends = np.concatenate(([0], np.cumsum(high - low))).astype(np.int32)
            context = pa.BinaryArray.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(ends), pa.py_buffer(raw)])
            doc = batch.column("doc_id").to_numpy(zero_copy_only=False)[row]
            yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(doc), pa.array(copy), pa.array(low), context], _names(CONTEXT))

    wanted = open_.groupBy("doc_id").agg(F.collect_set(F.struct("anchor", "copy", "low", "high")).alias("wanted"))
    return docs.join(wanted, "doc_id").select("doc_id", "copy", "text", "wanted").mapInArrow(run, CONTEXT)


# -- classes ------------------------------------------------------------------------------------


def earliest(code: np.ndarray, doc: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For rows in the order of (code, doc): the row of the first equal context of the same code; and
    for the strings of all such first rows (one after the other) the smallest document of their class,
    with the number of the first string of each row."""
    n = len(code)
    h = H.Rolling(data).between(offsets[:-1], offsets[1:])
    order = np.lexsort((np.arange(n), h, code))
    fresh = np.concatenate(([True], (code[order][1:] != code[order][:-1]) | (h[order][1:] != h[order][:-1])))
    rep = np.empty(n, np.int64)
    rep[order] = order[np.maximum.accumulate(np.where(fresh, np.arange(n), 0))]
    rep = _same_bytes(rep, data, offsets)
    reps = np.flatnonzero(rep == np.arange(n))
    count = np.diff(offsets)[reps] - LENGTH + 1
    at = np.zeros(n + 1, np.int64)
    at[reps + 1] = count
    at = np.cumsum(at)
    least = np.repeat(doc[reps], count)
    # Only where a code has several contexts can strings of different contexts be equal.
    crowded = np.bincount(np.searchsorted(np.unique(code), code[reps]))
    several = np.repeat(crowded > 1, crowded) if len(reps) else np.zeros(0, bool)
    pick = np.flatnonzero(np.repeat(several, count))
    if len(pick):
        rank = sort_suffixes(data, H.ranges(offsets[:-1][reps], count)[pick], np.repeat(code[reps], count)[pick], LENGTH)
        best = np.full(rank.max() + 1, np.iinfo(np.int64).max)
        np.minimum.at(best, rank, least[pick])
        least[pick] = best[rank]
    return rep, least, at


def _same_bytes(rep: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """``rep``, but a row whose bytes are not those of its representative stands for itself."""
    sizes = np.diff(offsets)
    ok = sizes == sizes[rep]
    rows = np.flatnonzero(ok & (rep != np.arange(len(rep))))
    if len(rows):
        equal = data[H.ranges(offsets[rows], sizes[rows])] == data[H.ranges(offsets[rep[rows]], sizes[rows])]
        ok[rows] = np.logical_and.reduceat(equal, np.cumsum(sizes[rows]) - sizes[rows])
    return np.where(ok, rep, np.arange(len(rep)))


def _cuts(code, doc, copy, start, data, offsets, skip: int) -> tuple[dict, np.ndarray]:
    """Stretches to remove from the rows after the first ``skip``, and the rows to carry on."""
    rep, least, at = earliest(code, doc, data, offsets)
    n = np.diff(offsets) - LENGTH + 1
    string = H.ranges(at[:-1][rep], n)
    row = np.repeat(np.arange(len(code)), n)
    removed = (least[string] < doc[row]) & (row >= skip)
    within = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    before = np.concatenate(([False], removed[:-1])) & (within > 0)
    after = np.concatenate((removed[1:], [False])) & (within < n[row] - 1)
    low, high = np.flatnonzero(removed & ~before), np.flatnonzero(removed & ~after)
    cut = {"doc_id": doc[row[low]], "copy": copy[row[low]], "low": start[row[low]] + within[low], "high": start[row[low]] + within[high] + LENGTH}
    last = np.flatnonzero((code == code[-1]) & (rep == np.arange(len(code))))
    return cut, last


def removals(context: DataFrame) -> DataFrame:
    """Stretches [low, high) of bytes to remove. Rows of an anchor stream by in doc_id order; what is
    kept of those gone by are the different contexts of the anchor at hand, with their first document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: pa.Table | None = None
        for block in _whole_blocks(batches, ROWS_AT_ONCE):
            table = block if before is None else pa.concat_tables([before, block]).combine_chunks()
            carried = 0 if before is None else before.num_rows
            code, doc, copy, start = (table.column(x).to_numpy() for x in ("anchor", "doc_id", "copy", "start"))
            cut, last = _cuts(code, doc, copy, start, *H.text_bytes(table.column("context")), carried)
            before = table.take(pa.array(last)).combine_chunks()
            if len(cut["doc_id"]):
                yield pa.RecordBatch.from_pydict({k: pa.array(v.astype(np.int64)) for k, v in cut.items()})

    parts = shuffle_partitions(context.sparkSession)
    return context.repartition(parts, "anchor").sortWithinPartitions("anchor", "doc_id").mapInArrow(run, CUT)


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans.

    Removed is each byte of a LENGTH-byte string that also starts in a document with a smaller doc_id,
    judged on the texts as they are. A null text is empty; a null doc_id is smaller than all others
    and stays null; rows with one doc_id take nothing from each other; texts under LENGTH bytes stay
    whole; other columns are not read; an empty table gives an empty result.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"), F.xxhash64(text).alias("copy"), text.alias("text"))
    found = decided(around_anchors(rows, shared_anchors(rows.select("doc_id", "text"))))
    sorted_out = removals(contexts(rows, found.where("open")))
    cuts = sorted_out.unionByName(found.where("NOT open").select("doc_id", "copy", "low", "high"))
    by_doc = cuts.groupBy("doc_id").agg(F.collect_set(F.struct("copy", "low", "high")).alias("cuts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in H.blocks(batches):
            data, offsets = H.text_bytes(batch.column("text"))
            raw = data.tobytes()
            out = []
            for i, (doc_id, copy, cuts) in enumerate(zip(*(batch.column(x).to_pylist() for x in ("doc_id", "copy", "cuts")), strict=True)):
                text = raw[offsets[i] : offsets[i + 1]]
                spans = reduce(_joined, sorted((c["low"], c["high"]) for c in cuts or () if c["copy"] == copy), [])
                kept, at = hashlib.sha256(), 0
                for low, high in spans:
                    kept.update(text[at:low])
                    at = high
                kept.update(text[at:])
                out.append((None if doc_id == NULL_ID else doc_id, len(text), sum(b - a for a, b in spans), len(spans), kept.hexdigest(), [{"low": a, "high": b} for a, b in spans]))
            kinds = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    return rows.join(by_doc, "doc_id", "left").select("doc_id", "copy", "text", "cuts").mapInArrow(run, RESULT)


def _joined(spans: list, span: tuple[int, int]) -> list:
    """Add a stretch to sorted ones, as part of the last if they touch."""
    if spans and span[0] <= spans[-1][1]:
        spans[-1] = (spans[-1][0], max(spans[-1][1], span[1]))
    else:
        spans.append(span)
    return spans
