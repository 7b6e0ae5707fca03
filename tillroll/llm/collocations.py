"""Collocations of each language, from n-gram counts in counting quotient filters.

Words that occur often enough get numbers; a phrase is its packed numbers. A task permutes the packed
phrases of its documents invertibly, so that they are spread evenly, and counts them in a quotient
filter: the leading bytes (the quotient) are kept as the length of their run, the rest (the remainder)
in full, so that nothing is lost and no two phrases share a counter. Filters are sorted; those of all
tasks are cut into the same ranges, meet by range, and are merged by run.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm import hashing as H
from tillroll.llm.store import shuffle_partitions, stored

#: A candidate occurs so often at least.
LEAST_COUNT = 10
#: A phrase is dropped where a longer candidate around it has this percentage of its places.
COVERED_PERCENT = 50
TOP = 2000
#: Bytes of text whose words share a dictionary.
BLOCK_BYTES = 8 << 20
#: Words of one stored row of a block.
CHUNK_WORDS = 1 << 20
#: Words whose phrases are permuted at once.
STEP_WORDS = 1 << 18
#: Phrases that a task counts before it hands a filter on.
FILTER_PHRASES = 1 << 21
#: Words of a task, and for each range of filters; a range's filters have twice as many entries at most.
RANGE_WORDS = 1 << 22
SALTS = 64

#: Ends of pieces ``[.,;:!?\x0A-\x0D]``, and bytes of words ``[^\x20\x09]+`` between them.
ENDS = H.byte_set(lambda b: chr(b) in ".,;:!?" or 0x0A <= b <= 0x0D)
MEMBERS = H.byte_set(lambda b: b not in (0x20, 0x09)) & ~ENDS


# -- words ----------------------------------------------------------------------------------------


def _coded(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, int, list]]:
    """The words of a block as numbers in a dictionary of (lang, word, places) entries.

    Yields codes, number of own words and dictionary; a code has its lowest bit set at the end of a
    piece. Codes after the own words only continue phrases that start before.
    """
    data, offsets = H.text_bytes(batch.column("text"))
    words = H.Words(H.LOWER[data], offsets, MEMBERS)
    n = len(words.starts)
    if not n:
        return
    last = np.ones(n, bool)
    last[:-1] = words.doc[1:] != words.doc[:-1]
    # Ends of pieces are outside words: each ends the word before it.
    last[np.searchsorted(words.starts, np.flatnonzero(ENDS[data])) - 1] = True
    lengths = np.zeros(n + 1, np.int64)
    np.cumsum(words.ends - words.starts, out=lengths[1:])
    raw, doc = words.data[words.inside], words.doc
    del words, data
    texts = pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(lengths), pa.py_buffer(raw)]).dictionary_encode()
    del lengths, raw
    langs = batch.column("lang").dictionary_encode()
    width = len(langs.dictionary)
    both = texts.indices.to_numpy().astype(np.int64) * width + langs.indices.to_numpy()[doc]
    texts = texts.dictionary
    del doc
    for first in range(0, n, CHUNK_WORDS):
        own = min(CHUNK_WORDS, n - first)
        codes, entries = pd.factorize(both[first : first + own + 2])
        places = np.bincount(codes[:own], minlength=len(entries))
        columns = [langs.dictionary.take(pa.array(entries % width)), texts.take(pa.array(entries // width)).cast(pa.string()), pa.array(places)]
        dictionary = pa.StructArray.from_arrays(columns, ["lang", "word", "places"])
        yield codes.astype(np.uint32) << np.uint32(1) | last[first : first + own + 2], own, dictionary


def _chunks(docs: DataFrame) -> DataFrame:
    """chunk (its number), own, codes, entries: the words of ``docs`` by dictionary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in H.blocks(batches, limit=BLOCK_BYTES):
            for codes, own, dictionary in _coded(batch):
                entries = pa.ListArray.from_arrays(pa.array([0, len(dictionary)], pa.int32()), dictionary)
                columns = [pa.array([number]), pa.array([own]), pa.array([codes.tobytes()], pa.binary()), entries]
                yield pa.RecordBatch.from_arrays(columns, ["chunk", "own", "codes", "entries"])
                number += 1

    rows = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("und")).alias("lang"))
    return rows.mapInArrow(H.trimmed(run), "chunk long, own long, codes binary, entries array<struct<lang: string, word: string, places: long>>")


def _numbered(words: DataFrame) -> DataFrame:
    """``words`` with numbers ``id`` from 1 on: task t of T gives t + 1, t + 1 + T, ..."""
    tasks = shuffle_partitions(words.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() + 1
        for batch in batches:
            ids = pa.array(np.arange(batch.num_rows, dtype=np.int64) * tasks + at)
            at += batch.num_rows * tasks
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], [*batch.schema.names, "id"])

    return words.repartition(tasks, "lang", "word").mapInArrow(H.trimmed(run), "lang string, word string, f long, id long")


# -- filters --------------------------------------------------------------------------------------


class Permutation:
    """Word numbers packed into an even number of bytes and permuted there, and back.

    ``bits`` for each of three words, 42 at most. A packed phrase is two halves of a Feistel network.
    """

    ROUNDS = 4

    def __init__(self, bits: int):
        if bits > 42:
            raise ValueError("more than 2**42 frequent words")
        self.bits = bits
        self.half = max(2, -(-3 * bits // 16))
        self.mask = np.uint64((1 << 8 * self.half) - 1)
        #: Bits of the middle word that go to the upper half.
        self.upper = 8 * self.half - bits
        if self.upper > bits:
            self.upper = bits

    def _mixed(self, half: np.ndarray, rnd: int) -> np.ndarray:
        return H.mix(half + np.uint64(0x9E3779B97F4A7C15 * (rnd + 1) % (1 << 64))) & self.mask

    def permuted(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low = np.uint64(self.bits - self.upper)
        left = a << np.uint64(self.upper) | b >> low
        right = (b & np.uint64((1 << int(low)) - 1)) << np.uint64(self.bits) | c
        for rnd in range(self.ROUNDS):
            if rnd % 2:
                right = right ^ self._mixed(left, rnd)
            else:
                left = left ^ self._mixed(right, rnd)
        return left, right

    def words(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        for rnd in reversed(range(self.ROUNDS)):
            if rnd % 2:
                right = right ^ self._mixed(left, rnd)
            else:
                left = left ^ self._mixed(right, rnd)
        low = np.uint64(self.bits - self.upper)
        b = (left & np.uint64((1 << self.upper) - 1)) << low | right >> np.uint64(self.bits)
        return left >> np.uint64(self.upper), b, right & np.uint64((1 << self.bits) - 1)


class QuotientFilter:
    """Counters of distinct permuted phrases, in order: halves ``left`` and ``right``, and ``counts``."""

    _HEAD = struct.Struct("<BBII")

    def __init__(self, half: int, left: np.ndarray, right: np.ndarray, counts: np.ndarray):
        self.half, self.left, self.right, self.counts = half, left, right, counts

    @classmethod
    def merged(cls, half: int, left: np.ndarray, right: np.ndarray, counts: np.ndarray) -> QuotientFilter:
        """From entries in any order, equal ones added up. Sorted stretches are merged as they are."""
        if 2 * half <= 8:
            shift = np.uint64(8 * half)
            return cls.summed(half, left << shift | right, counts)
        order = np.lexsort((right, left))
        left, right, counts = left[order], right[order], counts[order]
        new = np.ones(len(left), bool)
        new[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
        at = np.flatnonzero(new)
        return cls(half, left[at], right[at], np.add.reduceat(counts, at) if len(at) else counts)

    @classmethod
    def summed(cls, half: int, keys: np.ndarray, counts: np.ndarray) -> QuotientFilter:
        """From keys of eight bytes in any order, equal ones added up."""
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        del order
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        at = np.flatnonzero(new)
        keys, counts = keys[at], np.add.reduceat(counts, at) if len(at) else counts
        shift = np.uint64(8 * half)
        return cls(half, keys >> shift, keys & ((np.uint64(1) << shift) - np.uint64(1)), counts)

    @classmethod
    def counted(cls, half: int, waiting: list[tuple[np.ndarray, np.ndarray]]) -> QuotientFilter:
        """From lists of phrases, which are used up. Keys of eight bytes are sorted in place, so that no order and
        no copies in that order are held."""
        if 2 * half > 8:
            left, right = (np.concatenate(x) for x in zip(*waiting, strict=True))
            waiting.clear()
            return cls.merged(half, left, right, np.ones(len(left), np.int64))
        shift, keys, at = np.uint64(8 * half), np.empty(sum(len(left) for left, _ in waiting), np.uint64), 0
        while waiting:
            left, right = waiting.pop()
            np.left_shift(left, shift, out=keys[at : at + len(left)])
            keys[at : at + len(left)] |= right
            at += len(left)
        keys.sort()
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        first = np.flatnonzero(new)
        counts, keys = np.diff(first, append=len(keys)), keys[first]
        return cls(half, keys >> shift, keys & ((np.uint64(1) << shift) - np.uint64(1)), counts)

    def packed(self, first: int, last: int) -> bytes:
        """Entries ``first`` to ``last``: quotients as run lengths, remainders, counts (a byte, or 255
        and eight bytes at the end)."""
        left, right, counts = self.left[first:last], self.right[first:last], self.counts[first:last]
        keys = np.empty((len(left), 2 * self.half), np.uint8)
        keys[:, : self.half] = left.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - self.half :]
        keys[:, self.half :] = right.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - self.half :]
        size = min(self.half, 2 if len(left) >= 1 << 12 else 1)
        quotients = left >> np.uint64(8 * (self.half - size))
        base = int(quotients[0]) if len(left) else 0
        runs = np.bincount((quotients - np.uint64(base)).astype(np.int64))
        unary = np.ones(len(left) + len(runs), bool)
        unary[np.cumsum(runs) + np.arange(len(runs))] = False
        short = np.minimum(counts, 255).astype(np.uint8)
        head = self._HEAD.pack(self.half, size, len(left), len(runs)) + struct.pack("<I", base)
        return b"".join((head, np.packbits(unary).tobytes(), keys[:, size:].tobytes(), short.tobytes(), counts[short == 255].astype("<i8").tobytes()))

    @classmethod
    def of_all(cls, half: int, files: list) -> QuotientFilter:
        """The filters in ``files`` merged. Keys of eight bytes are held as such, not in halves."""
        if 2 * half > 8:
            return cls.merged(half, *(np.concatenate(x) for x in zip(*map(cls.entries, files), strict=True)))
        shift, parts = np.uint64(8 * half), []
        for raw in files:
            left, right, counts = cls.entries(raw)
            parts.append((left << shift | right, counts))
        entries = [np.concatenate(x) for x in zip(*parts, strict=True)]
        parts.clear()
        return cls.summed(half, *entries)

    @classmethod
    def entries(cls, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """left, right and counts from ``packed``."""
        half, size, n, n_runs = cls._HEAD.unpack_from(raw)
        (base,) = struct.unpack_from("<I", raw, cls._HEAD.size)
        at = cls._HEAD.size + 4
        n_bytes = -(-(n + n_runs) // 8)
        unary = np.unpackbits(np.frombuffer(raw, np.uint8, n_bytes, at))[: n + n_runs].astype(bool)
        at += n_bytes
        quotients = (np.cumsum(~unary)[unary] + base).astype(np.uint64)
        rest = np.frombuffer(raw, np.uint8, n * (2 * half - size), at).reshape(n, -1)
        at += rest.size
        short = np.frombuffer(raw, np.uint8, n, at)
        counts = short.astype(np.int64)
        counts[short == 255] = np.frombuffer(raw, "<i8", int((short == 255).sum()), at + n)
        left, right = np.zeros((n, 8), np.uint8), np.zeros((n, 8), np.uint8)
        left[:, 8 - half + size :] = rest[:, : half - size]
        right[:, 8 - half :] = rest[:, half - size :]
        upper = quotients << np.uint64(8 * (half - size))
        return left.view(">u8")[:, 0].astype(np.uint64) | upper, right.view(">u8")[:, 0].astype(np.uint64), counts


def _phrases(codes: np.ndarray, own: int, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The word numbers of all phrases of two (first number 0) and three words; 0 in ``ids``: rare."""
    word = ids[codes >> 1]
    goes_on = np.zeros(len(codes), bool)
    goes_on[:-1] = ((codes[:-1] & 1) == 0) & (word[:-1] > 0) & (word[1:] > 0)
    two = np.flatnonzero(goes_on[:own])
    three = two[goes_on[two + 1]]
    a = np.concatenate((np.zeros(len(two), np.uint64), word[three]))
    return a, np.concatenate((word[two], word[three + 1])), np.concatenate((word[two + 1], word[three + 2]))


def _filters(chunks: DataFrame, permutation: Permutation, ranges: int) -> DataFrame:
    """range, filter: the counting filters of all tasks, cut into ranges of quotients.

    ``chunks`` has codes, own, and ``numbers`` (struct of code and id of the dictionary's frequent words).
    """
    half = permutation.half
    shift = np.uint64(max(0, 8 * half - 32))
    scale = np.uint64(min(8 * half, 32))

    def handed(waiting: list) -> Iterator[pa.RecordBatch]:
        found = QuotientFilter.counted(half, waiting)
        if not len(found.left):
            return
        part = ((found.left >> shift) * np.uint64(ranges)) >> scale
        cuts = np.flatnonzero(np.diff(part.astype(np.int64), prepend=-1, append=ranges))
        pieces = list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
        files = [found.packed(a, b) for a, b in pieces]
        yield pa.RecordBatch.from_arrays([pa.array(part[cuts[:-1]].astype(np.int64)), pa.array(files, pa.binary())], ["range", "filter"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list = []
        size = 0
        for batch in batches:
            for row in range(batch.num_rows):
                codes = np.frombuffer(batch.column("codes")[row].as_buffer(), np.uint32)
                numbers = batch.column("numbers")[row].values
                ids = np.zeros(int(codes.max() >> 1) + 1 if len(codes) else 1, np.uint64)
                if numbers is not None and len(numbers):
                    ids[numbers.field("code").to_numpy()] = numbers.field("id").to_numpy().astype(np.uint64)
                own = batch.column("own")[row].as_py()
                for at in range(0, own, STEP_WORDS):
                    n = min(STEP_WORDS, own - at)
                    waiting.append(permutation.permuted(*_phrases(codes[at : at + n + 2], n, ids)))
                    size += len(waiting[-1][0])
                    if size >= FILTER_PHRASES:
                        yield from handed(waiting)
                        waiting.clear()
                        size = 0
        if waiting:
            yield from handed(waiting)

    return chunks.mapInArrow(H.trimmed(run), "range long, filter binary")


def _merged(filters: DataFrame, permutation: Permutation, least: int) -> DataFrame:
    """w1 (0: a phrase of two words), w2, w3, f of all phrases with ``least`` places."""

    def run(table: pa.Table) -> pa.Table:
        found = QuotientFilter.of_all(permutation.half, [raw.as_buffer() for raw in table.column("filter")])
        often = found.counts >= least
        words = permutation.words(found.left[often], found.right[often])
        columns = [pa.array(w.astype(np.int64)) for w in words]
        return pa.Table.from_arrays([*columns, pa.array(found.counts[often])], ["w1", "w2", "w3", "f"])

    return filters.groupBy("range").applyInArrow(run, "w1 long, w2 long, w3 long, f long")


# -- scores ---------------------------------------------------------------------------------------


def phrase_counts(docs: DataFrame, least: int = LEAST_COUNT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All words of ``docs`` by language (lang, n), the words with ``least`` places (lang, word, f, id),
    and the phrases of two and three of their numbers with ``least`` places (w1, w2, w3, f).

    A phrase that often has only words that often, so rarer words just part phrases.
    """
    spark = docs.sparkSession
    chunks = stored(_chunks(docs))
    entries = chunks.select("chunk", F.posexplode("entries").alias("code", "entry")).select("chunk", "code", "entry.*")
    words = entries.groupBy("lang", "word").agg(F.sum("places").alias("f")).where("f > 0")
    often = stored(_numbered(words.where(F.col("f") >= least)))
    totals = stored(entries.groupBy("lang").agg(F.sum("places").alias("n")).where("n > 0"))
    size = totals.agg(F.sum("n")).first()[0] or 0
    highest = often.agg(F.max("id")).first()[0] or 0
    permutation = Permutation(max(1, highest.bit_length()))
    ranges = max(1, -(-size // RANGE_WORDS), shuffle_partitions(spark))
    # More tasks than ranges, so that a task's rows, which Arrow hands over together, stay few.
    tasks = 2 * ranges
    numbers = (
        entries.select("chunk", "code", "lang", "word")
        .join(often.select("lang", "word", "id"), ["lang", "word"])
        .repartition(tasks, "chunk")
        .groupBy("chunk")
        .agg(F.collect_list(F.struct("code", "id")).alias("numbers"))
    )
    coded = chunks.select("chunk", "own", "codes").repartition(tasks, "chunk").join(numbers.hint("merge"), "chunk")
    filters = _filters(coded, permutation, ranges)
    return totals, often, stored(_merged(filters, permutation, least))


def _score(a: str, left: str, right: str):
    """floor(1000000 a a / (l r)), exact below 10**15 places."""
    wide = "cast(cast({0} as decimal(15, 0)) * cast({1} as decimal(15, 0)) as decimal(31, 0))"
    return F.expr(f"cast((cast(1000000 as decimal(7, 0)) * {wide.format(a, a)}) div {wide.format(left, right)} as bigint)")


def collocations(docs: DataFrame, least: int = LEAST_COUNT, top: int = TOP, covered: int = COVERED_PERCENT) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the ``top`` phrases of each language.

    ``docs`` has text (null: empty) and lang (null: ``und``). A phrase (two or three words of one piece,
    ``least`` places or more) is cut where its score is lowest, the first such cut if several are. It
    is dropped where a longer candidate around it has ``covered`` percent of its places or more. Ranks
    go by score, places and phrase (bytes), so there are no ties. Repeated rows count as often; an empty table
    or a language without candidates gives no rows; other columns are not read.
    """
    totals, often, phrases = phrase_counts(docs, least)
    two = phrases.where("w1 = 0").select(F.col("w2").alias("a1"), F.col("w3").alias("a2"), "f")
    first = often.select(F.col("id").alias("a1"), "lang", F.col("word").alias("word1"), F.col("f").alias("f1"))
    second = often.select(F.col("id").alias("a2"), F.col("word").alias("word2"), F.col("f").alias("f2"))
    pairs = stored(two.join(first, "a1").join(second, "a2"))
    heads = pairs.select(F.col("a1").alias("w1"), F.col("a2").alias("w2"), "lang", "word1", "word2", F.col("f").alias("f12"), "f1")
    tails = pairs.select(F.col("a1").alias("w2"), F.col("a2").alias("w3"), F.col("word2").alias("word3"), F.col("f").alias("f23"), F.col("f2").alias("f3"))
    three = stored(phrases.where("w1 > 0").join(heads, ["w1", "w2"]).join(tails, ["w2", "w3"]))
    score1, score2 = _score("f", "f1", "f23"), _score("f", "f12", "f3")
    long_ = three.withColumns({"s1": score1, "s2": score2}).select(
        "lang",
        F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"),
        F.col("f").alias("a"),
        F.when(F.col("s2") < F.col("s1"), F.col("f12")).otherwise(F.col("f1")).alias("l"),
        F.when(F.col("s2") < F.col("s1"), F.col("f3")).otherwise(F.col("f23")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )
    around = three.select(F.explode(F.array(F.struct(F.col("w1").alias("a1"), F.col("w2").alias("a2")), F.struct(F.col("w2").alias("a1"), F.col("w3").alias("a2")))).alias("pair"), "f")
    most = around.groupBy("pair.a1", "pair.a2").agg(F.max("f").alias("longer"))
    open_ = pairs.join(most, ["a1", "a2"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < covered * F.col("f")))
    short = open_.select(
        "lang", F.concat_ws(" ", "word1", "word2").alias("phrase"), F.col("f").alias("a"), F.col("f1").alias("l"), F.col("f2").alias("r"),
        _score("f", "f1", "f2").alias("score"),
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # A language may hold all phrases: the best of each of its parts first, then the best of those.
    part = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    best = long_.union(short).withColumn("part", part)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
