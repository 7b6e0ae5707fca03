"""Near duplicates by SimHash fingerprints, found through Golay codewords.

A fingerprint is cut into three segments of at most 23 bits. Two fingerprints that differ in at most
two bits agree on one whole segment (pigeonhole), and differ in at most two bits on the next one. Any
two 23-bit words within two bits of each other have a word between them, within one bit of both, and
the perfect Golay code decodes that word to one codeword. So the codeword indices of all words
within one bit of a segment (one to six of them) are keys of which two such segments share one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm import hashing as H
from tillroll.llm.columns import free_name, rows_of
from tillroll.llm.graph import components
from tillroll.llm.store import stored

SHINGLE = 3
MAX_BITS = 2
SEED = 42

#: Position of the lowest bit and number of bits of each segment.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Fixed value: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1, generator of the binary Golay code.
GENERATOR = 0b101011100011


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): bit i of ``fp`` is set if it is set in over half of the shingles' XXH64.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased; a text of fewer words is one
    shingle; a null text or one without words has fingerprint 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in H.blocks(batches):
            fp = simhash_block(*H.text_bytes(batch.column("text")), shingle)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text")).mapInArrow(H.trimmed(run), "doc_id long, fp long")


def simhash_block(data: np.ndarray, offsets: np.ndarray, shingle: int) -> np.ndarray:
    words = H.Words(H.LOWER[data], offsets, H.VISIBLE)
    out = np.zeros(len(offsets) - 1, np.uint64)
    if not len(words.starts):
        return out
    joined, starts, ends = words.joined()
    n = np.where(words.counts > 0, np.maximum(words.counts - shingle + 1, 1), 0)
    first = H.ranges(words.first[:-1], n)
    last = np.minimum(first + shingle, np.repeat(words.first[1:], n)) - 1
    raw, digest = joined.tobytes(), xxhash.xxh64_intdigest
    spans = zip(starts[first].tolist(), ends[last].tolist(), strict=True)
    hashes = np.fromiter((digest(raw[a:b], SEED) for a, b in spans), np.uint64, len(first))
    full = np.flatnonzero(n)
    cuts = np.concatenate(([0], np.cumsum(n[full])[:-1]))
    for bit in range(64):
        ones = np.add.reduceat(((hashes >> np.uint64(bit)) & np.uint64(1)).astype(np.int32), cuts)
        out[full] |= (2 * ones > n[full]).astype(np.uint64) << np.uint64(bit)
    return out


def _syndromes(size: int = 23) -> np.ndarray:
    """The remainder of x^i modulo the generator, for each bit i."""
    out, r = [], 1
    for _ in range(size):
        out.append(r)
        r <<= 1
        if r >> 11:
            r ^= GENERATOR
    return np.array(out, np.uint32)


class Golay:
    """Decoder of the [23, 12] code: every word is within three bits of exactly one codeword."""

    def __init__(self):
        of_bit = _syndromes()
        self.bytes = np.zeros((3, 256), np.uint32)
        for place in range(3):
            for bit in range(min(8, 23 - 8 * place)):
                self.bytes[place, np.arange(256) >> bit & 1 == 1] ^= of_bit[8 * place + bit]
        self.error = np.zeros(2048, np.uint32)
        singles = [(1 << i, int(of_bit[i])) for i in range(23)]
        for a, (wa, sa) in enumerate(singles):
            self.error[sa] = wa
            for b, (wb, sb) in enumerate(singles[:a]):
                self.error[sa ^ sb] = wa | wb
                for wc, sc in singles[:b]:
                    self.error[sa ^ sb ^ sc] = wa | wb | wc

    def index(self, words: np.ndarray) -> np.ndarray:
        """The 12 message bits of the codeword nearest to each word."""
        w = words.astype(np.uint32)
        syndrome = self.bytes[0, w & 255] ^ self.bytes[1, w >> 8 & 255] ^ self.bytes[2, w >> 16 & 255]
        return (w ^ self.error[syndrome]) >> 11

    def near(self, words: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and the distinct indices of all words within one bit of each word."""
        flips = np.array([0, *(1 << i for i in range(bits))], np.uint32)
        found = np.sort(self.index(words.astype(np.uint32)[:, None] ^ flips), axis=1)
        fresh = np.ones(found.shape, bool)
        fresh[:, 1:] = found[:, 1:] != found[:, :-1]
        return np.nonzero(fresh)[0], found[fresh]


def golay_keys(fps: np.ndarray, golay: Golay) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and keys: a segment taken whole, and a codeword index near the next one."""
    parts = [(fps >> np.uint64(low)) & np.uint64((1 << size) - 1) for low, size in SEGMENTS]
    rows, keys = [], []
    for i, exact in enumerate(parts):
        j = (i + 1) % len(parts)
        row, index = golay.near(parts[j], SEGMENTS[j][1])
        rows.append(row)
        keys.append((np.uint64(i) << np.uint64(34)) | (exact[row] << np.uint64(12)) | index.astype(np.uint64))
    return np.concatenate(rows), np.concatenate(keys)


def links(fps: DataFrame) -> DataFrame:
    """(a, b): pairs of the distinct fingerprints ``fp`` through which all that differ in at most two
    bits are connected.

    Fingerprints that share no key with another are done. The others are verified: two of them are
    within two bits of each other exactly if there is a 64-bit word within one bit of both, and per
    such word each fingerprint is linked to the smallest. So a crowded key costs 65 rows for each of
    its fingerprints, never its pairs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        golay = Golay()
        for batch in batches:
            for at in range(0, batch.num_rows, 20_000):
                own = batch.column("fp").slice(at, 20_000).to_numpy(zero_copy_only=False)
                row, key = golay_keys(own.view(np.uint64), golay)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(own[row])], ["key", "fp"])

    keys = fps.select("fp").mapInArrow(H.trimmed(run), "key long, fp long")
    shared = keys.groupBy("key").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo != hi").select("key")
    near = keys.join(shared, "key").select("fp").distinct()
    flips = F.array(F.lit(0).cast("long"), *(F.expr(f"shiftleft(1L, {i})") for i in range(64)))
    words = near.select("fp", F.explode(flips).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("word"))
    least = words.groupBy("word").agg(F.min("fp").alias("a"), F.max("fp").alias("b")).where("a != b").select("word", "a")
    return words.join(least, "word").where("fp != a").select("a", F.col("fp").alias("b")).distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    Documents whose fingerprints differ in at most ``max_bits`` (two at most) bits are linked;
    ``component_id`` is the smallest doc_id that links lead to. A null doc_id counts as smaller than
    all others, and its component has a null id; repeated rows are given back as often; an empty table
    gives an empty result; other columns are not read.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("three segments find fingerprints that differ in at most two bits")
    prints = stored(fingerprints(docs, shingle))
    lowest = -(1 << 63)
    classes = stored(prints.groupBy("fp").agg(F.min(F.coalesce("doc_id", F.lit(lowest))).alias("rep")))
    pairs = links(classes)
    if max_bits < 2:
        pairs = _verified_closer(classes, max_bits)
    ends = pairs.join(classes.select(F.col("fp").alias("a"), F.col("rep").alias("ra")), "a").join(
        classes.select(F.col("fp").alias("b"), F.col("rep").alias("rb")), "b"
    )
    roots = components(ends.select(F.col("ra").alias("a"), F.col("rb").alias("b")))
    named = classes.join(roots, F.col("rep") == F.col("node"), "left").select("fp", F.coalesce("root", "rep").alias("root"))
    return prints.join(named, "fp").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.when(F.col("root") != lowest, F.col("root")).alias("component_id"),
    )


def _verified_closer(classes: DataFrame, max_bits: int) -> DataFrame:
    """Links of at most one bit: a neighbour is the fingerprint with one bit flipped."""
    flips = F.array(*(F.expr(f"shiftleft(1L, {i})") for i in range(64 if max_bits else 0))).cast("array<bigint>")
    flipped = classes.select("fp", F.explode(flips).alias("flip")).select(F.col("fp").alias("a"), F.col("fp").bitwiseXOR(F.col("flip")).alias("b"))
    return flipped.where("a < b").join(classes.select(F.col("fp").alias("b")), "b").select("a", "b")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with the document of the smallest doc_id of each component; one row of repeated ones."""
    found = near_duplicates(docs, shingle, max_bits)
    kept = rows_of(docs, found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))))
    text_hash = free_name(docs, "text_hash")
    return kept.withColumn(text_hash, F.xxhash64("text")).dropDuplicates(["doc_id", text_hash]).drop(text_hash)
