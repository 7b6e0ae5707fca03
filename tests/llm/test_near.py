"""SimHash near-duplicates, exact substrings, fuzzy passages and benchmark leaks against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark import cloudpickle

from tests.llm.small import SF, edge_documents, texts_of
from tillroll.llm import chains, graph, hashing, leaks, queries, simhash, suffixes

VISIBLE = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {i: i + 32 for i in range(65, 91)}


# -- SimHash ------------------------------------------------------------------------------------


def fingerprint(text: str | None) -> int:
    words = VISIBLE.findall((text or "").translate(UPPER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_reachable(nodes: dict, linked) -> dict:
    """By union-find over all pairs of keys of ``nodes``: the least value of each component."""
    keys = list(nodes)
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[:i]:
            if linked(a, b):
                root[find(a)] = find(b)
    best = {}
    for k in keys:
        best[find(k)] = min(best.get(find(k), nodes[k]), nodes[k])
    return {k: best[find(k)] for k in keys}


def check_simhash(rows, result):
    lowest: dict[int, int] = {}
    for doc_id, text in rows:
        f = fingerprint(text)
        value = -(1 << 63) if doc_id is None else doc_id
        lowest[f] = min(lowest.get(f, value), value)
    least = smallest_reachable(lowest, lambda a, b: (a ^ b).bit_count() <= 2)
    expected = Counter()
    for doc_id, text in rows:
        f = fingerprint(text)
        expected[(doc_id, f"{f:016x}", None if least[f] == -(1 << 63) else least[f])] += 1
    assert Counter(tuple(r) for r in result) == expected


def test_simhash_matches_plain_python(spark):
    check_simhash(texts_of(spark), queries.op2_simhash(spark, SF).collect())


def test_simhash_of_odd_rows(spark):
    docs = edge_documents(spark)
    check_simhash([(r.doc_id, r.text) for r in docs.collect()], simhash.near_duplicates(docs).collect())
    assert simhash.near_duplicates(docs.limit(0)).collect() == []
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert [r.doc_id for r in kept.collect()].count(7) == 1


def test_links_connect_all_fingerprints_within_two_bits(spark):
    rng = random.Random(5)
    fps = {rng.getrandbits(64) for _ in range(60)}
    for f in list(fps):
        for _ in range(5):  # chains of near neighbours, and some three bits off
            f ^= 1 << rng.randrange(64) ^ (1 << rng.randrange(64) if rng.random() < 0.8 else 0) ^ (1 << rng.randrange(64) if rng.random() < 0.3 else 0)
            fps.add(f)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    pairs = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long")).collect()
    assert all(((r.a ^ r.b) & ((1 << 64) - 1)).bit_count() <= 2 for r in pairs)
    found = smallest_reachable({f: f for f in signed}, lambda a, b, p={frozenset((r.a, r.b)) for r in pairs}: frozenset((a, b)) in p)
    wanted = smallest_reachable({f: f for f in signed}, lambda a, b: ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 2)
    assert found == wanted


def test_golay_decodes_every_word_to_a_codeword_within_three_bits():
    golay = simhash.Golay()
    rng = np.random.default_rng(1)
    message = rng.integers(0, 1 << 12, 4000).astype(np.uint32)
    # The codeword of a message: what decoding leaves unchanged.
    words = message << np.uint32(11)
    code = words ^ (golay.bytes[0, words & 255] ^ golay.bytes[1, words >> 8 & 255] ^ golay.bytes[2, words >> 16 & 255])
    for flips in range(4):
        noisy = code.copy()
        for i in range(len(noisy)):
            for bit in rng.choice(23, flips, replace=False):
                noisy[i] ^= np.uint32(1 << int(bit))
        assert (golay.index(noisy) == message).all()


@settings(max_examples=200, deadline=None)
@given(st.integers(0, (1 << 22) - 1), st.lists(st.integers(0, 20), max_size=2))
def test_segments_within_two_bits_share_a_codeword_index(word, flips):
    golay = simhash.Golay()
    other = word
    for bit in flips:
        other ^= 1 << bit
    keys = [set(golay.near(np.array([w], np.uint32), 21)[1].tolist()) for w in (word, other)]
    assert keys[0] & keys[1]


def test_components_of_a_long_path_and_a_star(spark):
    order = random.Random(3).sample(range(400), 400)
    edges = list(zip(order, order[1:], strict=False)) + [(1000, i) for i in range(1001, 1300)] + [(5000, 5000)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(400)} == {0}
    assert {got[i] for i in range(1000, 1300)} == {1000}


# -- exact substrings ---------------------------------------------------------------------------


def removed_bytes(rows):
    """For each (doc_id, text): the result row of the contract."""
    first: dict[bytes, tuple] = {}
    for doc_id, text in rows:
        raw = (text or "").encode()
        rank = (doc_id is not None, doc_id)
        for i in range(len(raw) - 49):
            s = raw[i : i + 50]
            first[s] = min(first.get(s, rank), rank)
    out = []
    for doc_id, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - 49):
            if first[raw[i : i + 50]] < (doc_id is not None, doc_id):
                gone[i : i + 50] = b"\1" * 50
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((doc_id, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def test_suffix_dedup_matches_brute_force(spark):
    rows = texts_of(spark)
    assert Counter(tuple(r) for r in queries.op4_suffix_dedup(spark, SF).collect()) == removed_bytes(rows)


def test_suffix_dedup_of_odd_rows(spark):
    docs = edge_documents(spark)
    got = suffixes.deduplicated(docs).drop("spans").collect()
    assert Counter(tuple(r) for r in got) == removed_bytes([(r.doc_id, r.text) for r in docs.collect()])
    assert suffixes.deduplicated(docs.limit(0)).collect() == []


def test_suffix_dedup_of_overlaps_and_runs(spark):
    rng = random.Random(11)
    base = "".join(rng.choice("abcdef ") for _ in range(600))
    rows = [(i, base[rng.randrange(300) :][: rng.randrange(40, 300)] + rng.choice(["", "zz"]) + base[rng.randrange(500) :]) for i in range(60)]
    rows += [(100, "a" * 300), (101, "a" * 49), (102, "b" + "a" * 120 + "b"), (103, "é" * 90), (104, "xé" + "é" * 60)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert Counter(tuple(r) for r in suffixes.deduplicated(docs).drop("spans").collect()) == removed_bytes(rows)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"ab", b"abcabcabcabc" * 4]), min_size=1, max_size=30), st.integers(1, 60), st.integers(0, 40))
def test_suffixes_are_sorted(parts, length, shallow):
    data = np.frombuffer(b"".join(parts), np.uint8)
    starts = np.arange(max(1, len(data) - length + 1))
    group = starts % 3
    rank = suffixes.sort_suffixes(data, starts, group, length, shallow)
    raw = bytes(data) + bytes(length)
    keys = [(g, raw[s : s + length]) for g, s in zip(group.tolist(), starts.tolist(), strict=True)]
    places = sorted(keys)
    assert rank.tolist() == [places.index(k) for k in keys]


@pytest.mark.parametrize("at_once", [1, 7, 50])
def test_rows_of_one_anchor_may_come_in_many_batches(spark, monkeypatch, at_once):
    middle = "the very same passage that many documents hold in the middle of them " * 2
    rows = [(i % 70, f"{i % 9}" * 30 + middle[: 80 + i % 50] + f"{i % 5}" * 60 + middle[i % 20 :]) for i in range(90)]
    monkeypatch.setattr(suffixes, "ROWS_AT_ONCE", at_once)
    # Functions of an installed module travel by name; by value the changed setting goes with them.
    cloudpickle.register_pickle_by_value(suffixes)
    try:
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        got = suffixes.deduplicated(docs).drop("spans").collect()
    finally:
        cloudpickle.unregister_pickle_by_value(suffixes)
    assert Counter(tuple(r) for r in got) == removed_bytes(rows)


# -- leaks --------------------------------------------------------------------------------------


def words_of(text: str | None) -> list[str]:
    return LETTERS.findall((text or "").translate(UPPER))


def least_edits(item: list[str], words: list[str]) -> int:
    """Edits from ``item`` to the nearest stretch of ``words``, by the textbook table."""
    row = np.zeros(len(words) + 1, int)
    for i, w in enumerate(item, 1):
        new = np.minimum(row[:-1] + np.array([w != x for x in words], int), row[1:] + 1) if words else np.zeros(0, int)
        new = np.concatenate(([i], new))
        for j in range(1, len(new)):
            new[j] = min(new[j], new[j - 1] + 1)
        row = new
    return int(row.min())


def brute_leaks(docs, items, similarity=leaks.SIMILARITY):
    out = {}
    for doc_id, text in docs:
        words = words_of(text)
        own = set(words)
        for item_id, item_text in items:
            item = words_of(item_text)
            if len(item) < 3 or sum(w not in own for w in item) > (1 - similarity) * len(item):
                continue
            edits = least_edits(item, words)
            if edits <= (1 - similarity) * len(item) + 1e-9:
                out[doc_id, item_id] = edits
    return out


def test_leaks_match_brute_force(spark):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id): r.edits for r in queries.op6_decontamination(spark, SF).collect()}
    assert got == brute_leaks(texts_of(spark), items)


@pytest.mark.parametrize("edits, least", [(0, 1.0), (1, 0.97), (3, 0.9)])
def test_recall_of_edited_passages(spark, edits, least):
    rng = random.Random(edits)
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    filler = [w for _, t in texts_of(spark)[:50] for w in (t or "").split()]
    rows = []
    for n, r in enumerate(bench.collect() * 4):
        words = r.text.split()
        for _ in range(min(edits, len(words) // 6)):
            at = rng.randrange(len(words))
            words[at : at + 1] = rng.choice([[], ["changed"], [words[at], "added"]])
        a = rng.randrange(len(filler) - 100)
        rows.append((n, r.item_id, " ".join(filler[a : a + 60]) + " " + " ".join(words).translate({i: i - 32 for i in range(97, 123)}) + ". " + " ".join(filler[a + 60 : a + 90])))
    docs = spark.createDataFrame([(n, t) for n, _, t in rows], "doc_id long, text string")
    found = {(r.doc_id, r.item_id) for r in leaks.leaks(docs, bench).collect()}
    assert sum((n, item) in found for n, item, _ in rows) >= least * len(rows)


@pytest.mark.parametrize("size, edits", [(3, 0), (4, 0), (5, 1), (7, 1), (8, 1), (10, 2), (14, 2), (20, 4), (24, 4), (30, 6), (60, 12)])
def test_recall_at_the_most_edits(size, edits):
    """At every length, with as many edits as are allowed; verbatim short items are always found."""
    rng = random.Random(size)
    vocabulary = [f"w{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choices(vocabulary, k=size))) for i in range(300)]
    index = leaks.Index(items)
    found = 0
    for i, text in items:
        words = text.split()
        for k in range(edits):
            at = rng.randrange(len(words))
            words[at : at + 1] = rng.choice([[], [f"x{i}x{k}"], [words[at], f"x{i}x{k}"]])
        document = " ".join(rng.choices(vocabulary, k=60) + words + rng.choices(vocabulary, k=60))
        hashes, _ = leaks.word_hashes(*hashing.text_bytes(pa.array([document], pa.large_string())))
        position, number, offset = index.hits(hashes)
        found += bool(((number == i) & (abs(position - offset - 60) <= edits)).any())
    assert found >= (1 if edits == 0 else 0.95) * len(items)


def test_leaks_of_odd_rows_and_blocks_of_items(spark):
    items = [(1, "the mit license and the apache license"), (2, None), (3, ""), (4, "mit license"), (None, "plain1 text1 plain2 text4 plain3 text9 plain4 text16"), (5, "one")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumnsRenamed({}).selectExpr("*", "1 AS doc_id")
    docs = edge_documents(spark)
    expected = {}
    for r in docs.collect():
        for key, edits in brute_leaks([(r.doc_id, r.text)], [(i, t) for i, t in items if t]).items():
            expected[key] = min(expected.get(key, edits), edits)
    for block_words in (leaks.BLOCK_WORDS, 4):
        got = {(r.doc_id, r.item_id): r.edits for r in leaks.leaks(docs, bench, block_words=block_words).collect()}
        assert got == expected
    assert leaks.leaks(docs.limit(0), bench).collect() == []
    assert leaks.leaks(docs, bench.limit(0)).collect() == []
    clean = leaks.without_leaks(docs, bench)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in docs.collect()} - {d for d, _ in expected}


@pytest.mark.parametrize("block_words", [leaks.BLOCK_WORDS, 20])
def test_the_driver_makes_no_index_of_the_benchmark(spark, monkeypatch, block_words):
    """Only tasks do; the driver's memory does not follow the number of items."""
    items = [(i, " ".join(f"item{i}word{k}" for k in range(6 + i % 30))) for i in range(40)]
    docs = spark.createDataFrame([(i, f"before {text} after") for i, text in items] + [(99, "nothing of it")], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(leaks, "Index", None)
    found = leaks.leaks(docs, bench, block_words=block_words).collect()
    assert sorted((r.doc_id, r.item_id, r.edits, r.first_word, r.n_words) for r in found) == [(i, i, 0, 1, 6 + i % 30) for i, _ in items]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=12), st.lists(st.integers(0, 4), max_size=30))
def test_bit_parallel_distances(a, b):
    x, y = np.array(a, np.uint64), np.array(b, np.uint64)
    assert leaks.nearest(x, y)[0] == least_edits([str(i) for i in a], [str(i) for i in b])
    row = list(range(len(b) + 1))
    for i, w in enumerate(a, 1):
        new = [i]
        for j, v in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (w != v)))
        row = new
    assert chains.edit_distance(x, y) == row[-1]


# -- fuzzy passages -----------------------------------------------------------------------------


def test_planted_passages_are_found_and_clean_documents_are_not(spark):
    rng = random.Random(8)

    def prose(n):
        return [f"{rng.choice('bcdfgklmnprst')}{rng.randrange(4000)}" for _ in range(n)]

    passages = [prose(rng.randrange(52, 120)) for _ in range(12)]
    rows, planted = [], {}
    for doc_id in range(150):
        words = prose(rng.randrange(30, 400))
        if doc_id % 2:
            which = rng.randrange(12)
            passage = list(passages[which])
            for _ in range(rng.choice([0, 0, 2, 4])):
                at = rng.randrange(5, len(passage) - 5)
                passage[at : at + 1] = rng.choice([[], ["edited"], [passage[at], "more"]])
            at = rng.randrange(len(words))
            words[at:at] = passage
            planted.setdefault(which, []).append((doc_id, at, len(passage)))
        rows.append((doc_id, " ".join(words)))
    result = chains.passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    place = {d: (w, at, n) for w, docs in planted.items() for d, at, n in docs}
    assert all(r.doc_id in place and r.other_id in place and r.other_id < r.doc_id for r in result)
    for docs in planted.values():
        for doc_id, at, n in docs[1:]:
            spans = [(r.first_word, r.last_word) for r in result if r.doc_id == doc_id]
            assert spans and max(b for _, b in spans) - min(a for a, _ in spans) >= 0.8 * n, doc_id
            assert min(a for a, _ in spans) >= at - 3 and max(b for _, b in spans) <= at + n + 3


@pytest.mark.parametrize("parts", [1, 30])
def test_holders_of_parts_of_a_passage_hide_no_holder_of_the_whole(spark, parts):
    """Documents 10 and 20 share 60 words; before each of them, others hold the first or the second half."""
    rng = random.Random(3)
    passage = [f"shared{i}" for i in range(60)]
    for firsts, seconds in (([1, 15], [2, 16]), ([*range(1, 6), *range(11, 16)], [*range(6, 10), *range(16, 20)])):
        held = {10: passage, 20: passage, **dict.fromkeys(firsts, passage[:30]), **dict.fromkeys(seconds, passage[30:])}
        rows = [(d, " ".join([f"own{rng.randrange(10**9)}" for _ in range(50)] + held.get(d, []) + [f"own{rng.randrange(10**9)}" for _ in range(50)])) for d in range(60)]
        found = chains.passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts, "doc_id")).collect()
        assert [(r.doc_id, r.other_id, r.first_word, r.last_word) for r in found] == [(20, 10, 50, 109)]


def passages_of_all_pairs(texts: list[str]) -> set:
    """Passages between any two different texts, by matching every place of every seed in both."""
    words = []
    for text in texts:
        block = hashing.Words(hashing.LOWER[np.frombuffer(text.encode(), np.uint8)], np.array([0, len(text.encode())]), hashing.LETTERS)
        words.append(block.hashes())
    places = []
    for own in words:
        grams = hashing.gram_hashes(own, chains.SEED_WORDS)
        at = chains._chosen(grams, chains.SEED_WINDOW) if len(grams) else np.zeros(0, int)
        zero = np.zeros(len(at), int)
        places.append(list(zip(*(x.tolist() for x in chains._runs(grams[at], zero, at, zero)), strict=True)) if len(at) else [])
    found = set()
    for i, j in ((i, j) for i in range(len(texts)) for j in range(i)):
        met = set()
        for seed, _, x, n, _ in places[i]:
            for other, _, y, m, _ in places[j]:
                if seed == other:
                    least = min(n, m)
                    met |= {(x, y, least), (x + n - least, y + m - least, least)}
        if not met:
            continue
        x, y, size = chains.segments(*(np.array(v) for v in zip(*sorted(met), strict=True)))
        for links in chains.chain(x, y, size):
            if x[links[-1]] + size[links[-1]] - x[links[0]] >= chains.LEAST_CHAIN:
                for x0, y0, x1, y1, edits in chains.align(words[i], words[j], x[links], y[links], size[links]):
                    n = max(x1 - x0, y1 - y0)
                    if n >= chains.LEAST_PASSAGE and edits <= (1 - chains.SIMILARITY) * n:
                        found.add((i, j, x0, x1 - 1, y0, y1 - 1, edits))
    return found


@pytest.mark.parametrize("few", [1, 12, chains.FEW])
def test_passages_are_those_of_all_pairs(spark, monkeypatch, few):
    """Edited passages, common lines, repeated words and sentences: no pair is left out, however many documents share a seed."""
    rng = random.Random(few)

    def own(n):
        return [f"own{rng.randrange(10**9)}" for _ in range(n)]

    passages = [own(70), own(50), own(90)]
    lines = [own(12), own(14), own(7), ["again"] * 30, (own(9) * 6)[:50]]
    texts = []
    for i in range(45):
        words = own(rng.randrange(5, 40))
        for _ in range(rng.randrange(1, 4)):
            part = list(rng.choice(passages + lines))
            for _ in range(rng.choice([0, 1, 3, 6])):
                at = rng.randrange(len(part))
                part[at : at + 1] = rng.choice([[], own(1), [part[at], *own(1)]])
            words += part * rng.choice([1, 1, 2]) + own(rng.choice([0, 3, 30]))
        texts.append(" ".join(words))
    texts += ["again " * n for n in (60, 61, 90)]
    monkeypatch.setattr(chains, "FEW", few)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = {(r.doc_id, r.other_id, r.first_word, r.last_word, r.other_first, r.other_last, r.edits) for r in chains.passages(docs).collect()}
    expected = passages_of_all_pairs(texts)
    assert got == expected
    assert len({x[:2] for x in expected}) > 150


def test_copies_stand_under_their_first_document(spark):
    rng = random.Random(5)
    passage, text = (" ".join(f"own{rng.randrange(10**9)}" for _ in range(n)) for n in (60, 33))
    rows = [(1, f"a b {passage}"), (2, f"c {passage}"), (3, f"a b {passage}"), (3, f"a b {passage}"), (4, f"c {passage}"), (5, text), (6, text), (None, text), (7, "short"), (8, "short")]
    got = chains.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    whole = lambda a, b, n: (a, b, 0, n - 1, 0, n - 1, 0)
    assert sorted((tuple(r)[:7] for r in got), key=str) == sorted([(2, 1, 1, 60, 2, 61, 0), whole(3, 1, 62), whole(4, 2, 61), whole(5, None, 33), whole(6, None, 33)], key=str)


def test_texts_under_one_doc_id(spark):
    """They give nothing between them, but a text that other documents have too is met under one of these."""
    rng = random.Random(6)
    passage = " ".join(f"own{rng.randrange(10**9)}" for _ in range(60))
    rows = [(1, f"a {passage}"), (1, f"b {passage}")]
    assert chains.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect() == []
    got = chains.passages(spark.createDataFrame([*rows, (2, f"b {passage}")], "doc_id long, text string")).collect()
    assert {(r.doc_id, r.other_id, r.first_word, r.last_word) for r in got} == {(2, 1, 1, 60), (2, 1, 0, 60)}


def test_chain_prefers_order_and_leaves_strays_out():
    x = np.array([0, 10, 20, 12, 30])
    y = np.array([100, 110, 121, 400, 131])
    best = chains.chain(x, y, np.full(5, 6))
    assert best[0] == [0, 1, 2, 4]
    assert [3] in best


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 60), st.integers(1, 8)), min_size=1, max_size=12))
def test_best_chain_is_the_best_of_all(parts):
    x, y, size = (np.array(c) for c in zip(*parts, strict=True))

    def score(links):
        total = 0.0
        for k, i in enumerate(links):
            if k:
                j = links[k - 1]
                gap = x[i] - x[j] - size[j], y[i] - y[j] - size[j]
                if min(gap) < 0:
                    return float("-inf")
                total -= chains.GAP_COST * sum(gap)
            total += size[i]
        return total

    best = {i: float(size[i]) for i in range(len(x))}
    for _ in range(len(x)):
        for i in range(len(x)):
            for j in range(len(x)):
                if x[j] + size[j] <= x[i] and y[j] + size[j] <= y[i]:
                    best[i] = max(best[i], best[j] + size[i] - chains.GAP_COST * (x[i] - x[j] - size[j] + y[i] - y[j] - size[j]))
    found = chains.chain(x, y, size)
    assert score(found[0]) == pytest.approx(max(best.values()))
    assert sorted(i for links in found for i in links) == list(range(len(x)))


def test_passages_of_odd_rows(spark):
    docs = edge_documents(spark)
    got = chains.passages(docs).collect()
    assert {(r.doc_id, r.other_id) for r in got} >= {(8, None), (7, None)}
    assert all(r.doc_id is not None and (r.other_id is None or r.other_id < r.doc_id) for r in got)
    assert chains.passages(docs.limit(0)).collect() == []
