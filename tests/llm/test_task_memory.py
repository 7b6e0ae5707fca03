"""What a task holds and hashes, against the size of its block."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa

from tillroll.llm import collocations, grammar, tokens

TEXT = "some words, and others; in pieces. " * 30


def _peak(run) -> int:
    """The most bytes that NumPy holds at once during ``run``."""
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_coded_words_take_little_more_than_their_block():
    texts = [TEXT] * 1000
    batch = pa.RecordBatch.from_pydict({"text": texts, "lang": ["en"] * len(texts)})
    assert _peak(lambda: list(collocations._coded(batch))) < 11 * len(TEXT) * len(texts)


def test_pieces_end_where_their_ends_stand():
    texts = ["", ".", "a b", ". a, b ", "a;", "b.\nc d", "x", "..", "y z!"]
    batch = pa.RecordBatch.from_pydict({"text": texts, "lang": ["en"] * len(texts)})
    ((codes, own, entries),) = collocations._coded(batch)
    said = [(entries[int(c) >> 1]["word"].as_py(), bool(c & 1)) for c in codes[:own]]
    assert said == [("a", False), ("b", True), ("a", True), ("b", True), ("a", True), ("b", True), ("c", False), ("d", True), ("x", True), ("y", False), ("z", True)]


def test_filters_of_keys_are_merged_as_halves_are():
    generator = np.random.default_rng(5)
    left, right = (generator.integers(0, 40, 3000).astype(np.uint64) for _ in range(2))
    counts = generator.integers(1, 300, 3000)
    for half in (2, 4, 5):
        files = [collocations.QuotientFilter.merged(half, left[i::3], right[i::3], counts[i::3]) for i in range(3)]
        found = collocations.QuotientFilter.of_all(half, [f.packed(0, len(f.left)) for f in files])
        wanted: dict[tuple[int, int], int] = {}
        for a, b, n in zip(left.tolist(), right.tolist(), counts.tolist(), strict=True):
            wanted[a, b] = wanted.get((a, b), 0) + n
        assert list(zip(found.left.tolist(), found.right.tolist(), found.counts.tolist(), strict=True)) == [(*k, wanted[k]) for k in sorted(wanted)]


def test_tokens_take_less_than_six_times_their_block():
    texts = pa.array([TEXT] * 4000)
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        encoder = tokens.encoder(tokens.tokenizer_path(name))
        ids, counts = encoder.block(texts)
        assert _peak(lambda e=encoder: tokens.with_end(*e.block(texts), 0)) < 6 * len(TEXT) * len(texts)
        out, total = tokens.with_end(ids, counts, 0)
        assert (total == counts + 1).all() and len(set(counts.tolist())) == 1
        assert (out.reshape(4000, -1)[:, :-1].ravel() == ids).all() and not out.reshape(4000, -1)[:, -1].any()


def test_a_block_looks_known_parts_up_once(monkeypatch):
    encoder, asked = tokens.Encoder(tokens.tokenizer_path("byte_bpe_50k.json")), []
    places = tokens.Known.places
    monkeypatch.setattr(tokens.Known, "places", lambda known, texts: asked.append(known) or places(known, texts))
    texts = pa.array(["one two, three!", "", "\n1 \u00e9t\u00e9\nfour  five", " six\nseven 8 \u4e16\u754c", "one two"])
    for some in (texts, texts[3:], texts.take(pa.array([4, 2]))):
        asked.clear()
        ids, counts = encoder.block(some)
        assert len(asked) == len(set(map(id, asked)))
        wanted = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in some.to_pylist()]
        assert ids.tolist() == sum(wanted, []) and counts.tolist() == list(map(len, wanted))


def test_a_file_is_packed_without_its_expansions(monkeypatch):
    ids = np.random.default_rng(3).integers(0, 9, 5000).astype(np.uint16)
    symbols, rules = grammar.compress(ids, 9)
    text = [(i,) for i in range(9)]
    for pair in rules.tolist():
        text.append(text[pair >> 16] + text[pair & 0xFFFF])
    sizes, flat = grammar.expansions(rules, 9)
    assert sizes.tolist() == list(map(len, text)) and flat.tolist() == [i for t in text[9:] for i in t]
    monkeypatch.setattr(grammar, "expansions", None)
    raw = grammar.Shard.pack(np.arange(1), np.array([5000]), ids, 9)
    assert grammar.Shard(raw).sizes.tolist() == sizes[9:].tolist()
