"""Pseudonyms, chat formatting, token files, packing and the whole pipeline."""

from __future__ import annotations

import hashlib
import random
import re
import string
import zlib
from collections import Counter, defaultdict
from datetime import date, timedelta

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.small import LONG, SF, edge_documents, texts_of
from tests.llm.test_near import brute_leaks, fingerprint, smallest_reachable
from tests.llm.test_reports import judged
from tillroll.llm import chat, grammar, hashing, leaks, lines, packing, pseudonyms, queries, tokens

BYTE, WORD = tokens.tokenizer_path("byte_bpe_50k.json"), tokens.tokenizer_path("word_bpe_49k.json")


# -- pseudonyms ---------------------------------------------------------------------------------


def digest(name, rnd, value, size):
    return int(hashlib.sha256(f"{queries.TRIAL_KEY}/{name}/{rnd}/{size}/{value}".encode()).hexdigest()[:15], 16)


def permuted(value, a, b, name):
    x, y = divmod(value, b)
    for rnd in range(pseudonyms.ROUNDS):
        if rnd % 2:
            y = (y + digest(name, rnd, x, a * b)) % b
        else:
            x = (x + digest(name, rnd, y, a * b)) % a
    return x * b + y


def digits_permuted(digits, name):
    n = len(digits)
    return str(permuted(int(digits), 10 ** (n - n // 2), 10 ** (n // 2), name)).zfill(n)


def luhn(body):
    total = sum(d if i % 2 else d * 2 // 10 + d * 2 % 10 for i, d in enumerate(int(c) for c in reversed(body)))
    return str(-total % 10)


LETTERS = ["0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"]
LETTERS.append("".join(c for c in map(chr, range(0xC0, 0x250)) if c not in "×÷"))


def stream(text, name, key=queries.TRIAL_KEY):
    """The places of each half move by a hash of the other one, in turns."""
    halves = [text[: len(text) // 2], text[len(text) // 2 :]]
    for rnd in range(pseudonyms.ROUNDS):
        half, other = halves[rnd % 2], halves[1 - rnd % 2]
        moves = hashlib.sha512(f"{key}/{name}/{rnd}/{len(half)}/{other}".encode()).digest()
        halves[rnd % 2] = "".join(moved_letter(c, by) for c, by in zip(half, moves, strict=False))
    return "".join(halves)


def moved_letter(letter, by):
    for letters in LETTERS:
        if letter in letters:
            return letters[(letters.index(letter) + by) % len(letters)]
    return letter


def test_letters_are_permuted_with_a_way_back(spark):
    names = [*string.ascii_lowercase, *(a + b for a in "abc9Zé" for b in string.ascii_letters), "", "anna.müller", "a" * 64, "A1" * 64, "×÷", "🙂b"]
    docs = spark.createDataFrame([(name,) for name in names], "name string")
    there = docs.select("name", pseudonyms.permute_letters(F.col("name"), "k", "n").alias("new"))
    rows = there.select("name", "new", pseudonyms.permute_letters(F.col("new"), "k", "n", back=True).alias("back")).collect()
    assert all(r.back == r.name and r.new == stream(r.name, "n", "k") for r in rows)
    assert len({r.new for r in rows}) == len(names)


def refilled(pattern, digits):
    left = iter(digits)
    return "".join(next(left) if c.isdigit() else c for c in pattern)


def replaced(match):
    found = match.group()
    digits = re.sub(r"\D", "", found)
    kind = next(name for name, pattern in PATTERNS.items() if re.fullmatch(pattern, found) and valid(name, found, digits) or name == "none")
    if kind == "email":
        head, at, tail = found.partition("@")
        return stream(head, "email") + at + tail
    if kind == "secret":
        head = re.match(r"(?:password|passwd|secret|token|api_key) ?[=:] ?[\"']?", found).group()
        return head + stream(found[len(head) :], "secret")
    if kind == "date":
        first = date(1900, 1, 1)
        return str(first + timedelta(permuted((date.fromisoformat(found) - first).days, 17, 4297, "date")))
    if kind == "phone":
        own = digits[-10:]
        mixed = digits_permuted(own[1:3] + own[4:], "phone")
        return refilled(found, digits[:-10] + own[0] + mixed[:2] + own[3] + mixed[2:])
    if kind == "phone_abroad":
        return refilled(found, digits[:2] + digits_permuted(digits[2:], "phone_abroad"))
    if kind == "ip":
        value = permuted(int.from_bytes(bytes(map(int, found.split("."))), "big"), 65536, 65536, "ip")
        return ".".join(map(str, value.to_bytes(4, "big")))
    if kind == "ssn":
        area, rest = int(digits[:3]), (int(digits[3:5]) - 1) * 9999 + int(digits[5:]) - 1
        area, rest = divmod(permuted((area - 2 if area > 666 else area - 1) * 99 * 9999 + rest, 898, 99 * 9999, "ssn"), 99 * 9999)
        return refilled(found, f"{area + 2 if area >= 665 else area + 1:03}{rest // 9999 + 1:02}{rest % 9999 + 1:04}")
    if kind == "card":
        body = digits_permuted(digits[:-1], "card")
        return refilled(found, body + luhn(body))
    return found


PATTERNS = {name: re.compile(p, re.ASCII) for name, p in pseudonyms.KINDS.items()} | {"none": re.compile("x^")}
ANY = re.compile(pseudonyms.ANY, re.ASCII)


def valid(name, found, digits):
    if name == "date":
        try:
            return bool(date.fromisoformat(found))
        except ValueError:
            return False
    if name == "ip":
        return all(int(o) < 256 for o in found.split("."))
    if name == "ssn":
        return not (digits[:3] in ("000", "666") or digits[0] == "9" or digits[3:5] == "00" or digits[5:] == "0000")
    return name != "card" or 13 <= len(digits) <= 19 and luhn(digits[:-1]) == digits[-1]


def pseudonymised(text):
    return None if text is None else ANY.sub(replaced, text)


def test_pseudonyms_match_plain_python(spark):
    for sf in ("sf0.001", "sf0.01"):
        docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
        got = {r.doc_id: r.text for r in queries.op8_pseudonyms(spark, f"/root/testdata/{sf}").collect()}
        assert got == {r.doc_id: pseudonymised(r.text) for r in docs.collect()}
    assert sum(got[i] != t for i, t in texts_of(spark, f"/root/testdata/{sf}")) > 20


ODD = [
    "mail bob.x@a.example.com and bob.x@a.example.com, not @home or a@b",
    "call +1 (212) 555-1234 or 212-555-1234 or 212.555.1234; not 12345-555-1234",
    "card 4041894974608795, 4041 8949 7460 8795, bad 4041894974608796, long 40418949746087951234567",
    "ip 10.0.255.1. and 300.1.1.1 and 1.2.3.4.5 and 010.001.000.255",
    "born 1999-12-31, 1999-02-30, 2000-02-29, 1899-01-01, 2099-12-31, 1900-01-01, 12000-01-01",
    "ssn 123-45-6789 000-12-3456 666-12-3456 912-12-3456 123-00-4567 123-45-0000 899-99-9999",
    "password=e3b3ed3cc8548923d6 token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\" token: international api_key: 'abc12345'",
    "9" * 400 + "@" * 50 + "1.1.1.1" * 30,
    "",
    None,
]


def test_odd_values_and_clashing_columns(spark):
    docs = spark.createDataFrame(list(enumerate(ODD)) + [(3, ODD[3])], "doc_id long, text string").selectExpr("*", "7 AS _found", "8 AS _new", "9 AS pii")
    got = pseudonyms.pseudonymised(docs, queries.TRIAL_KEY)
    assert got.columns == docs.columns
    rows = got.collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r.doc_id, pseudonymised(r.text)) for r in docs.collect())
    assert all(r._found == 7 and r._new == 8 for r in rows)
    kinds = {r.doc_id: Counter(p.kind for p in r.pii if p.kind) for r in rows}
    assert kinds[0] == {"email": 2} and kinds[2] == {"card": 2} and kinds[4] == {"date": 4} and kinds[5] == {"ssn": 2} and kinds[6] == {"secret": 3}
    edge = edge_documents(spark)
    assert pseudonyms.pseudonymised(edge, queries.TRIAL_KEY).count() == edge.count()
    assert pseudonyms.pseudonymised(edge.limit(0), queries.TRIAL_KEY).collect() == []


def test_secrets_behind_names_in_any_case(spark):
    bodies = ["9233A8ECF7C5B09FE594", "e3b3ed3cc8548923d6", "Abc/12345", "abc+12345", "abc_12345"]
    lower = [f'{name} = "{body}"' for name, body in zip(("token", "password", "passwd", "secret", "api_key"), bodies, strict=True)]
    rows = [*lower, *(f"{x.split()[0].upper()}{x[x.index(' ') :]}" for x in lower), *(x.title()[: x.index(" ")] + x[x.index(" ") :] for x in lower)]
    got = [r for r in pseudonyms.pseudonymised(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"), queries.TRIAL_KEY).orderBy("doc_id").collect()]
    for r, text in zip(got, rows, strict=True):
        head, body = text[: text.index('"') + 1], text.split('"')[1]
        assert r.text == f'{head}{stream(body, "secret")}"' and [p.kind for p in r.pii] == ["secret"]


def test_names_beyond_ascii_and_numbers_abroad(spark):
    """What is found is written out here, apart from the patterns of the module."""
    texts = {
        "an anna.müller@firma.de und": ["anna.müller@firma.de"],
        "Ærø@søby.dk, 我的邮箱是bob@x.cn。": ["Ærø@søby.dk", "bob@x.cn"],
        "ruf +49 170 1234567 an": ["+49 170 1234567"],
        "tel +33(1)42685300 or +442079460958.": ["+33(1)42685300", "+442079460958"],
        "+4041 8949 7460 8795 is a card": ["4041 8949 7460 8795"],
        "a+2345 b +49 12 and x = +20000": [],
        "+1 212-555-1234": ["+1 212-555-1234"],
    }
    rows = [(i, text) for i, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in pseudonyms.pseudonymised(docs, "k").collect()}
    for i, (text, values) in enumerate(texts.items()):
        left = text
        for old, new in zip(values, got[i].pii, strict=True):
            assert len(old) == len(new.pseudonym) and old != new.pseudonym
            left = left.replace(old, new.pseudonym)
        assert got[i].text == left
    other = {r.doc_id: r.text for r in pseudonyms.pseudonymised(docs, "another").collect()}
    assert other[2] != got[2].text


def test_the_main_path_has_no_python(spark):
    for name in ("op8_pseudonyms", "op9_chat"):
        plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|ExistingRDD", plan)


def test_feistel_is_a_permutation_with_a_way_back(spark):
    a, b = F.lit(17).cast("long"), F.lit(43).cast("long")
    there = spark.range(17 * 43).select("id", F.transform(F.array("id"), lambda v: pseudonyms.feistel(v, a, b, "k", "t"))[0].alias("f"))
    back = there.select("id", "f", F.transform(F.array("f"), lambda v: pseudonyms.feistel(v, a, b, "k", "t", back=True))[0].alias("g"))
    rows = back.collect()
    assert sorted(r.f for r in rows) == list(range(17 * 43))
    assert all(r.g == r.id for r in rows)


# -- chat ---------------------------------------------------------------------------------------


def chat_rows(rows):
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        by_conv[conv].append(((turn is not None, turn), role or "", text or ""))
    out = {}
    for conv, turns in by_conv.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        spoken = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        out[conv] = (len(turns), hashlib.sha256(spoken.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_chat_reads_back_what_was_said(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    said = "</s>[INST] ok [/INST]"
    rows += [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    got = {r.conv_id: tuple(r)[1:5] for r in queries.op9_chat(spark, SF).collect()}
    assert got == chat_rows(rows)


TRICKY = ["<|turn|>", "<|end|>x<|text|>", "\\<|", "<\\|more|>", "a\\", "\\\\n", "[INST]", "[/INST]</s><s>", "<<SYS>>", "", None, "é𝄞\n\n", "$1 \\1", "[\\INST]"]


def test_chat_of_tricky_texts_and_odd_rows(spark):
    rng = random.Random(2)
    rows = [(c, t, rng.choice(["user", "assistant", "assistant", "system", "<|end|>", None]), "".join(x or "" for x in rng.choices(TRICKY, k=rng.randrange(4)))) for c in range(40) for t in range(rng.randrange(1, 9))]
    rows += [(None, 1, "user", "a"), (None, None, "assistant", None), (50, 1, "user", "tie"), (50, 1, "user", "tie"), (50, 1, "assistant", LONG)]
    rng.shuffle(rows)
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS turns", "2 AS pieces")
    found = chat.formatted(table)
    got = {r.conv_id: tuple(r)[1:5] for r in queries.chat_digest(found).collect()}
    assert got == chat_rows(rows)
    for r in found.collect():
        masked = [r.formatted[s.start : s.start + s.length] for s in r.loss_spans]
        assert len(masked) == sum(t.role == "assistant" for t in r.turns)
        assert all(m.role != n.role for m, n in zip(r.messages, r.messages[1:], strict=False))
        assert [(m.role, t) for m in r.messages for t in m.texts] == [(t.role, t.text) for t in r.turns]
        assert r.formatted.count(chat.TURN) == len(r.messages)
        for control in ("</s>", "[INST]", "[/INST]", "<s>"):
            assert control not in r.formatted
    assert chat.formatted(table.limit(0)).collect() == []


# -- tokens -------------------------------------------------------------------------------------


def plain_ids(path, texts):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


PIECES = st.text(st.sampled_from(list("ab é'sx1.\n\t\r \x00\x1c\x85　ǅ́<|end|>")) | st.characters(codec="utf-8"), max_size=25)


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES, min_size=1, max_size=6))
def test_block_encoding_is_that_of_whole_texts(texts):
    for path in (BYTE, WORD):
        encoder = tokens.encoder(path)
        ids, counts = encoder.block(pa.array(texts))
        assert [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])] == plain_ids(path, texts)


def test_token_files_match_the_library(spark):
    check_files(queries.op3_token_files(spark, SF), texts_of(spark))


def check_files(result, rows):
    rows = sorted(((i is not None, i, t or "") for i, t in rows))
    start, expected = 0, []
    for (_, doc_id, _), ids in zip(rows, plain_ids(BYTE, [t for *_, t in rows]), strict=True):
        ids = [*ids, 0]
        expected.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert Counter(tuple(r)[:4] for r in result.collect()) == Counter(expected)


def test_token_files_of_odd_rows(spark, monkeypatch):
    docs = edge_documents(spark)
    files = grammar.write_shards(docs, BYTE)
    check_files(grammar.read_shards(files), [(r.doc_id, r.text) for r in docs.collect()])
    assert grammar.read_shards(grammar.write_shards(docs.limit(0), BYTE)).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from([1, 2, 3, 2, 3, 50_000]), max_size=400), st.integers(1, 9), st.data())
def test_shards_expand_and_read_at_random(ids, repeats, data):
    ids = np.array(ids * repeats * 4, np.uint16)
    raw = grammar.Shard.pack(np.array([4], np.int64), np.array([len(ids)], np.int64), ids, 50_257)
    shard = grammar.Shard(raw)
    assert shard.ids().tolist() == ids.tolist()
    if len(ids):
        start = data.draw(st.integers(0, len(ids) - 1))
        n = data.draw(st.integers(1, len(ids) - start))
        assert shard.read(start, n).tolist() == ids[start : start + n].tolist()


def test_repeats_make_shards_small():
    ids = np.tile(np.arange(64, dtype=np.uint16), 2000)
    assert len(grammar.Shard.pack(np.array([1]), np.array([len(ids)]), ids, 50_257)) < len(ids) * 2 / 6


def places_left(symbols):
    """Of each pair, the places that do not overlap."""
    counts, at = Counter(), 0
    last = {}
    for at in range(len(symbols) - 1):
        pair = (symbols[at], symbols[at + 1])
        if pair[0] != pair[1] or last.get(pair, -2) < at - 1:
            counts[pair] += 1
            last[pair] = at
    return counts


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=1500), st.integers(1, 40))
def test_no_frequent_pair_is_left(ids, times):
    ids = np.array(ids * times, np.uint16)
    symbols, rules = grammar.compress(ids, 50_257)
    shard = grammar.Shard(grammar.Shard.pack(np.array([1]), np.array([len(ids)]), ids, 50_257))
    assert shard.ids().tolist() == ids.tolist()
    assert max(places_left(symbols.tolist()).values(), default=0) < grammar.LEAST_PLACES or 50_257 + len(rules) == 1 << 16


def test_rows_of_one_symbol_become_few_symbols():
    symbols, rules = grammar.compress(np.full(100_000, 7, np.uint16), 50_257)
    assert len(symbols) < 100 and 5 < len(rules) < 20


def test_hashes_do_not_depend_on_the_block():
    texts = ["alpha beta", "", "beta  gamma\n", "alpha beta"]
    data, offsets = hashing.text_bytes(pa.array(texts))
    words = hashing.Words(data, offsets, hashing.VISIBLE)
    h = words.hashes().tolist()
    assert words.counts.tolist() == [2, 0, 2, 2]
    assert h[0] == h[4] and h[1] == h[2] == h[5] and len(set(h)) == 3


# -- packing ------------------------------------------------------------------------------------


def check_packing(pieces, rows, window=packing.WINDOW):
    ids_of = [[*ids, 1] for ids in plain_ids(WORD, [t for _, t in rows])]
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_sequence[p.sequence_id].append((p.offset, p.length))
        by_doc[p.doc_id].append(p)
    wanted = defaultdict(Counter)
    for (doc_id, _), ids in zip(rows, ids_of, strict=True):
        wanted[doc_id][tuple(ids)] += 1
    assert set(by_doc) == set(wanted)
    for doc_id, texts in wanted.items():
        if sum(texts.values()) == 1:
            (ids,) = texts
            own = sorted(by_doc[doc_id], key=lambda p: p.start)
            assert [p.start for p in own] == np.cumsum([0, *(p.length for p in own[:-1])]).tolist()
            for p in own:
                assert p.doc_tokens == len(ids)
                assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start : p.start + p.length], "<u4").tobytes())
        assert sum(p.length for p in by_doc[doc_id]) == sum(len(ids) * n for ids, n in texts.items())
    sizes = []
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        sizes.append(at)
    assert max(sizes, default=0) <= window and sorted(sizes)[1:] == [window] * (len(sizes) - 1)
    assert sorted(by_sequence) == list(range(len(by_sequence)))


def test_packing_places_every_id_once(spark):
    check_packing(queries.op5_packing(spark, SF).collect(), texts_of(spark))


def test_packing_of_odd_rows(spark):
    docs = edge_documents(spark)
    check_packing(queries.digest(packing.packed(docs, WORD)).collect(), [(r.doc_id, r.text) for r in docs.collect()])
    assert packing.packed(docs.limit(0), WORD).collect() == []


def test_plan_uses_whole_combinations_before_it_cuts():
    histogram = np.zeros(2048, np.int64)
    histogram[[1000, 1048, 512, 1024, 64]] = [5000, 5000, 8000, 4000, 3]
    plan = packing.Plan(histogram, 2048, 10)
    whole = sum(e[3] is False for es in plan.entries for e in es)
    assert whole >= 4
    places = Counter()
    for length in np.flatnonzero(histogram).tolist():
        for rank in range(int(histogram[length])):
            for sequence, offset, n in plan.place(length, rank):
                places[sequence] += n
    assert max(places.values()) == 2048 and sum(v < 2048 for v in places.values()) <= 1
    assert sum(places.values()) == int((histogram * np.arange(2048)).sum())
    rest = sum(n for es in plan.entries for n, e in ((1, e) for e in es) if e[3])
    assert rest <= len(np.flatnonzero(histogram))


@pytest.mark.parametrize("seed", range(3))
def test_least_squares_are_near_a_known_answer(seed):
    rng = np.random.default_rng(seed)
    combos = packing.combinations(256, np.arange(1, 256))
    x = np.where(rng.random(len(combos)) < 0.2, rng.integers(1, 100, len(combos)), 0).astype(float)
    h = np.bincount(combos[combos > 0], np.broadcast_to(x[:, None], combos.shape)[combos > 0], minlength=256)
    got = packing.non_negative_least_squares(combos, h)
    again = np.bincount(combos[combos > 0], np.broadcast_to(got[:, None], combos.shape)[combos > 0], minlength=256)
    assert (got >= 0).all() and np.abs(again - h).max() < 0.02 * h.max()


# -- pipeline -----------------------------------------------------------------------------------


def test_stages_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    verdicts = {v[0]: v[-1] for v in judged([(r.doc_id, r.source, r.text) for r in rows.values()], lines.LINE_LIMIT)}
    left = {i for i in rows if verdicts[i]}
    got = corpus_pipeline.quality(spark, docs, SF)
    assert got.columns == docs.columns and {r.doc_id for r in got.collect()} == left

    prints = {i: fingerprint(rows[i].text) for i in left}
    least = smallest_reachable({i: i for i in left}, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    left = {i for i in left if least[i] == i}
    got = corpus_pipeline.near_duplicates(spark, got, SF)
    assert got.columns == docs.columns and {r.doc_id for r in got.collect()} == left

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left -= {d for d, _ in brute_leaks([(i, rows[i].text) for i in left], items, leaks.SIMILARITY)}
    got = corpus_pipeline.decontamination(spark, got, SF)
    assert got.columns == docs.columns and {r.doc_id for r in got.collect()} == left

    got = corpus_pipeline.pii(spark, got, SF)
    final = [(i, pseudonymised(rows[i].text)) for i in left]
    assert got.columns == docs.columns and sorted((r.doc_id, r.text) for r in got.collect()) == sorted(final)
    check_packing(corpus_pipeline.run(spark, SF).collect(), final)


def test_stages_take_odd_rows_and_empty_tables(spark):
    docs = edge_documents(spark)
    for some in (docs, docs.limit(0)):
        stage_input = some
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, stage_input, SF)
            out.collect()
            if name != "packing":
                assert out.columns == docs.columns
                stage_input = out
