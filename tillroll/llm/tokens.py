"""Token ids of whole columns of texts, by the tokenizers library, a block at a time.

Both public tokenizers encode a text as the encodings of its space-separated parts, one after the
other. So the distinct parts of a block are encoded, and kept for later blocks of the same worker.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tillroll.llm import hashing as H

#: Parts kept by a worker between blocks; beyond it the store starts afresh.
KEPT_PARTS = 2_000_000
BLOCK_BYTES = 16 << 20
#: Parts whose ids are looked up at once.
STEP = 1 << 18

#: White space as the tokenizers see it, and more that Python takes for it.
_SPACES = "\\t-\\r\\x1c-\\x20\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"
#: Parts that can be encoded next to others.
_PLAIN = f"^ ?[^{_SPACES}]+$"
#: A Latin word and marks after it: to both tokenizers a word by itself, then the marks.
_WORD = "^(?P<head> ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+)(?P<marks>[.,;:!?|]*)$"


def tokenizer_path(name: str) -> str:
    """Where the installed package of public tokenizers keeps a file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_names() -> tuple[np.ndarray, np.ndarray]:
    """What stands for each byte in byte-level vocabularies, as UTF-8, and whether that has two bytes:
    printable Latin-1 bytes for themselves, the others by the characters from U+0100 on. A line end
    stays, as it only separates here."""
    same = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in same]
    names = [chr(b) if b in same or b == 10 else chr(256 + others.index(b)) for b in range(256)]
    table = np.zeros((256, 2), np.uint8)
    for b, name in enumerate(names):
        table[b, : len(name.encode())] = list(name.encode())
    return table, table[:, 1] > 0


BYTE_NAMES, TWO_BYTES = _byte_names()


class Lists:
    """Lists of ids, one after the other, with their sizes."""

    def __init__(self, flat: np.ndarray, sizes: np.ndarray):
        self.flat, self.sizes = flat, sizes
        self.begins = np.cumsum(sizes) - sizes

    def take(self, index: np.ndarray) -> np.ndarray:
        out, end = np.empty(sum(int(self.sizes[index[at : at + STEP]].sum()) for at in range(0, len(index), STEP)), self.flat.dtype), 0
        for at in range(0, len(index), STEP):
            some = index[at : at + STEP]
            found = self.flat[H.ranges(self.begins[some], self.sizes[some])]
            out[end : end + len(found)] = found
            end += len(found)
        return out

    def joined(self, other: Lists) -> Lists:
        return Lists(np.concatenate((self.flat, other.flat)), np.concatenate((self.sizes, other.sizes)))


class Known:
    """Texts and their ids, kept for later blocks."""

    def __init__(self):
        self.texts = pa.array([], pa.string())
        self.ids = Lists(np.zeros(0, np.uint16), np.zeros(0, np.int64))

    def add(self, texts: pa.Array, ids: Lists) -> None:
        self.texts = pa.concat_arrays([self.texts, texts.cast(pa.string())])
        self.ids = self.ids.joined(ids)

    def places(self, texts: pa.Array) -> np.ndarray:
        """The number of each text, or -1."""
        return np.array(pc.fill_null(pc.index_in(texts.cast(pa.string()), value_set=self.texts), -1))


def _cut(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Texts cut before each space and around each line end: the first part of each text, and the parts, which
    share the bytes of the texts."""
    data, at = H.text_bytes(texts)
    line = data == 10
    begins = line | (data == 32)
    begins[1:] |= line[:-1]
    begins[at[:-1][at[:-1] < len(data)]] = True
    starts = np.flatnonzero(begins)
    wide = len(data) >= 1 << 31
    ends = np.append(starts, len(data)).astype(np.int64 if wide else np.int32)
    parts = (pa.LargeStringArray if wide else pa.StringArray).from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(data))
    return np.searchsorted(starts, at), parts


class Encoder:
    """``lossless``: byte-level parts keep the space before them; else white space only separates.

    The strings of special tokens inside a text are ordinary text.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.lossless = bool(self._ids(" "))
        #: Between parts that are encoded as one text, and the id it has there.
        self.between = "\n" if self.lossless else " \0 "
        (self.mark,) = self._ids("\n" if self.lossless else "\0")
        self.parts, self.heads = Known(), Known()
        #: By id: bytes of its piece, and whether it ends a word.
        self.sizes, self.last = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, bool)
        for piece, number in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.sizes[number], self.last[number] = len(piece), piece.endswith("</w>")
        self.words = Tokenizer.from_file(path)
        self.words.encode_special_tokens = True
        self.words.normalizer = None
        self.words.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids are kept in 16 bits")

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _of_words(self, words: pa.Array) -> Lists:
        """The ids of Latin words. Each is one pre-token, so the library gets them with their bytes
        named as in the vocabulary, and needs to cut at line ends only."""
        flat, sizes = [np.zeros(0, np.uint16)], [np.zeros(0, np.int64)]
        for at in range(0, len(words), 5000):
            some = words[at : at + 5000].to_pylist()
            joined = "\n".join(some)
            raw = np.frombuffer((joined if self.lossless else joined.lower()).encode(), np.uint8)
            named = BYTE_NAMES[raw][np.stack([np.ones(len(raw), bool), TWO_BYTES[raw]], axis=1)].tobytes().decode()
            (found,) = self.words.encode_batch_fast([named], add_special_tokens=False)
            ids = np.array(found.ids, np.uint16)
            if self.lossless:  # a word ends where its bytes are used up
                size = np.cumsum(pc.binary_length(words[at : at + 5000]).to_numpy())
                ends = np.searchsorted(np.cumsum(self.sizes[ids]), size) + 1
            else:
                ends = np.flatnonzero(self.last[ids]) + 1
            flat.append(ids)
            sizes.append(np.diff(ends, prepend=0))
        return Lists(np.concatenate(flat), np.concatenate(sizes))

    def _of_others(self, parts: pa.Array) -> Lists:
        """The ids of any parts: plain ones many at once, the others by themselves."""
        flat, sizes = [np.zeros(0, np.uint16)], [np.zeros(0, np.int64)]
        for at in range(0, len(parts), 5000):
            some = parts[at : at + 5000].to_pylist()
            ids = np.array(self._ids(self.between.join(some)), np.uint16)
            marks = np.flatnonzero(ids == self.mark)
            flat.append(np.delete(ids, marks))
            sizes.append(np.diff(np.concatenate(([-1], marks, [len(ids)]))) - 1)
        return Lists(np.concatenate(flat), np.concatenate(sizes))

    def block(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids (16 bits) of all texts, one after the other, and the number of ids of each."""
        odd = f"[{_SPACES}]{{2}}|\\x00" if self.lossless else "\\x00"
        whole = pc.match_substring_regex(texts, odd).to_numpy(zero_copy_only=False).astype(bool)
        plain = pc.if_else(pa.array(whole), pa.scalar("", texts.type), texts) if whole.any() else texts
        if self.lossless:
            offsets, parts = _cut(plain)
        else:
            parts = pc.split_pattern(pc.replace_substring(plain, "\n", " "), " ")
            offsets, parts = parts.offsets.to_numpy(), parts.flatten()
        del plain
        coded = parts.dictionary_encode()
        del parts
        number = self._numbers(coded.dictionary).astype(np.int32)[coded.indices.to_numpy(zero_copy_only=False)]
        del coded
        ids = self.parts.ids.take(number)
        ends = np.zeros(len(number) + 1, np.int64)
        np.cumsum(self.parts.ids.sizes[number], out=ends[1:])
        counts = np.diff(ends[offsets])
        return self._with_whole(texts, whole, ids, counts) if whole.any() else (ids, counts)

    def _with_whole(self, texts, whole, ids, counts):
        pieces = np.split(ids, np.cumsum(counts)[:-1])
        for i in np.flatnonzero(whole):
            pieces[i] = np.array(self._ids(texts[int(i)].as_py()), np.uint16)
        return np.concatenate(pieces), np.array([len(p) for p in pieces], np.int64)

    def _numbers(self, parts: pa.Array) -> np.ndarray:
        """The numbers of distinct parts among those known; new ones are encoded."""
        if len(self.parts.texts) > KEPT_PARTS:
            self.parts, self.heads = Known(), Known()
        number = self.parts.places(parts)
        added = np.flatnonzero(number < 0)
        if not len(added):
            return number
        new = parts.take(pa.array(added))
        found = pc.extract_regex(new, pattern=_WORD)
        word = found.is_valid()
        heads, marks = (pc.struct_field(found.filter(word), i).dictionary_encode() for i in (0, 1))
        head = self.heads.places(heads.dictionary)
        unknown = np.flatnonzero(head < 0)
        head[unknown] = len(self.heads.texts) + np.arange(len(unknown))
        fresh = heads.dictionary.take(pa.array(unknown))
        self.heads.add(fresh, self._of_words(fresh))
        head = head[heads.indices.to_numpy(zero_copy_only=False)]
        others = new.filter(pc.invert(word))
        plain = pc.match_substring_regex(others, _PLAIN) if self.lossless else pc.greater(pc.binary_length(others), 0)
        # Plain others come first, then odd ones, then words.
        kind = np.full(len(new), 2)
        kind[~word.to_numpy(zero_copy_only=False)] = ~plain.to_numpy(zero_copy_only=False)
        number[added[np.argsort(kind, kind="stable")]] = len(self.parts.texts) + np.arange(len(new))
        self.parts.add(others.filter(plain), self._of_others(others.filter(plain)))
        odd = others.filter(pc.invert(plain))
        alone = [np.array(self._ids(p), np.uint16) for p in odd.to_pylist()]
        self.parts.add(odd, Lists(np.concatenate([np.zeros(0, np.uint16), *alone]), np.array([len(x) for x in alone], np.int64)))
        # A word: the ids of its head, then those of its marks.
        tails = [np.array(self._ids(m), np.uint16) if m else np.zeros(0, np.uint16) for m in marks.dictionary.to_pylist()]
        tail = Lists(np.concatenate([np.zeros(0, np.uint16), *tails]), np.array([len(x) for x in tails], np.int64))
        mark = marks.indices.to_numpy(zero_copy_only=False)
        first, second = self.heads.ids.sizes[head], tail.sizes[mark]
        flat = np.empty(int(first.sum() + second.sum()), np.uint16)
        ends = np.cumsum(first + second)
        flat[H.ranges(ends - first - second, first)] = self.heads.ids.take(head)
        flat[H.ranges(ends - second, second)] = tail.take(mark)
        self.parts.add(new.filter(word), Lists(flat, first + second))
        return number


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker and file."""
    return Encoder(path)


def with_end(ids: np.ndarray, counts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Append ``end`` to the ids of each text."""
    out = np.full(len(ids) + len(counts), end, np.uint16)
    total = counts + 1
    own = np.ones(len(out), bool)
    own[np.cumsum(total) - 1] = False
    out[own] = ids
    return out, total
