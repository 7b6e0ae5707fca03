"""Quality rules: per-document counts, and lines that too many documents of a host share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm import hashing as H
from tillroll.llm.columns import free_name
from tillroll.llm.store import stored

#: A line is removed where more than this many different documents of its host hold it.
LINE_LIMIT = 100
#: A document is depleted if less than this part of its words is left.
LEAST_LEFT = 0.5
#: Stands for a null doc_id.
NULL_ID = -(1 << 63)
#: Fixed values of the base rules.
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

SYMBOLS = H.byte_set(lambda b: chr(b) in "#*$%&|<>")
NEWLINE = H.byte_set(lambda b: b != 0x0A)

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "lines array<struct<line: long, words: long>>"
)


def repeated(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which entries equal an earlier entry of the same document, and which equal any other one."""
    order = np.lexsort((np.arange(len(keys)), keys, docs))
    same = (keys[order][1:] == keys[order][:-1]) & (docs[order][1:] == docs[order][:-1])
    later = np.zeros(len(keys), bool)
    later[order[1:]] = same
    any_ = later.copy()
    any_[order[:-1]] |= same
    return later, any_


def normal_lines(data: np.ndarray, offsets: np.ndarray, first_word: np.ndarray, line_words: np.ndarray) -> np.ndarray:
    """The hash of each normalised line: its words in lower case, one space between."""
    if not len(first_word):
        return np.zeros(0, np.uint64)
    joined, starts, ends = H.Words(H.LOWER[data], offsets, H.VISIBLE).joined()
    return H.Rolling(joined).between(starts[first_word], ends[first_word + line_words - 1])


def measure_block(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray | pa.Array]:
    n = len(offsets) - 1
    words = H.Words(data, offsets, H.VISIBLE)
    rolling = H.Rolling(data)
    hashes = words.hashes(rolling)

    def per_doc(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return sums[offsets[1:]] - sums[offsets[:-1]]

    first_bytes = (data & 0xC0) != 0x80
    grams = H.gram_hashes(hashes, 3)
    doc = words.doc
    inside = doc[: len(grams)] == doc[2:] if len(grams) else np.zeros(0, bool)
    at = np.flatnonzero(inside)
    _, twice = repeated(grams[at], doc[at])
    covered = np.zeros(len(doc), bool)
    for k in range(3):
        covered[at[twice] + k] = True

    lines = H.Words(data, offsets, NEWLINE)
    first_word = np.searchsorted(words.starts, lines.starts)
    line_words = np.searchsorted(words.starts, lines.ends) - first_word
    full = np.flatnonzero(line_words)
    raw = rolling.between(lines.starts[full], lines.ends[full])
    later, _ = repeated(raw, lines.doc[full])

    own = lines.doc[full]
    normal = normal_lines(data, offsets, first_word[full], line_words[full])
    per_line = np.bincount(own, minlength=n)
    structs = pa.StructArray.from_arrays(
        [pa.array(normal.view(np.int64)), pa.array(line_words[full].astype(np.int64))], ["line", "words"]
    )
    ends_of = np.concatenate(([0], np.cumsum(per_line))).astype(np.int32)
    return {
        "n_words": words.counts.astype(np.int64),
        "word_chars": per_doc(first_bytes & words.inside),
        "n_symbols": per_doc(SYMBOLS[data]),
        "n_dup_lines": np.bincount(own[later], minlength=n).astype(np.int64),
        "n_repeat_words": np.bincount(doc[covered], minlength=n).astype(np.int64),
        "lines": pa.ListArray.from_arrays(pa.array(ends_of), structs),
    }


def measures(docs: DataFrame, keys: str) -> DataFrame:
    """The columns ``keys`` (a DDL list; the text is not one of them), the hash of the text and MEASURES of
    each row."""
    names = [*(part.split()[0] for part in keys.split(", ")), "text_hash"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in H.blocks(batches):
            found = measure_block(*H.text_bytes(batch.column("text")))
            columns = [batch.column(x) for x in names] + [pa.array(x) if isinstance(x, np.ndarray) else x for x in found.values()]
            yield pa.RecordBatch.from_arrays(columns, [*names, *found])

    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    own = (F.col(part.split()[0]).cast(part.split()[1]) for part in keys.split(", "))
    return docs.select(*own, _text_hash("text").alias("text_hash"), text).mapInArrow(H.trimmed(run), f"{keys}, text_hash long, {MEASURES}")


def _text_hash(text: str) -> Column:
    """Tells rows apart that share a doc_id; of the text as it is, null as empty."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def _judged(rows: DataFrame, line_limit: int, least_left: float) -> tuple[DataFrame, DataFrame]:
    """The report on the stored measures ``rows``, and the lines to remove from each text: source, id,
    text_hash, array ``gone``."""
    key = F.coalesce("doc_id", F.lit(NULL_ID))
    lines = rows.select("source", "text_hash", key.alias("id"), F.explode(F.array_distinct("lines.line")).alias("line"))
    # One row per host, line and text first, so a line of many documents is counted by many tasks.
    texts = lines.groupBy("source", "line", "text_hash").agg(F.min("id").alias("id"))
    frequent = (
        texts.groupBy("source", "line").agg(F.count("*").alias("texts"), F.min("id").alias("holder")).where(F.col("texts") > line_limit)
    ).select(F.col("source").alias("host"), F.col("line").alias("bad"), "holder")
    held = rows.select("source", key.alias("id"), "text_hash", F.explode("lines").alias("held")).select(
        "source", "id", "text_hash", F.col("held.line").alias("line"), F.col("held.words").alias("words")
    )
    # The text hash keeps rows apart that share a doc_id but not a text; equal rows become one here.
    held = held.groupBy("source", "id", "text_hash", "line").agg(F.max("words").alias("words"), F.count("*").alias("times"))
    copies = rows.groupBy(F.col("source"), key.alias("id"), F.col("text_hash")).agg(F.count("*").alias("copies"))
    # Stored, as both the counts and the texts are made from them.
    bad = stored(
        held.join(frequent, F.col("source").eqNullSafe(F.col("host")) & (F.col("line") == F.col("bad")) & (F.col("id") != F.col("holder")))
        .select("source", "id", "text_hash", "line", "words", "times")
    )
    gone = bad.groupBy("source", "id", "text_hash").agg(F.collect_set("line").alias("gone"))
    removed = bad.groupBy("source", "id", "text_hash").agg(F.sum(F.col("words") * F.col("times")).alias("removed"))
    per_text = copies.join(removed.withColumnsRenamed({"source": "s2", "id": "i2", "text_hash": "t2"}), F.col("source").eqNullSafe(F.col("s2")) & (F.col("id") == F.col("i2")) & (F.col("text_hash") == F.col("t2"))).select(
        "s2", "i2", "t2", (F.col("removed") / F.col("copies")).cast("long").alias("n_removed_words")
    )
    judged = rows.join(per_text, F.col("source").eqNullSafe(F.col("s2")) & (key == F.col("i2")) & (F.col("text_hash") == F.col("t2")), "left")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    lost = F.coalesce("n_removed_words", F.lit(0).cast("long"))
    depleted = (F.col("n_words") - lost) < least_left * F.col("n_words")
    report = judged.select(
        "doc_id", "source", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        lost.alias("n_removed_words"), failed.alias("base_failed"), (~failed & ~depleted).alias("kept"),
    )
    return report, gone


def _without(lines: list[list[int] | None], texts: pa.Array) -> pa.Array:
    """The texts without the lines whose hashes are listed for them."""
    if not any(lines):
        return texts
    data, offsets = H.text_bytes(texts)
    words = H.Words(data, offsets, H.VISIBLE)
    spans = H.Words(data, offsets, NEWLINE)
    first_word = np.searchsorted(words.starts, spans.starts)
    line_words = np.searchsorted(words.starts, spans.ends) - first_word
    full = np.flatnonzero(line_words)
    normal = normal_lines(data, offsets, first_word[full], line_words[full]).view(np.int64)
    cuts = np.searchsorted(spans.doc[full], np.arange(len(lines) + 1))
    out = texts.to_pylist()
    for i, bad in enumerate(lines):
        if bad:
            own = slice(cuts[i], cuts[i + 1])
            removed = set((spans.starts[full[own]][np.isin(normal[own], bad)] - offsets[i]).tolist())
            kept, at = [], 0
            for line in data[offsets[i] : offsets[i + 1]].tobytes().split(b"\n"):
                if at not in removed:
                    kept.append(line)
                at += len(line) + 1
            out[i] = b"\n".join(kept).decode()
    return pa.array(out, texts.type)


def _rewritten(docs: DataFrame, per_text: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` joined with ``per_text`` (source, id, text_hash, gone, any others), its texts without the
    lines of ``gone``; and the names given to what is added."""
    names = {c: free_name(docs, f"{c}_of_lines") for c in (*per_text.columns, "null")}
    text = next(c for c in docs.columns if c.lower() == "text")
    right = per_text.withColumnsRenamed({c: names[c] for c in per_text.columns})
    same = (
        F.col("source").eqNullSafe(F.col(names["source"]))
        & (F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)) == F.col(names["id"]))
        & (_text_hash(text) == F.col(names["text_hash"]))
    )
    others = [names[c] for c in per_text.columns if c not in ("source", "id", "gone")]
    # A null text is told by its flag, since blocks are cut by their bytes.
    joined = docs.join(right, same).select(
        *(F.coalesce(F.col(c), F.lit("")).alias("text") if c == text else F.col(c) for c in docs.columns),
        *others, names["gone"], F.col(text).isNull().alias(names["null"]),
    )
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in joined.schema if f.name not in (names["gone"], names["null"])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in H.blocks(batches):
            texts = _without(batch.column(names["gone"]).to_pylist(), batch.column("text"))
            null = batch.column(names["null"])
            columns = {c: batch.column(c) for c in schema.names}
            if null.true_count:
                texts = pa.array([None if n else t for n, t in zip(null.to_pylist(), texts.to_pylist(), strict=True)], texts.type)
            columns["text"] = texts
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return joined.mapInArrow(H.trimmed(run), schema).withColumnsRenamed({"text": text}), names


def quality_report(docs: DataFrame, line_limit: int = LINE_LIMIT, least_left: float = LEAST_LEFT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, source, text): the measures, ``n_removed_words``,
    ``base_failed`` and ``kept``.

    A line counts once for each different text of its host (``source``; null is a host of its own),
    so exact copies count once: finding copies is another operator's work. A line in more than
    ``line_limit`` texts of a host is removed from all documents there but the one with the smallest
    doc_id that holds it. A document is rejected if the base rules fail or if less than ``least_left``
    of its words are left. Null texts have no words and fail; a null doc_id counts as the smallest;
    repeated rows are judged alike; an empty table gives an empty result.
    """
    return _judged(stored(measures(docs, "doc_id long, source string")), line_limit, least_left)[0]


def _per_text(report: DataFrame, gone: DataFrame, *more: Column) -> DataFrame:
    """One row per source, id and text of the report: the lines ``gone`` and the aggregates ``more``."""
    id_ = F.coalesce("doc_id", F.lit(NULL_ID)).alias("id")
    per = report.groupBy("source", id_, "text_hash").agg(F.max("kept").alias("kept"), *more)
    gone = gone.withColumnsRenamed({"source": "s2", "id": "i2", "text_hash": "t2"})
    same = F.col("source").eqNullSafe(F.col("s2")) & (F.col("id") == F.col("i2")) & (F.col("text_hash") == F.col("t2"))
    return per.join(gone, same, "left").drop("s2", "i2", "t2")


def cleaned_report(docs: DataFrame, line_limit: int = LINE_LIMIT, least_left: float = LEAST_LEFT) -> DataFrame:
    """``quality_report`` with one more column, ``text``: the text without the removed lines, for kept
    and rejected rows alike. The other lines, blank ones too, stay as they are; a null text stays null.

    Rows find their report by source, doc_id and text, so any number of rows may share a doc_id.
    """
    report, gone = _judged(stored(measures(docs, "doc_id long, source string")), line_limit, least_left)
    found = [c for c in report.columns if c not in ("doc_id", "source", "text_hash")]
    per_text = _per_text(report, gone, *(F.first(c).alias(f"own_{c}") for c in found)).drop("kept")
    texts, names = _rewritten(docs.select("doc_id", "source", "text"), per_text)
    own = {c: F.col(names[f"own_{c}"]).alias(c) for c in found} | {"text_hash": F.col(names["text_hash"]).alias("text_hash")}
    return texts.select(F.col("doc_id").cast("long"), "source", *(own[c] for c in report.columns if c in own), "text")


def keep_good(docs: DataFrame, line_limit: int = LINE_LIMIT, least_left: float = LEAST_LEFT) -> DataFrame:
    """The rows of ``docs`` that the rules keep, without the lines that they remove. Of rows with one
    doc_id all stay if one of them is good."""
    report, gone = _judged(stored(measures(docs, "doc_id long, source string")), line_limit, least_left)
    per_text = _per_text(report, gone).drop("kept")
    good = report.where("kept").select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("id")).distinct()
    texts, _ = _rewritten(docs, per_text.join(good, "id", "left_semi"))
    return texts.select(docs.columns)
