"""The operators over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import (
    chains,
    chat,
    collocations,
    copies,
    grammar,
    leaks,
    licenses,
    lines,
    packing,
    pseudonyms,
    runs,
    simhash,
    suffixes,
    tokens,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = grammar.write_shards(_table(spark, sf_dir, "documents"), tokens.tokenizer_path("byte_bpe_50k.json"), end=0)
    return grammar.read_shards(files)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.deduplicated(_table(spark, sf_dir, "documents")).drop("spans")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(packing.packed(_table(spark, sf_dir, "documents"), tokens.tokenizer_path("word_bpe_49k.json"), end=1))


def digest(pieces: DataFrame) -> DataFrame:
    """Packed pieces with a checksum in place of their ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.cleaned_report(_table(spark, sf_dir, "documents")).drop("source", "text_hash")


def op8_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymised(_table(spark, sf_dir, "documents"), pseudonym_key(spark))


#: The session setting with the key of pseudonyms, and the key of trials where it is unset.
KEY_SETTING = "spark.tillroll.pseudonymKey"
TRIAL_KEY = "tillroll"


def pseudonym_key(spark: SparkSession) -> str:
    return spark.conf.get(KEY_SETTING, TRIAL_KEY)


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    own = spark.sql("SELECT * FROM VALUES (-7L, 0L, 'user', :said), (-7L, 1L, 'assistant', :said) AS t(conv_id, turn, role, text)", args={"said": said})
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_digest(chat.formatted(rows.unionByName(own)))


def chat_digest(conversations: DataFrame) -> DataFrame:
    """What can be read back from formatted conversations."""
    turns = chat.read_turns(F.col("formatted"))
    spoken = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return conversations.withColumns({"read": turns, "loss": chat.read_loss(F.col("formatted"), F.col("loss_spans"))}).select(
        "conv_id",
        F.size("read").cast("long").alias("n_turns"),
        F.sha2(spoken, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op10_fuzzy_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chains.passages(_table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digest(runs.runs(runs.with_repeats(_table(spark, sf_dir, "documents"))))


def run_digest(found: DataFrame) -> DataFrame:
    """The number of runs of each document, its longest one, and checksums of all and of the text left."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.withColumn("longest", longest).select(
        "doc_id",
        "n_words",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"),
        F.expr("1000 * longest.length div -longest.period").alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(listed, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copies.copies(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_license_scan, op2_simhash, op3_token_files, op4_suffix_dedup, op5_packing, op6_decontamination,
        op7_quality, op8_pseudonyms, op9_chat, op10_fuzzy_passages, op11_periodic_runs, op12_collocations, op13_exact_copies,
    )
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {
    "op12_collocations": rf"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
        ), words AS (
            SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
        ), places AS (
            SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words
        ), grams AS (
            SELECT lang, w[i : i + size - 1] AS gram, count(*) AS f
            FROM places, (VALUES (1), (2), (3)) AS s(size) WHERE i + size - 1 <= len(w) GROUP BY ALL
        ), totals AS (
            SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM grams WHERE len(gram) = 1 GROUP BY lang
        ), often AS MATERIALIZED (
            SELECT lang, gram, f FROM grams WHERE f >= 10
        ), parts AS MATERIALIZED (
            SELECT lang, gram, f, k, gram[: k] AS head, gram[k + 1 :] AS tail
            FROM often, (VALUES (1), (2)) AS cut(k) WHERE k < len(gram)
        ), cuts AS (
            SELECT p.lang, p.gram, p.f AS a, k, x.f AS l, y.f AS r,
                   CAST(CAST(1000000 AS HUGEINT) * p.f * p.f // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
            FROM parts p JOIN often x ON x.lang = p.lang AND x.gram = p.head JOIN often y ON y.lang = p.lang AND y.gram = p.tail
        ), candidates AS MATERIALIZED (
            SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, k) = 1
        ), inner_pairs AS (
            SELECT lang, part AS gram, max(f) AS longer
            FROM (SELECT lang, f, unnest([gram[1:2], gram[2:3]]) AS part FROM often WHERE len(gram) = 3) GROUP BY ALL
        ), covered AS (
            SELECT c.lang, c.gram FROM candidates c JOIN inner_pairs i ON c.lang = i.lang AND c.gram = i.gram WHERE 100 * longer >= 50 * a
        ), ranked AS (
            SELECT *, array_to_string(gram, ' ') AS phrase,
                   row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(gram, ' ')) AS rank
            FROM candidates ANTI JOIN covered USING (lang, gram)
        )
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
    """,
    "op13_exact_copies": f"""
        WITH texts AS (SELECT doc_id, {_LOWER} AS normal FROM documents)
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(normal) AS text_sha256
        FROM texts WINDOW same AS (PARTITION BY normal)
    """,
}
