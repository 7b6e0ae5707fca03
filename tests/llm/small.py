"""Small inputs that the tests of the training data operators share."""

from __future__ import annotations

SF = "/root/testdata/sf0.001"

LONG = " ".join(f"word{i % 701} zebra{i}" for i in range(30_000))


def texts_of(spark, sf: str = SF) -> list[tuple[int, str]]:
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


def edge_documents(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, and columns whose
    names the operators use themselves."""
    line = "The mit license and the apache license and the general public license of Übermut"
    para = " ".join(f"plain{i} text{i * i}" for i in range(60))
    rows = [
        (1, None, "en", None, None),
        (2, "", "en", "a", 0),
        (3, " \n\t \n", None, "a", 5),
        (4, line, "en", "a", 9),
        (5, f"{line}\n{line}\n{line.upper()}", "en", "b", 9),
        (6, LONG, "en", "b", 9),
        (7, f"{para}\n{line}", "en", "a", 1),
        (7, f"{para}\n{line}", "en", "a", 1),
        (8, f"{line}\n{para}", "en", None, 1),
        (9, f"{para} tail", "fr", None, 1),
        (None, para, None, None, None),
        (None, None, None, None, None),
        (10, "one", "en", "a", 3),
        (10, "other words under the same number", "en", "a", 3),
        (11, "a\x00b c\x1cd  e f　g <|endoftext|> </s> \r\n\x85 x́ it's", "en", "a", 3),
        (12, "#*$% & |<>" * 40, "en", "a", 3),
        (13, "# " * 300, "en", "a", 3),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clashing = ("row", "fp", "line", "words", "text_hash", "wanted_id", "_found", "pii", "part", "ids", "copy", "seed", "anchor", "bucket", "first", "n", "hash", "removed", "tail", "key")
    return docs.selectExpr("*", *(f"'x' AS {name}" for name in clashing))
