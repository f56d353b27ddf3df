import duckdb
import pytest


@pytest.fixture(scope="session")
def documents(sf_dir):
    """(doc_id, text) of the smallest documents table."""
    return duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet' ORDER BY doc_id").fetchall()


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text) rows, with further columns whose names the operators use."""

    def build(rows):
        rows = [(k, text, "en", "s", 1, 2, 3, 4, 5) for k, text in rows]
        return spark.createDataFrame(
            rows, "doc_id bigint, text string, lang string, source string, n int, key int, node int, id int, label int")

    return build


@pytest.fixture(scope="session")
def odd_rows():
    """Null ids and texts, empty, blank and long texts, repeated rows."""
    return [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "a b c d e f"), (5, "a b c d e f"), (6, "a b c d e f"), (None, "a b c d e f"),
            (None, None), (7, "word " * 60_000), (8, "x" * 300_000), (9, "é ñ  ß  　 中文 <|endoftext|> <s> \x00 end ")]
