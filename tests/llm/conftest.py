import duckdb
import pytest


@pytest.fixture(scope="session")
def documents(sf):
    return duckdb.sql(f"SELECT doc_id, text, lang, source FROM '{sf}/documents.parquet'").fetchall()
