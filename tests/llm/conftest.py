import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def tables(spark, tmp_path):
    """Writes tables of a folder that queries read: tables(documents=(rows, schema), ...) -> folder."""

    def write(**frames):
        for name, (rows, schema) in frames.items():
            spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


@pytest.fixture
def documents(tables):
    """A folder with documents of these (doc_id, text, source), or (doc_id, text)."""

    def write(rows):
        full = [(i, t, "en", s[0] if s else "src", None if t is None else len(t)) for i, t, *s in rows]
        return tables(documents=(full, DOCS))

    return write


@pytest.fixture
def folder(tmp_path):
    return f"file://{tmp_path}/work"
