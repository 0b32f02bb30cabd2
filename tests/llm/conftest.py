import pytest

DDL = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """documents rows from (doc_id, text) or (doc_id, text, source) tuples, with a clashing extra column."""
    def make(rows, parts=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1]) if r[1] is not None else None, 7) for r in rows]
        return spark.createDataFrame(full, DDL + ", n int").repartition(parts)
    return make
