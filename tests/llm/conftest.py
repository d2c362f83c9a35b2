import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table with clashing extra columns from (doc_id, text) pairs, over several partitions."""
    def make(rows, parts=3):
        rows = [(i, t, "en", "s", None, 1, "x", 2) for i, t in rows]
        return spark.createDataFrame(
            rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, part int, ids string, start int").repartition(parts)

    return make
