import pytest

from shopscope.llm.shared import shared_dir


@pytest.fixture()
def docs(spark):
    """Frame of documents from (doc_id, text) rows, with columns that clash with results."""
    shared_dir(spark)

    def make(rows, partitions=3):
        data = [(i, t, "en", "s", 0, -1, "x") for i, t in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long, n_tokens long, kind string"
        return spark.createDataFrame(data, schema).repartition(partitions)

    return make
