import pytest

from tillscope.llm.common import package_on_workers


@pytest.fixture(autouse=True)
def _workers(spark):
    package_on_workers(spark)


@pytest.fixture
def docs_of(spark):
    """(doc_id, text) pairs, or (doc_id, text, lang, source), with columns whose names operators use themselves."""
    def make(rows):
        rows = [(*r, *(None,) * (4 - len(r))) for r in rows]
        return spark.createDataFrame(
            [(*r, "x", -1, 0.5) for r in rows],
            "doc_id long, text string, lang string, source string, token string, size long, score double")
    return make
