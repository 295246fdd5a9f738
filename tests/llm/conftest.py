import pytest

from mercato.llm.common import ship_package


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs, with columns whose names clash with what operators make."""
    def make(rows):
        return spark.createDataFrame(
            [(i, t, "src", "en", None if t is None else len(t), "x", "y") for i, t in rows],
            "doc_id long, text string, source string, lang string, n_chars long, fingerprint string, pii string")

    return make
