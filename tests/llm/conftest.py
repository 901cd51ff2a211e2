import pytest

from pressroom.llm.common import prepare


@pytest.fixture(scope="session")
def session(spark):
    return prepare(spark)


@pytest.fixture
def documents(session):
    """A maker of small document tables with clashing extra columns."""

    def make(rows):
        spec = "doc_id long, text string, lang string, source string, id long, key string, label int, size long"
        full = [(i, t, "en", s, 1, "x", 2, 3) for i, t, s in rows]
        return session.createDataFrame(full, spec)

    return make
