import pytest
from brute import made_documents, with_clashes


@pytest.fixture(scope="session")
def made():
    return made_documents()


@pytest.fixture(scope="session")
def documents(spark, made):
    frame = with_clashes(spark, made, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return frame.cache()


@pytest.fixture(scope="session")
def nothing(documents):
    return documents.limit(0)
