import pytest


@pytest.fixture(scope="session")
def definition() -> str:
    from txscreen.llm import bpe

    return bpe.public_ranks()
