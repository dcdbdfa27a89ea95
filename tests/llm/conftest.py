import pytest


@pytest.fixture(scope="session")
def text_rows():
    """Texts that every operator has to live with."""
    return [None, "", " \t\n ", "one", "a b c", "é ß 漢字 😀", "x" * 50_000, "w " * 30_000, "same text twice", "same text twice"]
