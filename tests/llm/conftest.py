import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use for columns of their own.
CLASHING = ("key", "hash", "size", "print", "copies", "row", "measures", "found", "taken", "component_id")


@pytest.fixture()
def docs_of(spark):
    """Documents from texts or (doc_id, text, source) rows, with columns whose names clash."""

    def make(rows):
        full = []
        for i, r in enumerate(rows):
            doc_id, text, source = r if isinstance(r, tuple) else (i, r, "a")
            full.append((doc_id, text, "en", source, None if text is None else len(text), *("x" for _ in CLASHING)))
        return spark.createDataFrame(full, DOCS + "".join(f", {c} string" for c in CLASHING))

    return make


@pytest.fixture()
def words():
    """A maker of deterministic prose: n words in sentences of about eight."""

    def make(n: int, seed: int = 0, vocabulary: int = 4000) -> str:
        rng = random.Random(seed)
        out = []
        for i in range(n):
            common = rng.random() < 0.35
            word = rng.choice("the of and to in is that with for by".split()) if common else f"w{rng.randrange(vocabulary)}"
            out.append(word + ("." if i % 8 == 7 else ""))
        return " ".join(out)

    return make
