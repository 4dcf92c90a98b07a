import pytest

ROWS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A documents table of the given texts; items are texts or (doc_id, text)."""

    def make(texts, **extra):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        kinds = ROWS + "".join(f", {name} string" for name in extra)
        rows = [(i, t, "en", None, None if t is None else len(t), *extra.values()) for i, t in rows]
        return spark.createDataFrame(rows, kinds)

    return make


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


#: Texts that each operator on documents must take: null, empty, white space, ties, long, not Latin, control characters.
ODD_TEXTS = [
    None,
    "",
    " \t\n",
    "one",
    "one",
    "a b c d e f g h i j",
    "a b c d e f g h i j",
    "a b  c d e f g h i j ",
    "你好，世界。" * 40,
    "\u0000\u0001 \U0001f600 é",
    "word " * 30000,
    "x" * 70000,
    "the same long passage that several documents share, word for word, and more than fifty bytes of it. " * 3,
    "before it: the same long passage that several documents share, word for word, and more than fifty bytes of it.",
]


@pytest.fixture
def odd(documents):
    return documents([*ODD_TEXTS, (None, "one"), (3, "one"), (77, "x")], fp="f", sha="s", rest="r", chunk="c", bucket="b", node="n")
