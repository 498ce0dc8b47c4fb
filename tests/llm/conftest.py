from __future__ import annotations

import pytest

from earshot.llm.common import prepare

LONG = " ".join(f"w{n % 977}" for n in range(30_000))
PASSAGE = " ".join(f"shared{n}" for n in range(60))

TEXTS = [
    None, "", "   \n\t ", "one", "two words", "Two  Words", f"before {PASSAGE} after", PASSAGE,
    f"other {PASSAGE}\nand more", PASSAGE.replace("shared59", "changed"), LONG, LONG + " end",
    "the same text here", "the same text here", "a " * 40 + "b", "a " * 50, "é ß ñ\x0bx\x0cy",
    "word.\nNext, word", "nbsp\u00a0stays\u00a0one word", "emoji \U0001f600 and \x00 nul",
    "<|endoftext|> is text too", "Don't I'll they're",
]


@pytest.fixture(scope="session")
def docs(spark):
    """Texts of all kinds, with extra columns named like the operators' own."""
    rows = [
        (n, text, "en", "src", len(text or ""), "x", n, "y", [n])
        for n, text in enumerate(TEXTS)
    ]
    prepare(spark)
    return spark.createDataFrame(
        rows,
        "doc_id long, text string, lang string, source string, n_chars long, "
        "row string, _id long, text_key string, cuts array<int>",
    ).repartition(3)


@pytest.fixture(scope="session")
def pairs():
    return list(enumerate(TEXTS))


@pytest.fixture
def collected():
    """Rows of a frame as a sorted list of tuples."""
    return lambda df, *columns: sorted(map(tuple, df.select(*columns).collect()), key=repr)
