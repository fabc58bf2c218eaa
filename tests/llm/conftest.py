import pytest

#: Texts that every operator has to take: none, empty, blanks, ties, copies, other scripts, odd spaces, a long one.
ODD_TEXTS = [
    None, "", " \n\t ", "x", "x", "The cat, the hat.\nThe cat, the hat.\n", "ünïcode Ⅷ ² 　 wide\xa0space",
    "emoji 🙂🙂 and \x1c control", "<|endoftext|> in a text", "A" * 5000, "word " * 3000,
    "a b c d e f g h i j k l m n o p", "1234 5678 !!! ???", "a\r\nb\r\n\r\nc", "it's we'll they've DON'T",
]


@pytest.fixture
def odd(spark):
    """Rows with every odd text, a null key, a repeated row, and columns that clash with results."""
    rows = [(i, text, "en", f"src{i}", 7, "mine") for i, text in enumerate(ODD_TEXTS)]
    rows += [(None, "no key here", None, None, None, None), (3, "x", "en", "src3", 7, "mine")]
    schema = "doc_id long, text string, lang string, source string, n_tokens long, `a b` string"
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def none(odd):
    return odd.limit(0)
