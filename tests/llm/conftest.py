import pytest


@pytest.fixture(scope="session")
def odd_texts():
    """Texts at the edges: null, empty, blank, one word, repeats, ties, no letters, long."""
    return [
        None, "", " \t\n", "one", "Two words", "x" * 3000, "é" * 400, "a b c d e " * 400,
        "same line here\nsame line here\n\nsame line here", "same line here\nsame line here\n\nsame line here",
        "### $$$ %%% |||", "MiXeD Case Words Are Lower Cased Here, twelve words in all now",
        "mixed case words are lower cased here, twelve words in all now",
        "tab\tnew\nline\rreturn\x0bvertical\x0cform  no-break wide", "\x00nul\x1f unit",
        "it's <|endoftext|> we'll   see\n\n  spaces ", "naïve Ångström 12 345 ½ ² 中文 文字 🙂 end", "퟿ edge ",
    ]


@pytest.fixture(scope="session")
def odd_documents(spark, odd_texts):
    """The odd texts with ids, repeated rows, a null id and clashing extra columns."""
    rows = [(i, t) for i, t in enumerate(odd_texts)]
    rows += [(3, "one"), (None, "a document without an id, of twelve words or a few more than that")]
    rows = [(i, t, 1.5, True, None, "x", 7, 8) for i, t in rows]
    return spark.createDataFrame(
        rows, "doc_id long, text string, n_words double, kept boolean, lang string, hits string, length int, digest int"
    )


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string")
