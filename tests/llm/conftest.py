import pytest

SF = "/root/testdata/sf0.001"

# names that operators use for columns of their own
CLASH = ("n_tokens", "fp", "key", "core", "row", "h", "score", "label", "marks", "text_id", "carry",
         "component_id", "held_out", "n", "ids")
EDGE_TEXTS = [None, "", "a", "the the the", "Same Text here, again and again.", "Same Text here, again and again.",
              " \t\n ", "é̀ 日本 \U0001F600 ﬀ", "long " * 6000, "x" * 5000, "word " * 40 + "é" * 300]


@pytest.fixture(scope="session")
def edge(spark):
    """Documents with null ids and texts, empty and long texts, repeated rows and ids,
    and columns that clash with the operators' own."""
    rows = [(k, t) for k, t in enumerate(EDGE_TEXTS)]
    rows += [(4, EDGE_TEXTS[4]), (None, "no id"), (None, None), (0, "the id of another")]
    data = [(i, t, *([7] * len(CLASH))) for i, t in rows]
    schema = "doc_id long, text string, " + ", ".join(f"{c} int" for c in CLASH)
    return spark.createDataFrame(data, schema)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


