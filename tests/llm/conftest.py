import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SMALL = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.001")

ODD_TEXTS = [
    None, "", " ", "\n", "a", "a  b ", "x\n  foo", "\x1c a\x1d b", "hi <|endoftext|>there", "  <|endoftext|> ",
    "don't we'RE they'll", "é é 　 x y\u0085z", "a" * 500, "日本語テキスト 🙂🙂", "İstanbul ΣΑΣ ǅ ﬁ",
    "-" * 300, "12 345 ²", "word " * 5000, "tie tie", "tie tie",
]


@pytest.fixture
def odd(spark):
    """Documents with nulls, odd and long texts, repeated rows and columns of clashing names."""
    rows = [(i, t, None, "s", 0, "x") for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[-1], (None, "no id", "en", "s", 0, "x")]
    columns = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_tokens string"
    return spark.createDataFrame(rows, columns)


@pytest.fixture
def no_documents(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")


@pytest.fixture
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")
