import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))



DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, key string, block long, group string"


def make_docs(spark, texts, ids=None, langs=None, sources=None):
    """A documents table with extra columns whose names operators use inside."""
    rows = [(ids[i] if ids else i, t, langs[i] if langs else "en", sources[i] if sources else "s", 0 if t is None else len(t), "x", "k", 7, "g")
            for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


ODD = [None, "", "   \t\n", "word", "a b", "a b", "x" * 5000, ("lorem ipsum dolor sit amet " * 3000), "Ünïcödé — “quotes” 中文字符没有空格 emoji 😀 é",
       "<|endoftext|> <|STARTOFTEXT|> don't I'LL 3.14 1,000 ΑΣ Σ", "a\x0bb\x0cc\rd e f"]


@pytest.fixture
def docs_of(spark):
    return lambda texts, **k: make_docs(spark, texts, **k)


@pytest.fixture
def odd():
    return list(ODD)
