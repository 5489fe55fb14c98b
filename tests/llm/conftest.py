import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from llm_texts import prose  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, chunk string, k_id string, `row` int, n_words int, text_ int, key_id int"


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text, source), beside columns whose names the operators use themselves."""
    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), "c", "k", 1, 2, 3, 4) for r in rows]
        return spark.createDataFrame(full, SCHEMA)
    return make


@pytest.fixture
def odd(documents):
    """Nulls, empty and very long texts, ties and repeated rows."""
    long = "\n".join(prose(s, 400) for s in range(40))
    same = prose(1)
    rows = [(None, None), (None, same), (1, ""), (2, None, None), (3, same), (3, same), (4, same, None), (5, "one two"), (6, long), (6, prose(7)), (7, " \n\t "), (8, "x" * 30_000), (9, prose(9) + " " + prose(9))]
    return documents(rows), rows
