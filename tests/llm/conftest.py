from __future__ import annotations

import pytest

#: Columns of ``documents`` plus one whose name clashes with results.
DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_tokens string"


@pytest.fixture
def docs(spark):
    """Builds a documents table from (id, text) or (id, text, lang) rows; all other columns set."""
    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, None, len(r[1]) if r[1] is not None else None, "clash") for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(3)
    return make


#: Null and empty texts, blanks, one word, ties, a repeated row, null ids and a very long text.
EDGES = [(1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, "same text here"), (6, "same text here"), (7, "twice"), (7, "twice"),
         (None, "no id"), (None, None), (8, "long text of many words " * 20_000), (9, "a" * 60_000), (10, "naïve İstanbul Σίσυφος 漢字 <|endoftext|>")]
