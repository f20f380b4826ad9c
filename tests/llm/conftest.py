from __future__ import annotations

import pytest

from llm_texts import sentence

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# names that operators use for their own columns
CLASHING = (
    "kept bits n_words base_failed spans held of_key sampled probability topic n_tokens fp rep u v component_id"
    " fingerprint text_key ranges numbers id low high band_lang of_id first_id cell_0 n_removed number bucket row"
).split()


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source)."""

    def make(rows, clashing=False):
        full = [(*r, *("en", "a")[len(r) - 2 :], None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        if clashing:
            from pyspark.sql import functions as F

            df = df.select("*", *[F.lit(f"extra {c}").alias(c) for c in CLASHING])
        return df

    return make


@pytest.fixture(scope="session")
def nasty():
    """Nulls, empty and white texts, repeated rows, ties, a long text, a null language and a null id."""
    long = " ".join(sentence(i, 50) for i in range(400))
    return [
        (1, None, None, None), (2, "", "en", "a"), (3, " \t\n ", "en", "a"), (4, "one", "en", "b"),
        (5, sentence(5, 60), "en", "a"), (5, sentence(5, 60), "en", "a"), (6, sentence(5, 60), "de", "c"),
        (7, long, "en", "a"), (8, sentence(8, 30) + " " + sentence(5, 60), None, "a"), (None, sentence(9, 40), "en", None),
        (None, sentence(5, 60), "en", "a"), (10, "x" * 300_000, "en", "a"),
    ]
