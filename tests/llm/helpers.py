"""Plain-Python versions and awkward inputs for the tests of the llm operators."""

import re

FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SPACE_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, key string, h long, score double"


def words(pattern, text):
    return pattern.findall((text or "").translate(FOLD))


def docs(spark, rows):
    """(doc_id, text, lang) rows as a table with extra columns whose names clash with internal ones."""
    return spark.createDataFrame([(i, t, g, "s", None, 7, "k", 1, 0.5) for i, t, g in rows], DOCS)


def sf_docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
