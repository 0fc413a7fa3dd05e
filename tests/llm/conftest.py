import os
import sys

import pytest
from pyspark.sql.types import StructType

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DDL = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A table of documents from texts, or from (doc_id, text) or (doc_id, text, lang)."""

    def make(*rows):
        full = []
        for i, row in enumerate(rows):
            row = row if isinstance(row, tuple) else (i, row)
            doc_id, text, lang = (*row, "en")[:3] if len(row) == 2 else row
            full.append((doc_id, text, lang, "s", len(text or "")))
        return spark.createDataFrame(full, StructType.fromDDL(DDL))

    return make
