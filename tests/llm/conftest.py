import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import pytest  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def frame(spark):
    """Rows of (doc_id, text[, lang[, source]]) as a documents table."""
    def make(rows):
        full = [(*r, *[None] * (4 - len(r))) for r in rows]
        return spark.createDataFrame([(*r, len(r[1] or "")) for r in full], DOCS)
    return make
