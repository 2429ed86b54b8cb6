import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """Documents of (id, text) or (id, text, source) tuples, with extra columns that clash."""

    def build(*rows):
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", 1, 7, "k", 3) for r in rows]
        return spark.createDataFrame(
            full, DOCS + ", `size` int, `key` string, `fp` int"
        )

    return build
