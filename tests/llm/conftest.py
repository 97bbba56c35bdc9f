import os

import pytest
from pyspark.sql import functions as F

FOLDER = next((f for f in [os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")] if os.path.isdir(f)), None)
#: Enough labelled rows to learn from.
LARGER = next((f for f in ["/root/testdata/sf0.01", FOLDER] if f and os.path.isdir(f)), None)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, `sig` int"
#: Names that operators and stages give to columns of their own.
CLASHES = ["masked", "__row", "score", "key", "held_out", "spans", "shard", "node", "component", "component_id", "repository", "hash", "kept_row", "again", "h", "n", "best", "body", "token", "items"]


@pytest.fixture
def documents(spark):
    """Documents with two extra columns whose names the operators use themselves."""

    def make(rows):
        full = [(d, t, *(more + (None,) * 2)[:2], len(t or ""), "x", 1) for d, t, *rest in rows for more in [tuple(rest)]]
        made = spark.createDataFrame(full, SCHEMA)
        return made.withColumns({name: F.lit(k) for k, name in enumerate(CLASHES)})

    return make
