from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from meterline.llm.queries import importable  # noqa: E402

# Names that operators use inside, as further columns of the input.
CLASHES = "digest salt fp key row_id body size fraction bucket block shard spans score y seg kept start base root id turn row doc copy copies node mix_id mix_copies mix_rows mix_each mix_turn gone".split()


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    importable(spark)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text[, source]), with clashing columns that hold other things."""

    def make(*rows: tuple):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s1", None) + ("x",) * len(CLASHES) for r in rows]
        ddl = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES)
        return spark.createDataFrame(full, ddl)

    return make
