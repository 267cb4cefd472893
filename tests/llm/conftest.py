import os
import sys
from pathlib import Path

ROOT = str(Path(__file__).resolve().parents[2])
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])

import pytest  # noqa: E402


@pytest.fixture(scope="session")
def docs_table(spark, tmp_path_factory):
    """Small documents with nulls, empty, long, tied and repeated rows and an extra column, as Parquet."""
    en = "the quick brown fox jumps over the lazy dog and runs away from the big bad wolf "
    de = "der schnelle braune fuchs springt über den faulen hund und läuft vor dem wolf weg "
    rows = [(i, (en if i % 2 else de) * (1 + i % 5) + f"item {i * 7919}", "en" if i % 2 else "de", i) for i in range(60)]
    rows += [(100, None, "en", 1), (101, "", None, 2), (102, "  \n\t ", "de", 3), (103, "%%% 123 ***", None, 4)]
    rows += [(104, en * 3000, None, 5), (3, rows[3][1], "en", 3), (None, rows[4][1], None, 6), (105, None, None, 7)]
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, bits long")
    frame.coalesce(2).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, bits long")
