import re
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="session")
def documents(spark):
    if not Path(SF).exists():
        pytest.skip("test tables are not here")
    return spark.read.parquet(f"{SF}/documents.parquet")


MESSY = [
    "",
    None,
    " \n\t ",
    "a",
    "word " * 60,
    "é漢😀 naïve token: abcdefgh12 " * 12,
    " ".join(f"w{i}" for i in range(120)),
    " ".join(f"w{i}" for i in range(120)) + " tail of its own",
    "x" * 70_000,
    "line one here\nline one here\n\nother " * 5,
    " ".join(f"v{i % 4000}" for i in range(30_000)),
]


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls in every column, empty and very long texts, repeated ids and rows, names that clash with the operators' own."""
    rows = []
    for i, text in enumerate(MESSY):
        rows.append((i, text, "en", f"s{i % 3}", 1, i, "k", 5, "b", 2))
        rows.append((None, text, None, None, None, None, None, None, None, None))
    rows += [(7, MESSY[7], "en", "s1", 1, 7, "k", 5, "b", 2)] * 3 + [(7, "another text under one id", "en", "s1", 1, 7, "k", 5, "b", 2)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, id long, key string, a long, b string, size int"
    )


@pytest.fixture(scope="session")
def empty(messy):
    return messy.limit(0)


@pytest.fixture(scope="session")
def split():
    return lambda text: WORD.findall(text or "")
