import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
os.environ["PYTHONPATH"] = os.pathsep.join([sys.path[0], os.environ.get("PYTHONPATH", "")])

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pricelens.session import local_session
    s = local_session("*", "llm-tests", {"spark.sql.shuffle.partitions": "4"})
    yield s


DOCS = "doc_id long, text string, lang string, source string, n_chars long, _text string, score double"
#: Nulls in every column, empty and blank texts, a very long one, ties, repeated rows
#: and columns whose names clash with the operators' own.
ODD = [
    (1, "the cat sat on the mat today", "en", "a", 28, "x", 1.0),
    (1, "the cat sat on the mat today", "en", "a", 28, "x", 1.0),
    (2, "THE cat sat on the mat today", "en", "a", 28, None, None),
    (3, None, None, None, None, None, None),
    (4, "", "en", None, 0, "", 0.0),
    (5, " \n\t ", "de", "b", 4, "y", 0.5),
    (None, "the cat sat on the mat today", "en", "b", 28, "z", 2.0),
    (None, None, None, None, None, None, None),
    (6, "word " * 30000 + "end", "en", "c", 150003, "q", 3.0),
    (7, "12 34 $$ %%", "de", "c", 11, "q", 3.0),
    (8, "日本語 テキスト é ß 🙂", "de", "c", 20, "q", 3.0),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
