import re

import pytest

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SMALL = "/root/testdata/sf0.001"


def words(text, pattern=r"[^\x20\x09-\x0D]+"):
    return re.findall(pattern, (text or "").translate(AZ))


@pytest.fixture(scope="session")
def docs(spark):
    """make(rows): documents with two columns whose names clash with internal ones."""
    def make(rows):
        rows = [(i, t, "en", "s0", len(t or ""), "x", "y") for i, t in rows]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n string, tokens string")
    return make
