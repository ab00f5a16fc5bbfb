import os
import random

import pytest

SF = "/root/testdata/sf0.001"

#: Empty, null, tiny, odd white space, very long and repeated texts; astral characters; a repeated sentence.
ODD = [
    (9000, ""), (9001, None), (9002, "a"), (9003, "A b"), (9004, " \n\t"), (9005, "é😀 中文 ÉÉ x"), (9006, "a b c d e f " * 3000), (9007, "a b c d e f " * 3000),
    (9008, "Released under the MIT License.\nThen MIT license, cc  BY and the GNU General Public License"), (9009, "\x00\x1c ▁▁ <s> <|endoftext|> it's 3.5,　."), (-3, "one two three"),
]


@pytest.fixture(scope="session")
def rows(spark):
    """Rows of the smallest table, odd ones, and random ones that repeat each other."""
    draw = random.Random(4)
    found = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()] if os.path.isdir(SF) else []
    made = [(8000 + i, " ".join(draw.choice("ab") for _ in range(draw.randint(0, 90)))) for i in range(60)]
    return found + ODD + made


@pytest.fixture(scope="session")
def docs(spark, rows):
    """With an extra column named like a result's."""
    return spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, n_words string").repartition(5)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")
