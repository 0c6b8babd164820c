import random
import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
#: names the operators use inside, as extra columns of their input
CLASHING = ["key", "score", "shard", "label", "places", "bits", "words", "group", "row"]


def prose(seed: int, size: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{int(rng.random() ** 2 * vocabulary)}" for _ in range(size))


@pytest.fixture(scope="session")
def awkward_rows():
    """(doc_id, text): nulls, empty and blank texts, copies, shared passages, a long text, repeated rows."""
    shared = prose(1, 60)
    rows = [(i, prose(100 + i, 20 + 7 * (i % 9))) for i in range(2, 40)]
    rows += [(50, shared), (51, shared), (52, f"{prose(2, 30)}\n\t {shared}  {prose(3, 10)}"), (53, prose(4, 12)),
             (54, prose(4, 12)), (55, prose(5, 13)), (56, prose(5, 13)), (57, None), (58, ""), (59, " \n\t "), (60, "one"),
             (61, "É x ä" * 40), (62, shared.upper()), (63, prose(6, 6000)), (64, f"{prose(7, 20)} {prose(6, 6000)}"),
             (65, ("again and again " * 50).strip()), (66, "a  b   c\r\n\x0b\x0cd <|endoftext|> e")]
    rows += [(70, shared), (70, shared), (71, "same id"), (71, "another text"), (None, shared), (None, None)]
    return rows


@pytest.fixture(scope="session")
def frame(spark):
    """A documents table of (doc_id, text) rows, with columns of clashing names if wanted."""
    def build(rows, clash=False):
        df = spark.createDataFrame(rows, "doc_id bigint, text string")
        if clash:
            for name in CLASHING:
                df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return build


def words(text):
    return WORD.findall(text or "")
