import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

#: Beside the columns of documents: names that the operators use for their own.
CLASHES = ["doc", "score", "key", "keys", "n_words", "spans", "print", "id", "k1", "rank"]


def _passage(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abdeilmnorstu") for _ in range(rng.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """Documents with nulls, empty, blank and long texts, ties, copies, repeats within a text, and shared passages."""
    shared, other = _passage(1, 90), _passage(2, 70)
    rows = [
        (1, f"{_passage(10, 40)} {shared} {_passage(11, 30)}"), (2, f"{_passage(12, 25)}\n{shared}\t{_passage(13, 9)}"),
        (3, shared), (4, shared), (5, f"{shared} x"), (6, None), (7, ""), (8, "  \n\t "), (9, "one"), (10, "one two"),
        (11, "The The The " * 120), (12, f"{other} {_passage(14, 5)} {other}"), (13, other.upper()),
        (14, "línea única\n" * 40), (15, "é" * 900), (16, "日本語のテキスト " * 70), (17, _passage(15, 4000)),
        (18, f"{_passage(16, 300)} {other[:200]}"), (19, "123 456 !!! ???"), (20, f"{_passage(15, 4000)} end"),
        (None, f"{shared} {other}"), (None, None), (21, "a\x0bb\x0cc\rd  e"), (22, "so <|endoftext|> it's À 1/2 Σας"),
        (23, "| # * $ % & < > |\n" * 30), (24, " ".join(f"w{k % 7}" for k in range(200))),
    ]
    return rows + [(3, shared)]  # a repeated row


@pytest.fixture(scope="session")
def docs(spark, corpus):
    rows = [(i, t, None if k % 5 == 0 else "en", None if k % 3 else "src", None if k % 4 else 1, *["x"] * len(CLASHES))
            for k, (i, t) in enumerate(corpus)]
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    return spark.createDataFrame(rows, f"{columns}, {', '.join(f'{c} string' for c in CLASHES)}").repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.limit(0)
