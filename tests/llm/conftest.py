import random

import duckdb
import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
#: Documents with columns whose names the operators use themselves.
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, id string, line int, removed string, "
          "component long, fingerprint string, _k1 string, n_lines int, tree string, kept boolean")


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


def messy_rows():
    """Nulls everywhere, empty, blank and long texts, copies, near copies, ids that repeat with and without another text."""
    rng = random.Random(7)
    base = [sentence(rng, 90) + "\n" + sentence(rng, 40) for _ in range(8)]
    long = "\n".join(sentence(rng, 12) for _ in range(1500)) + "\n" + "x" * 3000
    texts = [(1, base[0]), (2, base[0]), (2, base[0]), (2, base[1]), (None, base[0]), (None, None), (None, ""), (3, None), (4, ""),
             (5, " \t\n\x0b "), (6, "one"), (7, "one"), (8, "one two three"), (9, base[2] + " tail"), (10, base[2]), (11, long),
             (12, base[3].upper()), (13, base[3]), (14, "\n\n" + base[4] + "\n\n"), (15, "été 日本語 \U0001f600 " + base[5]), (16, base[5]),
             (-1, base[6]), (17, base[6].replace(" ", "  ")), (18, base[7] + "\n" + base[7]), (19, "#*$ " * 60), (20, "a a a a " * 40)]
    out = []
    for n, (i, t) in enumerate(texts):
        none = n % 5 == 0
        out.append((i, t, None if none else "en", None if n % 7 == 0 else f"s{n % 2}", None if none else 1, "id", n, None, n, "f", "k", 1, "t", True))
    return out


@pytest.fixture(scope="session")
def messy(spark):
    return spark.createDataFrame(messy_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], T._parse_datatype_string(SCHEMA))


@pytest.fixture(scope="session")
def sample():
    """(doc_id, text) of the smallest table."""
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
