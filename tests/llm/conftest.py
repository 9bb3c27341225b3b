import random

import pytest


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with NULLs, empty and long texts, repeated rows, ties and a column that clashes with work names."""
    rng = random.Random(4)
    words = ["alpha", "Beta", "gamma", "delta", "epsilon", "zeta", "café", "eta9", "theta", "iota,", "kappa."]
    base = " ".join(rng.choices(words, k=120))
    rows = [(1, base), (2, base), (3, base + " omega"), (3, base + " omega"), (4, None), (5, ""), (6, " \n \t "),
            (7, "x"), (8, "<|endoftext|> two  spaces\n\nand  lines "), (9, "a" * 5000), (10, "\n".join(["same line"] * 6)),
            (11, "one\ntwo\nthree\nfour"), (12, "zero\none\ntwo\nthree\nfive"), (None, "one\ntwo\nthree"), (None, None),
            (13, " ".join(rng.choices(words, k=30_000))), (14, "漢字 仮名 " * 40), (15, "漢字 仮名 " * 40 + "終")]
    return spark.createDataFrame([(i, t, "key", 7, 1.5, "spans", 0) for i, t in rows],
                                 "doc_id long, text string, key string, words int, score double, spans string, rows int")


@pytest.fixture(scope="session")
def no_documents(awkward):
    return awkward.limit(0)
