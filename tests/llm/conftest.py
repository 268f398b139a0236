"""Texts that try every operator: nulls, blanks, very long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

import random

import pytest


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ed"]) for _ in range(n))


WORDS = ["alpha", "beta", "Gamma", "delta", "épsilon", "zeta", "eta", "theta", "iota", "kappa", "lambda", "mu", "nu", "xi", "omicron", "pi", "rho", "sigma", "tau", "upsilon"]


def texts() -> list[tuple]:
    rng = random.Random(5)
    base = [sentence(rng, rng.choice([3, 30, 80, 200])) for _ in range(40)]
    shared = sentence(rng, 70)
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, base[i % 7]) for i in range(20)]  # copies
    rows += [(200 + i, base[3 * i % 40] + " " + shared + " " + sentence(rng, 20)) for i in range(12)]  # a shared passage
    for i in range(20):  # near copies
        words = base[i].split()
        words[len(words) // 2] = "changed"
        rows.append((300 + i, " ".join(words)))
    rows += [(400, None), (401, ""), (402, " \t\n "), (403, "one"), (404, "One"), (405, "a b c d"), (406, "word " * 20000), (407, "x" * 300000), (408, "日本語 テキスト 😀 " * 30), (409, "a\x0bb\x0cc d e  f\n\n g"), (None, base[0]), (None, None)]
    rows += [rows[3], rows[3], (410, "<|endoftext|> it's  3 spaces   here\n")]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def docs(spark):
    sources = ["b", "a", None, "c", "a", "a", "a"]
    rows = [(d, t, "en", sources[i % 7], 1.5, "extra", i) for i, (d, t) in enumerate(texts())]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, size double, seed string, n_words long").cache()


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)


@pytest.fixture
def scratch(spark):
    from timeloom.llm.runtime import Scratch

    return Scratch(spark, "test")
