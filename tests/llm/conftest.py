"""Odd documents that every operator must take: nulls, empty and very long texts, repeated rows, clashing columns."""

import pytest

WORDS = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta", "iota", "kappa", "lambda", "mu", "nu"]


def prose(number: int, words: int = 40) -> str:
    return " ".join(WORDS[(number * 7 + i * (1 + number % 5) + i * i % (3 + number % 7)) % len(WORDS)] + str(number % 3) * (i % 4 == 0)
                    for i in range(words))


ROWS = [
    (1, "The quick brown fox jumps over the lazy dog. It's 12 o'clock!"),
    (2, "The quick brown fox jumps over the lazy dog. It's 12 o'clock!"),
    (3, "the  QUICK brown\tfox jumps over the lazy\ndog. it's 12 o'clock!"),
    (3, "the  QUICK brown\tfox jumps over the lazy\ndog. it's 12 o'clock!"),  # a repeated row
    (4, ""),
    (5, None),
    (6, "   \n\t "),
    (None, "a text without id"),
    (None, None),
    (7, "x"),
    (8, "<|endoftext|>inside <|startoftext|> <|endoftext|> and \x1c odd \x85 white\xa0space  of é ́ İ ΣΑΣ 日本語 ½²"),
    (9, "a" * 5000 + " " + "ab" * 2000 + " " + "=" * 3000),
    (10, prose(3, 6000)),
    (11, "12345 !!! ... ###"),
    *((100 + i, prose(i)) for i in range(30)),
    *((200 + i, prose(1)) for i in range(30)),  # copies
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(
        [(i, t, "x", "row", 1, 2, 3) for i, t in ROWS],
        "doc_id long, text string, row string, key string, fp int, n_tokens int, component_id int").repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, quality int")
