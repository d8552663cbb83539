import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, words: int, per_line: int = 12) -> str:
    """Lines of invented words that end with a full stop; another seed shares no run of words."""
    rng = random.Random(seed)
    made = ["".join(rng.choice("abdegilmnorstu") for _ in range(rng.randint(2, 8))) for _ in range(words)]
    lines = [" ".join(made[i : i + per_line]) + "." for i in range(0, words, per_line)]
    return "\n".join(lines)


def edited(text: str, seed: int, changes: int) -> str:
    """The text with some words replaced."""
    rng = random.Random(seed)
    words = text.split(" ")
    for i in rng.sample(range(len(words)), changes):
        words[i] = f"new{seed}x{i}"
    return " ".join(words)


def corpus() -> list[tuple]:
    """Copies, near copies, repeated rows, nulls in any column, empty and very long texts, odd characters."""
    first, second, long = prose(1, 200), prose(2, 120), prose(3, 20_000)
    texts = [
        (1, first), (2, first), (3, edited(first, 5, 3)), (4, edited(first, 6, 40)), (5, second), (5, second),
        (6, long), (7, edited(long, 8, 5)), (8, None), (9, ""), (10, "   \n\t\n"), (None, prose(4, 50)), (None, first),
        (11, "one two three"), (12, "one two three"), (13, "***\n###\n***"), (14, "x" * 9000), (15, "Σας É́ ½ 😀‍😀"),
        (16, "home | news | mail\n" + prose(9, 60) + "\nAll rights reserved."), (17, "a b c d e " * 30),
        (18, "Released under the MIT License.\n" + prose(10, 40)), (19, "<|endoftext|>it's we'll\x1cgo ~1 <|end|>"),
    ]
    rows = [(i, t, "la" if n % 2 else "lb", ["s1", "s2", None][n % 3], None if t is None else len(t))
            for n, (i, t) in enumerate(texts)]
    rows.append((20, prose(11, 30), None, None, None))
    return rows


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
