import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, key string, h long, hash string"


def invented(seed: int, n: int, vocabulary: int = 400) -> list[str]:
    r = random.Random(seed)
    return ["".join(r.choice(["the", "on", "er", "ñó", "in", "ea"]) for _ in range(1 + r.randrange(vocabulary) % 3))
            + str(r.randrange(vocabulary)) for _ in range(n)]


def corpus() -> list[tuple[int | None, str | None]]:
    """Nulls, empty and blank texts, ties, copies, near copies, repeated rows, long texts."""
    a, b, c = invented(1, 300), invented(2, 120), invented(3, 60)
    near = a.copy()
    near[5] = "changed"
    far = a.copy()
    far[::9] = ["other"] * len(far[::9])
    rows = [
        (1, " ".join(a)), (2, " ".join(a)), (3, " ".join(near)), (4, " ".join(far)), (5, " ".join(b)),
        (6, " ".join(c + b[20:90])), (7, "\n".join([" ".join(c)] * 3) + "."), (8, None), (9, ""), (10, " \t\n\r\x0b\x0c"),
        (11, "one"), (12, "One"), (13, "one two three"), (14, "a a a a a a a a a a a a a a a a a a a a a a a a a"),
        (15, "x" * 700), (16, " ".join(invented(4, 9000))), (17, "ab" * 300 + " " + "ab" * 300),
        (18, " ".join(invented(4, 9000)[4000:4100] + b[:50])), (None, " ".join(b)), (None, None),
        (20, " ".join(c)), (20, " ".join(c)), (21, "no\x1cbreak here too")]
    return rows


@pytest.fixture(scope="session")
def frame(spark):
    def make(rows, sources=("s1", "s2", None)):
        full = [(i, t, "en", sources[n % len(sources)], None, "clash", "clash", 7, "clash") for n, (i, t) in enumerate(rows)]
        return spark.createDataFrame(full, SCHEMA).repartition(3)
    return make


@pytest.fixture(scope="session")
def docs(frame):
    return frame(corpus()).cache()


@pytest.fixture(scope="session")
def empty(frame):
    return frame([])
