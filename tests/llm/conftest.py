import random

import pytest


@pytest.fixture(scope="session")
def prose():
    """A function that makes a text of invented words, the same for the same seed."""

    def make(seed, words=60, lines=4):
        rng = random.Random(seed)
        vocabulary = ["".join(rng.choices("abcdefghiklmnoprst", k=rng.randint(3, 9))) for _ in range(words)]
        out = [vocabulary[i:i + words // lines] for i in range(0, words, words // lines)]
        return "\n".join(" ".join(line) for line in out)

    return make
