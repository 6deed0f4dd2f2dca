import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))


@pytest.fixture
def rng():
    return random.Random(7)


@pytest.fixture(scope="session")
def prose():
    """Texts of invented words, some of them near copies of others."""
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(4000)]
    texts = []
    for _ in range(60):
        texts.append(" ".join(rng.choice(vocabulary) for _ in range(rng.randint(30, 200))))
    for k in range(60):
        words = texts[k % 20].split()
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        texts.append(" ".join(words))
    return texts
