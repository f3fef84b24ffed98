import os
import random
from pathlib import Path

import pytest

# Python workers import the package from here, wherever pytest was started.
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [str(Path(__file__).resolve().parents[2]), os.environ.get("PYTHONPATH")]))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def frame(spark):
    def make(rows, columns="doc_id long, text string"):
        return spark.createDataFrame(rows, columns)

    return make


@pytest.fixture
def prose():
    """Texts of invented words, every call another one."""
    own = random.Random(3)
    syllables = ["ba", "do", "ri", "mel", "ton", "qua", "ves", "ilo", "gar", "pe", "sun", "tra"]

    def make(count):
        return [own.choice(syllables) + own.choice(syllables) + own.choice(syllables) + own.choice(syllables) for _ in range(count)]

    return make
