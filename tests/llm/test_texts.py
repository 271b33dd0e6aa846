import numpy as np
import pyarrow as pa
import pytest

from rostermart.llm import texts as t
from tests.llm import brute

TEXTS = ["Hello, World! ab", "", None, "ça-va İx 12", "hello a\tb\n\x0bC", "z" * 10, "HELLO", " ", "naïve 漢字　x"]


@pytest.mark.parametrize("limit", [1, 20, 1 << 20])
@pytest.mark.parametrize("kind, pattern", [(t.SPACED, brute.SPACED), (t.LETTERS, brute.LETTERS)])
def test_words_and_hashes(limit, kind, pattern):
    seen = {}
    for part in t.slices(pa.array(TEXTS), limit):
        found = t.find_words(part, kind)
        hashes = t.hash_words(part, found)
        for i in range(part.hi - part.lo):
            mine = t.lowered(part, found, found.first[i], found.first[i + 1])
            assert mine == brute.words(TEXTS[part.lo + i], pattern)
            for word, h in zip(mine, hashes[found.first[i]:found.first[i + 1]], strict=True):
                assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


def test_runs_stay_inside_texts():
    part, = t.slices(pa.array(["a b c", "d e", "a b c"]))
    found = t.find_words(part, t.SPACED)
    starts = t.run_starts(found, 3)
    assert starts.tolist() == [0, 5]
    runs = t.hash_runs(t.hash_words(part, found), 3)
    assert runs[0] == runs[5] and len(np.unique(runs)) == 5
