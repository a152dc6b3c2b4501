"""What one slice of text takes in a worker while its n-grams are counted and scored (operator 4)."""
import random
import tracemalloc

import numpy as np

from upkeep.llm import ngrams as N


def test_a_slice_of_text_takes_little_memory():
    r = random.Random(4)
    words = ["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.randrange(2, 9))) for _ in range(2000)]
    text = " ".join(r.choices(words, k=N.PIECE_BYTES // 6))[:N.PIECE_BYTES]
    tracemalloc.start()
    keys, n = N.distinct([text], 4)
    values = N._Table(keys, np.ones(len(n)))(N.grams([text], 4)[0])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert values.sum() == len(text) == n.sum()
    assert peak < 64 << 20
