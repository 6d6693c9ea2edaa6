"""The layout of the classifier's features and the memory it takes."""
import tracemalloc

import numpy as np

from quire.llm.quality import BUCKETS, RANK, STATS, Machine


def _machine():
    return Machine(0.0, np.zeros(BUCKETS + STATS), np.zeros((BUCKETS + STATS, RANK)), np.full(STATS, 0.5), np.full(STATS, 2.0))


def test_statistics_come_before_the_words_of_a_row():
    stats = np.arange(3.0 * STATS).reshape(3, STATS)
    ids, x, first = _machine().arrays(np.array([0, 0, 2]), np.array([7, 9, 4]), np.array([0.25, 0.5, 1.0]), stats)
    dense = np.clip((stats - 0.5) / 2, -5, 5) / 4
    own = list(range(STATS))
    assert ids.tolist() == [*own, 7 + STATS, 9 + STATS, *own, *own, 4 + STATS]
    assert x.tolist() == [*dense[0], 0.25, 0.5, *dense[1], *dense[2], 1.0]
    assert first.tolist() == [0, STATS + 2, 2 * STATS + 2]


def test_layout_takes_few_bytes_a_feature():
    rows, words = 500, 400
    row = np.repeat(np.arange(rows, dtype=np.int32), words)
    bucket, value = np.tile(np.arange(words, dtype=np.int32), rows), np.ones(len(row), np.float32)
    stats = np.zeros((rows, STATS))
    tracemalloc.start()
    try:
        ids, _, _ = _machine().arrays(row, bucket, value, stats)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 40 * len(ids)   # 62 when the features were sorted by row
