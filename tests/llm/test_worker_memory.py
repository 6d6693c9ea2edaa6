"""What a Python worker holds beside a batch."""

import tracemalloc

import pyarrow as pa
import pytest

from quire.llm import quality, setsketch, suffixes, windows
from corpus_pipeline import PASSAGE

TEXTS = [" ".join(f"w{(i * 7919 + k * k) % 50000}" for k in range(800)) for i in range(600)]   # 3.7 MB
BATCH = pa.RecordBatch.from_arrays([pa.array(range(600)), pa.array(range(600)), pa.array(TEXTS), pa.array([1] * 600), pa.array([len(t) for t in TEXTS])],
                                   names=["doc_id", "thash", "text", "quality", "n_chars"])


@pytest.mark.parametrize("step", [windows._anchors(suffixes.SPEC), windows._anchors(PASSAGE), setsketch._signatures, setsketch._full_sets, quality._examples],
                         ids=["byte anchors", "word anchors", "signatures", "full sets", "examples"])
def test_arrays_of_a_slice_stay_small(step):
    tracemalloc.start()
    try:
        assert sum(out.num_rows for out in step(iter([BATCH]))) >= len(TEXTS)
        assert tracemalloc.get_traced_memory()[1] < 20e6
    finally:
        tracemalloc.stop()
