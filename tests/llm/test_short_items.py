"""Items that are so short that one edit touches all of their 3-word grams."""

import pyarrow as pa

from quire.llm import decontaminate
from tests.llm.helpers import prose


def test_five_words_with_one_edit_are_found():
    items = [prose(2000 + i, 5) for i in range(40)]
    texts, of = [], []
    for i, x in enumerate(items):
        w = x.split()
        for k in range(5):
            for changed in ([*w[:k], "sub", *w[k + 1:]], [*w[:k], *w[k + 1:]], [*w[:k], "ins", *w[k:]]):
                texts.append(f"{prose(3000 + i, 30)} {' '.join(changed)} {prose(4000 + i, 20)}")
                of.append(i)
    index = decontaminate._index(list(range(40)), items, decontaminate.TOLERANCE)
    got = {(r, i) for r, i, *_ in index.hits(*decontaminate.word_hashes(*decontaminate.symbols(pa.array(texts))))}
    assert set(enumerate(of)) <= got


def test_the_bound_of_kept_grams_holds():
    for n in range(1, 80):
        e = decontaminate.edits(n, decontaminate.TOLERANCE)
        q = decontaminate.gram_size(n, e)
        assert 1 <= q <= min(decontaminate.GRAM, n) and n - q + 1 - q * e >= 1
