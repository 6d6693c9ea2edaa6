"""Token counts and BPE ids against the public library."""

import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from quire.llm import bpe, flat, pretoken, tokencount, vocab
from tests.llm.helpers import SCHEMA, awkward, rows, sha, with_null_ids

TRICKY = ["", "a", "don't we're I'll 'tis ''s 'll've 'l 'r 're  x\n\ny \t z   ", " 's  's\n's 5's a'''s x'd've 'e 'v 'vx", "a" * 70 + " aaaa",
          "x<|endoftext|>y  <|endoftext|> <|endoftext|><|endoftext|>", "日本語 テスト １２３ é́  　 a b   c", "<|endoftext|", "   ", "\n", "'", "'r", "'l",
          " '", "a  ", "123abc!!! ?", "😀😀 👍🏽", "ab" * 3000, "\u0558\u088f²½Ⅷ"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocab.default_path())


def texts():
    r = random.Random(1)
    letters = "ab '\n\tsltrvemd1!é 日<|>  "
    return TRICKY + ["".join(r.choice(letters) for _ in range(r.randint(0, 60))) for _ in range(1500)]


def test_ids_and_counts_match_library(library):
    some = texts()
    want = [e.ids for e in library.encode_batch(some, add_special_tokens=False)]
    v, t = vocab.load(vocab.default_path()), tokencount.MergeTransducer(vocab.load(vocab.default_path()), 5000)
    data, offs = flat.buffer_of(pa.array(some))
    for i, j, d, o in flat.slices(data, offs, 3000):
        ids, at = bpe.encode_flat(v, d, o)
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == want[i:j]
        body, _ = bpe.decode_flat(v, ids, at)
        assert body.tobytes() == d.tobytes()
        assert tokencount.count_flat(t, d, o).tolist() == [len(x) for x in want[i:j]]


def test_chunk_maps_compose(library):
    """The prefix scan gives the same marks for any chunk length."""
    rng = np.random.default_rng(2)
    s = rng.integers(0, 11, 5000).astype(np.uint8)
    whole = pretoken.run(s, 5000)
    for chunk in (1, 7, 64, 4999):
        assert (pretoken.run(s, chunk) == whole).all()


def test_queries_columns(spark, library):
    pairs = with_null_ids(awkward(spark)[1])
    docs = spark.createDataFrame(rows(pairs), SCHEMA)
    ids = [library.encode(t or "", add_special_tokens=False).ids for _, t in pairs]
    want = sorted((str(d), len(x), sha(np.array(x, "<u4").tobytes()), sha(library.decode(x, skip_special_tokens=False).encode())) for (d, _), x in zip(pairs, ids))
    assert sorted((str(r[0]), *r[1:]) for r in bpe.round_trip(docs).collect()) == want
    want = sorted((str(d), len((t or "").encode()), len(x), len(x) > 1024) for (d, t), x in zip(pairs, ids))
    assert sorted((str(r[0]), *r[1:]) for r in tokencount.token_counts(docs).collect()) == want


def test_encode_decode_tables(spark, library):
    docs, pairs = awkward(spark)
    both = bpe.decode(bpe.encode(docs))
    assert both.columns == [*docs.columns, "ids", "decoded"]
    for r in both.collect():
        assert r.ids == library.encode(r.text or "", add_special_tokens=False).ids and r.decoded == (r.text or "")
    none = spark.createDataFrame([], SCHEMA)
    assert bpe.round_trip(none).collect() == tokencount.token_counts(none).collect() == bpe.encode(none).collect() == []


def test_pieces_whose_hashes_could_collide(library):
    """Strings that collide under any polynomial hash modulo a power of two."""
    x = "a"
    while len(x) < 4096:
        x += x.translate(str.maketrans("ab", "ba"))
    some = [z for n in (512, 1024, 4096) for z in (x[:n], x[:n].translate(str.maketrans("ab", "ba")))]
    v, t = vocab.load(vocab.default_path()), tokencount.MergeTransducer(vocab.load(vocab.default_path()), 5000)
    data, offs = flat.buffer_of(pa.array(some))
    want = [e.ids for e in library.encode_batch(some, add_special_tokens=False)]
    ids, at = bpe.encode_flat(v, data, offs)
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == want
    assert tokencount.count_flat(t, data, offs).tolist() == [len(z) for z in want]
