"""Packing: ids of the library, whole pieces, few sequences."""

import random
import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quire.llm import packing
from quire.llm.tables import read
from tests.llm.helpers import awkward

SF = "/root/testdata/sf0.001"


def library(text):
    lib = Tokenizer.from_file(packing.default_path())
    lib.no_truncation()
    lib.no_padding()
    return lib.encode(text or "", add_special_tokens=False).ids + [1]


def check_bins(rows, capacity):
    """Rows (sequence, offset, length): gapless from 0, within the capacity."""
    bins = defaultdict(list)
    for s, o, n in rows:
        bins[s].append((o, n))
    for items in bins.values():
        at = 0
        for o, n in sorted(items):
            assert o == at
            at += n
        assert at <= capacity
    return len(bins)


def test_query_keeps_every_token(spark):
    docs = read(spark, SF, "documents").collect()
    rows = packing.op12_bounded_best_fit(spark, SF).collect()
    by_doc = defaultdict(dict)
    for r in rows:
        by_doc[r.doc_id][r.piece] = r
    assert len(rows) == sum(len(x) for x in by_doc.values())
    total = 0
    for d in docs:
        ids = np.array(library(d.text), "<u4")
        cut = [ids[i:i + 4096] for i in range(0, len(ids), 4096)]
        got = by_doc.pop(d.doc_id)
        assert [(got[i].start, got[i].length, got[i].ids_crc32) for i in range(len(got))] == [
            (4096 * i, len(c), zlib.crc32(c.tobytes())) for i, c in enumerate(cut)]
        total += len(ids)
    assert not by_doc
    used = check_bins([(r.sequence_id, r.offset, r.length) for r in rows], 4096)
    assert used <= 1.06 * -(-total // 4096)


def test_ids_of_awkward_texts(spark):
    texts = ["a<|endoftext|>b <|startoftext|>", "İstanbul ΣΑΣ ς", "é ́x q̣̇", "x y z\x1c!\x85", "don't 'S 's'T", "  \n ",
             "日本語 テスト", "a" * 5000, "12 345 ½ ²", "\U0001f600‍❤", "ÀÉÎÕÜÇÑ×÷ßÿ ¿qué? ¡sí! \x7f\x1f", "ẛ̣", "\u0000 \x00a"]
    df = spark.createDataFrame([(i, t, "e", 3) for i, t in enumerate(texts)], "doc_id long, text string, ids string, length int")
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in packing.pieces(df, capacity=1 << 20).collect()}
    assert got == {i: library(t) for i, t in enumerate(texts)}


def test_long_texts_and_full_memory(monkeypatch):
    r = random.Random(3)
    text = " ".join("".join(r.choice("abcdeé'1") for _ in range(r.randint(1, 9))) for _ in range(3000)) + " " + "z" * 700
    monkeypatch.setattr(packing, "PART", 50)
    monkeypatch.setattr(packing, "KNOWN", 20)
    enc = packing.Encoder(packing.default_path())
    texts = [text, "", "a", "  ", text[:70]]
    assert [np.frombuffer(x, "<u4").tolist() for x in enc.ids([t.encode() for t in texts])] == [library(t)[:-1] for t in texts]


def test_awkward_rows(spark):
    df, pairs = awkward(spark)
    df = df.unionByName(df.limit(1).withColumn("doc_id", F.lit(None).cast("long")))
    got = packing.pack(packing.pieces(df, capacity=64).drop("ids"), capacity=64, most=4, group=50).collect()
    want = sum(len(library(t)) for _, t in pairs) + len(library(pairs[0][1]))
    assert sum(r.length for r in got) == want
    check_bins([(r.sequence_id, r.offset, r.length) for r in got], 64)
    assert any(r.doc_id is None for r in got)
    assert packing.pack(packing.pieces(df.limit(0)).drop("ids")).collect() == []


def test_groups_fill_the_bins_that_others_leave(spark):
    r = random.Random(5)
    sizes = [r.randint(1, 100) for _ in range(4000)]
    items = spark.createDataFrame(list(enumerate(sizes)), "doc_id long, length long")
    got = packing.pack(items, capacity=100, most=8, group=100).collect()
    assert sorted((x.doc_id, x.length) for x in got) == list(enumerate(sizes))
    used = check_bins([(x.sequence_id, x.offset, x.length) for x in got], 100)
    assert used <= 1.12 * sum(sizes) / 100


def test_bins_close_the_fullest_first():
    b = packing.Bins(0, 10, 2)
    assert [b.place(n) for n in (6, 7, 4, 5, 3)] == [(0, 0), (1, 0), (0, 6), (2, 0), (1, 7)]
    b = packing.Bins(0, 10, 2)
    # 8 and 7 are open; 5 fits neither, so the bin of 8 closes; 2 goes to the one of 7
    assert [b.place(n) for n in (8, 7, 5, 2)] == [(0, 0), (1, 0), (2, 0), (1, 7)]
    assert sorted(b.left()) == [(1, 9), (2, 5)]
