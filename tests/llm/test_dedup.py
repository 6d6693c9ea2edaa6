"""Suffix, window and near-duplicate operators against brute force."""

import random

import numpy as np
import pytest
from collections import Counter

from quire.llm import setsketch, substrings, suffixes
from tests.llm.helpers import SCHEMA, awkward, brute_bytes, brute_groups, brute_words, order, rows, sha, with_null_ids


@pytest.mark.parametrize("crowd", [1024, 1])
def test_suffixes(spark, monkeypatch, crowd):
    monkeypatch.setattr(suffixes, "CROWD", crowd)
    pairs = with_null_ids(awkward(spark)[1])
    got = suffixes.dedup(spark.createDataFrame(rows(pairs), SCHEMA)).collect()
    assert order((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == order(brute_bytes(pairs))


def test_suffix_sort_against_counting():
    rng = np.random.default_rng(0)
    for _ in range(60):
        body = rng.integers(97, 97 + int(rng.integers(1, 4)), int(rng.integers(50, 900))).astype(np.uint8)
        size = int(rng.integers(9, 50))
        start = np.arange(len(body) - size + 1)
        group = rng.integers(0, 2, len(start))
        raw = body.tobytes()
        key = [(g, raw[i:i + size]) for g, i in zip(group, start)]
        count = Counter(key)
        assert suffixes.repeated_suffixes(body, start, group, size).tolist() == [count[k] > 1 for k in key]


def test_words(spark):
    pairs = with_null_ids(awkward(spark)[1])
    got = substrings.dedup(spark.createDataFrame(rows(pairs), SCHEMA)).collect()
    assert order((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == order(brute_words(pairs))


def test_groups(spark):
    pairs = with_null_ids(awkward(spark)[1])
    got = setsketch.groups(spark.createDataFrame(rows(pairs), SCHEMA)).collect()
    assert order(tuple(r) for r in got) == order(brute_groups(pairs))


def test_one_of_each(spark):
    pairs = with_null_ids(awkward(spark)[1])
    docs = spark.createDataFrame(rows(pairs), SCHEMA)
    got = setsketch.one_of_each(docs)
    assert got.columns == docs.columns
    want = {d for d, _, _, kept in brute_groups(pairs) if kept and d is not None}
    assert order(r.doc_id for r in got.collect()) == order([*want, None, None])


def test_many_near_copies(spark):
    """Bands with several components after the comparison with the leader."""
    base = [f"w{i}" for i in range(120)]
    pairs = []
    for i in range(60):
        w = list(base)
        for k in range(i // 6):       # drifts further and further away
            w[(11 * k) % 120] = f"v{k}"
        w[(7 * i) % 120] = f"x{i}"
        pairs.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows(pairs), SCHEMA)
    assert order(tuple(r) for r in setsketch.groups(docs).collect()) == order(brute_groups(pairs))


def test_copies_with_edits_of_their_own(spark, monkeypatch):
    """Near copies that are mostly too far from each other to be linked: few
    pairs are looked at, and none of the links is lost."""
    r = random.Random(11)
    base = [f"w{i}" for i in range(150)]
    pairs = []
    for i in range(160):
        w = list(base)
        for k in r.sample(range(150), r.choice((1, 2, 3, 4, 5, 6))):
            w[k] = f"x{i}.{k}" if r.random() < 0.8 else f"y{k}"
        pairs.append((i, " ".join(w[:r.choice((150, 150, 140))])))
    seen = []
    inner = setsketch._close_pairs
    monkeypatch.setattr(setsketch, "_close_pairs", lambda *a: seen.append(inner(*a).count()) or inner(*a))
    docs = spark.createDataFrame(rows(pairs), SCHEMA)
    want = brute_groups(pairs)
    assert order(tuple(r) for r in setsketch.groups(docs).collect()) == order(want)
    assert len({x[2] for x in want}) > 20 and seen[0] < 160 * 159 / 2 / 20

def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(5)
    both, a, b = (rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (800, 100, 100))
    one, two = np.unique(np.concatenate([both, a])), np.unique(np.concatenate([both, b]))
    union = np.unique(np.concatenate([one, two]))
    at = np.cumsum([0, len(one), len(two), len(union)])
    k = setsketch.sketches(np.concatenate([one, two, union]), at)
    assert (setsketch.merged(k[0], k[1]) == k[2]).all()
    j = setsketch.estimate(k[:1], k[1:2], np.array([900.0]), np.array([900.0]))
    assert abs(j[0] - 0.8) < 0.12


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert suffixes.dedup(none).collect() == substrings.dedup(none).collect() == setsketch.groups(none).collect() == []
    blank = spark.createDataFrame(rows([(1, None), (2, "")]), SCHEMA)
    assert order(tuple(r) for r in setsketch.groups(blank).collect()) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_queries_match_brute_force(spark):
    """The registered queries over a whole table."""
    from quire.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    pairs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = {n: order(tuple(r) for r in QUERIES[n](spark, sf).collect()) for n in ("op5_deep_shallow_dedup", "op7_rabin_karp_windows", "op9_setsketch_groups")}
    assert got["op5_deep_shallow_dedup"] == order((*x[:4], sha(x[4])) for x in brute_bytes(pairs))
    assert got["op7_rabin_karp_windows"] == order((*x[:3], sha(x[3].encode())) for x in brute_words(pairs))
    assert got["op9_setsketch_groups"] == order(brute_groups(pairs))


def test_hashes_of_strings_that_collide_for_any_base_modulo_a_power_of_two(spark):
    x = "a"
    while len(x) < 4096:
        x += x.translate(str.maketrans("ab", "ba"))
    y = x.translate(str.maketrans("ab", "ba"))
    tail = " " + " ".join(f"w{i}" for i in range(49))
    docs = spark.createDataFrame(rows([(1, x + tail), (2, y + tail), (3, x[:1024]), (4, y[:1024])]), SCHEMA)
    assert order(tuple(r) for r in setsketch.groups(docs).collect()) == order(brute_groups([(r.doc_id, r.text) for r in docs.collect()]))
    got = {r.doc_id: r.n_removed for r in substrings.dedup(docs).collect()}
    assert got == {1: 0, 2: 0, 3: 0, 4: 0}
