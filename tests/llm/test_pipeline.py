"""The pipeline against a brute-force version of its stages."""

import shutil
from collections import Counter

import pyarrow as pa
from tokenizers import Tokenizer

import corpus_pipeline
from quire.llm import decontaminate, quality, suffixes, vocab
from tests.llm.helpers import brute_groups, awkward, order, rows, SCHEMA, with_null_ids, WORDS

SF = "/root/testdata/sf0.001"


def brute_leaks(pairs, items):
    """Ids of documents within the tolerance of an item, by all windows."""
    words, first = decontaminate.word_hashes(*decontaminate.symbols(pa.array([t or "" for _, t in pairs])))
    iw, at = decontaminate.word_hashes(*decontaminate.symbols(pa.array(items)))
    out = set()
    for r in range(len(pairs)):
        t = words[first[r]:first[r + 1]]
        known = set(t.tolist())
        for a, b in zip(at[:-1], at[1:]):
            item, e = iw[a:b], decontaminate.edits(b - a, decontaminate.TOLERANCE)
            if not len(item) or sum(w in known for w in item.tolist()) < len(item) - e:
                continue
            if any(decontaminate.edit_distance(item, t[p:p + len(item) + e], e)[0] <= e for p in range(len(t))):
                out.add(r)
                break
    return out


def brute_both(pairs, window=400, words=50):
    """Bytes cut by repeated windows of bytes and of words."""
    raw, found = [(t or "").encode() for _, t in pairs], [list(WORDS.finditer(t or "")) for _, t in pairs]
    keys = [[tuple(m.group() for m in f[i:i + words]) for i in range(len(f) - words + 1)] for f in found]
    often, passages = Counter(), Counter(k for x in keys for k in x)
    for b in raw:
        often.update(b[i:i + window] for i in range(len(b) - window + 1))
    out = []
    for (d, t), b, f, k in zip(pairs, raw, found, keys):
        gone = bytearray(len(b))
        spans = [(i, i + window) for i in range(len(b) - window + 1) if often[b[i:i + window]] > 1]
        spans += [(len(t[:f[i].start()].encode()), len(t[:f[i + words - 1].end()].encode())) for i, x in enumerate(k) if passages[x] > 1]
        for s, e in spans:
            gone[s:e] = b"\1" * (e - s)
        out.append((d, len(b), sum(gone), 0, bytes(x for x, g in zip(b, gone) if not g)))
    return out


def brute(spark, docs, sf_dir):
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    good = [r for r in quality.scores(docs, model, ["doc_id", "text"]).collect() if r[2] >= 0.7]
    pairs = [(r.doc_id, r.text) for r in good]
    seen, kept = set(), []
    for p, g in zip(pairs, brute_groups(pairs)):
        if g[3] and (p[0] is None or p[0] not in seen):
            seen.add(p[0])
            kept.append(p)
    cut = [(x[0], x[4].decode("utf-8", "ignore")) for x in brute_both(kept)]
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    bad = brute_leaks(cut, items)
    lib = Tokenizer.from_file(vocab.default_path())
    return order((d, lib.encode(t, add_special_tokens=False).ids, t) for r, (d, t) in enumerate(cut) if r not in bad)


def test_pipeline_matches_brute_force(spark):
    got = order((r.doc_id, r.ids, r.decoded) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == brute(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)


def test_stages_on_awkward_rows(spark, tmp_dir):
    pairs = with_null_ids([p for p in awkward(spark)[1] if p[0] != 17])
    docs = spark.createDataFrame(rows(pairs), SCHEMA)
    for t in ("labels", "benchmark"):
        shutil.copy(f"{SF}/{t}.parquet", f"{tmp_dir}/{t}.parquet")
    want = brute(spark, docs, tmp_dir)
    one, empty = docs, docs.limit(0)
    for i, (_, step) in enumerate(corpus_pipeline.STAGES):
        one, empty = step(spark, one, tmp_dir), step(spark, empty, tmp_dir)
        if i < 4:
            assert one.columns == docs.columns and empty.columns == docs.columns
    assert empty.collect() == []
    assert order((r.doc_id, r.ids, r.decoded) for r in one.collect()) == want


def test_repeated_passages_of_few_bytes(spark):
    """51 words of less than 400 bytes in otherwise different documents are cut
    there, whatever the white space; a string without words still is, too."""
    w = [f"w{i}" for i in range(51)]
    solid = "".join(f"{i:03d}" for i in range(150))
    own = [" ".join(f"d{k}x{i}" for i in range(120)) for k in range(6)]
    pairs = [(1, f"{own[0]} {' '.join(w)} end"), (2, f"start {chr(10).join(w)} {own[1]}"), (3, f"{own[2]} {' '.join(w[:49])}"), (4, own[3]),
             (5, f"{own[4]} {solid}"), (6, f"{solid} {own[5]}"), (7, None), (8, "")]
    assert len(" ".join(w).encode()) < 400
    docs = spark.createDataFrame(rows(pairs), SCHEMA)
    for crowd in (1024, 1):
        old, suffixes.CROWD = suffixes.CROWD, crowd
        try:
            got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.suffix_dedup(spark, docs, SF).collect()}
        finally:
            suffixes.CROWD = old
        assert got[1][0] == f"{own[0]}  end" and got[2][0] == f"start  {own[1]}"
        assert got[1][1] == len(got[1][0])
        assert got[5][0].split() == own[4].split() and got[6][0].split() == own[5].split()
        assert [got[i][0] for i in (3, 4, 7, 8)] == [pairs[2][1], pairs[3][1], None, ""]
