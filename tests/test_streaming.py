"""Incremental ingest: two stream runs, the second with a new file."""

import os

from quire.streaming import ingest


def _write(root, rel, text):
    p = os.path.join(root, rel)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "w") as f:
        f.write(text)


def test_ingest_two_runs(spark, tmp_dir):
    src, target, ckpt = (os.path.join(tmp_dir, x) for x in ("src", "coll", "ckpt"))
    _write(src, "a/1.txt", "alpha beta\nbeta\n")
    _write(src, "b/2.txt", "gamma")
    q = ingest.start_ingest(spark, src, target, ckpt)
    q.awaitTermination(300)
    docs = {os.path.basename(r.path): r.text for r in ingest.read_docs(spark, target).collect()}
    assert docs == {"1.txt": "alpha beta\nbeta", "2.txt": "gamma"}
    post = {(os.path.basename(r.path), r.term): r.tf for r in ingest.read_postings(spark, target).collect()}
    assert post[("1.txt", "beta")] == 2
    # a new file arrives
    _write(src, "a/3.txt", "delta delta")
    q = ingest.start_ingest(spark, src, target, ckpt)
    q.awaitTermination(300)
    post = {(os.path.basename(r.path), r.term): r.tf for r in ingest.read_postings(spark, target).collect()}
    assert post[("3.txt", "delta")] == 2 and ("2.txt", "gamma") in post
