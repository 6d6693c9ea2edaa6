"""The tasks list a mounted tree, with the rows that Spark's file source gives."""

import os
from datetime import datetime, timezone

import pytest

from quire.sources import files


@pytest.mark.parametrize("budget", [0, 2, 100])
def test_tasks_list_as_spark_does(spark, tmp_dir, monkeypatch, budget):
    monkeypatch.setattr(files, "FOLDERS_OF_TASK", max(budget, 1))
    monkeypatch.setattr(files, "_list_folders", lambda _, of=files._list_folders: of(budget))
    names = ["a.txt", "empty.txt", ".dot.txt", "_under.txt", "_k=v.txt", "_metadata", "_metadata_x/a.txt", "b.csv", "no dot", "x/c.txt", "x/y/d.tar.txt", "x/y/z/e.TXT", "_hid/f.txt", ".git/g.txt",
             "k=1/h.txt", "k=1/_l=2/i.txt", "é ü/j%20.txt", "x.txt/k.txt", "x/w._COPYING_", "x/{m}[n].txt"]
    for at, name in enumerate(names):
        os.makedirs(os.path.dirname(f"{tmp_dir}/t/{name}"), exist_ok=True)
        with open(f"{tmp_dir}/t/{name}", "wb") as f:
            f.write(b"" if name.startswith("empty") else f"text {at}\r\né".encode())
        os.utime(f"{tmp_dir}/t/{name}", ns=(0, (1_700_000_000 + at) * 10**9 + 123_456_789))
    os.makedirs(f"{tmp_dir}/t/nothing/here")
    os.symlink(f"{tmp_dir}/absent", f"{tmp_dir}/t/broken.txt")
    os.symlink(f"{tmp_dir}/t/x/y", f"{tmp_dir}/t/linked")
    moment = datetime.fromtimestamp(1_700_000_008, timezone.utc)
    for root in (f"{tmp_dir}/t", f"file://{tmp_dir}/t/"):
        for args in ({}, {"exts": [".txt"]}, {"exts": [".txt", ".csv"], "modified_after": moment}, {"modified_before": moment}, {"depth": 1}, {"exts": ["", ".TXT"]}, {"exts": [".none"]}):
            got = files.scan_tree(spark, root, **args)
            assert "binaryFile" not in got._jdf.queryExecution().optimizedPlan().toString()
            with monkeypatch.context() as m:
                m.setattr(files, "_mounted", lambda *_: None)
                want = files.scan_tree(spark, root, **args)
            assert got.schema == want.schema
            assert sorted(got.collect()) == sorted(want.collect()), args
    assert files.last_modified(spark, f"{tmp_dir}/t") == datetime.fromtimestamp(1_700_000_000 + len(names), timezone.utc)


def test_a_file_is_opened_for_its_contents_only(spark, tmp_dir):
    """Files that are gone after the listing are missed by their contents."""
    os.makedirs(f"{tmp_dir}/t")
    for name in ("a.txt", "b.txt"):
        with open(f"{tmp_dir}/t/{name}", "w") as f:
            f.write("text")
    tree = files.scan_tree(spark, f"{tmp_dir}/t", exts=[".txt"])
    os.rename(f"{tmp_dir}/t/b.txt", f"{tmp_dir}/b.txt")
    assert sorted(r.rel_path for r in tree.select("rel_path").collect()) == ["a.txt", "b.txt"]
    with pytest.raises(Exception, match="No such file"):
        tree.select("contents").collect()
