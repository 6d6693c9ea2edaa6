"""Near duplicates where one id has several texts."""

import corpus_pipeline
from tests.llm.helpers import SCHEMA, awkward, brute_groups, order, prose, rows, with_null_ids


def test_unrelated_texts_of_one_id_stay(spark):
    pairs = with_null_ids(awkward(spark)[1])
    near = prose(9, 60).split()
    near[0] = "changed"
    far = prose(10, 60).split()
    far[59] = "changed"
    # each near one text of id 17, which are unrelated; copies of such a text; two near texts of one id
    pairs += [(60, " ".join(near)), (61, " ".join(far)), (62, prose(9, 60)), (63, prose(50, 80)), (63, prose(50, 80) + " more"), (64, None), (64, prose(51, 30))]
    docs = spark.createDataFrame(rows(pairs), SCHEMA)
    got = corpus_pipeline.near_duplicates(spark, docs, "")
    assert got.columns == docs.columns
    # brute force with a node for each (id, text), in the order of the ids
    nodes = sorted({p for p in pairs if p[0] is not None}, key=lambda p: (p[0], p[1] or ""))
    groups = brute_groups([(i, t) for i, (_, t) in enumerate(nodes)])
    want = [nodes[i] for i, _, _, kept in groups if kept] + [p for p in pairs if p[0] is None]
    have = [(r.doc_id, r.text) for r in got.collect()]
    assert sorted(x[0] for x in have if x[0] == 17) == [17, 17] and not {60, 61, 62} & {x[0] for x in have}
    assert sum(x[0] == 63 for x in have) == 1 and sum(x[0] == 64 for x in have) == 2
    assert order(x for x in have if x[0] != 63) == order(x for x in want if x[0] != 63)
