"""Quality classifier, language identification and decontamination."""

import random

import pyarrow as pa
from pyspark.sql import functions as F

from quire.llm import decontaminate, langid, quality
from quire.llm.queries import QUERIES
from tests.llm.helpers import SCHEMA, awkward, prose, rows, with_null_ids

SF = "/root/testdata/sf0.01"


def test_quality_on_held_out_rows(spark):
    got = QUERIES["op2_factorisation_quality"](spark, SF)
    marked = got.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out")
    hit, n = marked.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")), F.count(F.lit(1))).first()
    assert n > 50 and hit >= 0.9
    assert got.where("score < 0 OR score > 1 OR score IS NULL").isEmpty() and got.count() == 1000


def test_quality_awkward_rows(spark):
    docs, pairs = awkward(spark)
    docs = docs.unionByName(spark.createDataFrame(rows([(None, "a b"), (99, "x")]), SCHEMA))
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, None, 0), (None, 1, 0), (3, 0, 1)], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels)
    got = quality.scores(docs, model, ["doc_id", "score"])
    assert got.count() == len(pairs) + 2 and got.columns == ["doc_id", "score", "score"]
    none = labels.limit(0)
    assert {r.score for r in quality.scores(docs, quality.fit(docs, none)).collect()} == {0.5}
    assert quality.scores(docs.limit(0), model).collect() == []


def test_interactions_equal_the_double_sum():
    import numpy as np
    rng = np.random.default_rng(0)
    m = quality.Machine(0.3, rng.normal(size=9), rng.normal(size=(9, 3)), None, None)
    ids, x, first = np.array([0, 4, 7, 1, 2]), rng.normal(size=5), np.array([0, 3])
    want = []
    for a, b in ((0, 3), (3, 5)):
        y = m.bias + sum(m.w[ids[i]] * x[i] for i in range(a, b))
        want.append(y + sum(m.v[ids[i]] @ m.v[ids[j]] * x[i] * x[j] for i in range(a, b) for j in range(i + 1, b)))
    assert np.allclose(m.raw(ids, x, first)[0], want)


def test_language_on_held_out_rows(spark):
    got = QUERIES["op6_word_first_langid"](spark, SF)
    marked = got.join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out")
    assert marked.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] >= 0.95


def test_language_awkward_rows(spark):
    given = [(i, "the cat and the dog", "en") for i in range(30)] + [(i, "der Hund und die Katze", "de") for i in range(30, 60)]
    given += [(100, None, "en"), (101, "", None), (102, "123 !!", "de"), (None, "the", None), (103, "dogs", None), (104, "katzen " * 200_000, None), (105, "Ωμέγα", None)]
    docs = spark.createDataFrame([(*g, "s") for g in given], "doc_id long, text string, lang string, lang_pred string")
    model = langid.fit(docs)
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(docs, model).collect()}
    assert model.langs == ["de", "en"] and got[100] == got[101] == got[102] == ("und", 0.0)
    assert got[None][0] == got[103][0] == "en" and got[104][0] == "de" and got[105][0] == "de"  # nothing known: the first name
    assert langid.predict(docs.limit(0), model).collect() == []
    assert langid.predict(docs, langid.fit(docs.limit(0))).where("lang_pred <> 'und'").isEmpty()


def leaks(seed, text, n):
    r, w = random.Random(seed), text.split()
    for _ in range(n):
        p = r.randrange(len(w))
        kind = r.random()
        if kind < 0.4:
            w[p] = f"sub{r.randrange(99)}"
        elif kind < 0.7:
            w.insert(p, f"ins{r.randrange(99)}")
        else:
            del w[p]
    return " ".join(w)


def test_decontamination_recall_against_brute_force(spark):
    items = [prose(100 + i, random.Random(i).randint(14, 60)) for i in range(40)]
    texts = [prose(500 + k, 80) + " " + leaks(k, items[k % 40], int(len(items[k % 40].split()) * rate)) + " " + prose(900 + k, 50)
             for k, rate in enumerate([0.0, 0.05, 0.1, 0.15, 0.2] * 24)]
    index = decontaminate._index(list(range(40)), items, decontaminate.TOLERANCE)
    words, first = decontaminate.word_hashes(*decontaminate.symbols(pa.array(texts)))
    got = {(r, i): d for r, i, _, _, d in index.hits(words, first)}
    want = {}
    for r in range(len(texts)):
        t = words[first[r]:first[r + 1]]
        i = r % 40
        n, e = int(index.n[i]), int(index.e[i])
        d = min(decontaminate.edit_distance(index.words[i], t[p:p + n + e], e)[0] for p in range(len(t)))
        if d <= e:
            want[r, i] = d
    assert len(want) > 80 and len(set(got) & set(want)) >= 0.95 * len(want)
    assert all(got[k] >= want[k] for k in set(got) & set(want)) and not {k for k in got if k[0] % 40 != k[1]}


def test_decontamination_awkward_rows(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    docs = spark.createDataFrame(rows([(1, f"x {item.upper()}, y"), (2, "alpha beta gamma"), (3, None), (4, ""), (5, "Yes we do"), (None, item), (6, item + " " + item),
                                       (7, "long " * 100_000 + item), (1, f"x {item.upper()}, y")]), SCHEMA)
    items = spark.createDataFrame([(10, item), (10, item), (11, None), (12, "..."), (13, "we do"), (14, "")], "item_id long, text string")
    got = sorted((str(r.doc_id), r.item_id, r.start_word, r.distance) for r in decontaminate.matches(docs, items).collect())
    assert got == [("1", 10, 1, 0), ("1", 10, 1, 0), ("5", 13, 1, 0), ("6", 10, 0, 0), ("7", 10, 100_000, 0), ("None", 10, 0, 0)]
    clean = decontaminate.clean(docs, items, block=1)
    assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == [2, 3, 4]
    assert decontaminate.matches(docs.limit(0), items).collect() == decontaminate.matches(docs, items.limit(0)).collect() == []
    assert decontaminate.clean(docs, items.limit(0)).count() == 9


def test_decontamination_query_finds_whole_items(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    want = {(d, i) for d, t in docs for i, x in items if x in t}
    got = {(r.doc_id, r.item_id): r.distance for r in QUERIES["op8_cgk_decontamination"](spark, SF).collect()}
    assert want and want <= set(got) and all(got[k] == 0 for k in want) and len(got) <= len(want) + 2


def test_null_ids_are_not_learned_from(spark):
    pairs = with_null_ids(awkward(spark)[1])
    docs = spark.createDataFrame(rows(pairs), SCHEMA)
    assert langid.predict(docs, langid.fit(docs)).count() == len(pairs)
