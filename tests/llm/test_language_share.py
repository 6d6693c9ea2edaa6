"""Languages with short texts keep their words beside one with long texts."""

from quire.llm import langid


def test_long_texts_do_not_push_other_languages_out(spark):
    long = " ".join(f"{a}{b}o" for a in "bcdfgklmnp" for b in ("ra", "le", "ti")) + " "
    given = [(i, long * 200, "xx", "") for i in range(20)] + [(i, "szybka ryba", "pl", "") for i in range(20, 40)]
    docs = spark.createDataFrame(given, "doc_id long, text string, lang string, source string")
    model = langid.fit(docs, max_words=10, max_grams=20)
    assert len(model.logs[0]) == 10 and {"szybka", "ryba"} <= set(model.logs[0])
    assert "szy" in model.logs[3] and "szybk" in model.logs[5]
    assert all(len(x) <= 20 for x in model.logs[1:])
    got = {r.doc_id: r.lang_pred for r in langid.predict(docs, model).collect()}
    assert got == {i: "xx" if i < 20 else "pl" for i in range(40)}
