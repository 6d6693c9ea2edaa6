"""Language identification by words first, character n-grams as the fallback.

A word that the model knows adds its log relative frequency in every language
(a fixed penalty where a language lacks it). An unknown word falls back to its
character n-grams with word borders, longest first: the first length of which
any n-gram is known adds the mean over those known. The language with the
highest mean per word wins, ties go to the smaller name.

Word and n-gram counts are gathered by Spark from a bounded sample of the
labelled rows, balanced over the languages (``max_train`` rows in all), and
the model keeps ``max_words`` words and ``max_grams`` n-grams of each length,
so its size is fixed. Every language has the same share of them: items are
taken by their rank within a language, the first of all languages first, and
what a language does not need goes to the others.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.tables import held_out, read

MAX_TRAIN = 4_000
MAX_WORDS = 60_000
MAX_GRAMS = 20_000
LONGEST = 5
PENALTY = 16.0       # natural-log penalty of a language that lacks the item
MEMO = 400_000       # unknown words a task remembers
WORDS = r"\p{L}[\p{L}\p{M}]*"
WHOLE = 1 << 20      # characters of a text whose words are listed at once


def _words(text: str) -> Iterator[str]:
    """The lower-cased words of a text, a part of it at a time if it is long."""
    import regex
    low = text.lower()
    if low.isascii():   # the same words, by the quicker module
        return iter(re.findall("[a-z]+", low)) if len(low) <= WHOLE else (m.group() for m in re.finditer("[a-z]+", low))
    return iter(regex.findall(WORDS, low)) if len(low) <= WHOLE else (m.group() for m in regex.finditer(WORDS, low))


def _grams(word: str, n: int) -> list[str]:
    w = f" {word} "
    return [w[i:i + n] for i in range(len(w) - n + 1) if w[i:i + n] != " "]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of every task: ``(lang, n, item, count)``; n is 0 for words."""
    total: Counter = Counter()
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            for word, c in Counter(_words(text or "")).items():
                total[lang, 0, word] += c
                for n in range(1, LONGEST + 1):
                    for g in _grams(word, n):
                        total[lang, n, g] += c
        if len(total) > 1_000_000:
            yield _rows(total)
            total.clear()
    if total:
        yield _rows(total)


def _rows(total: Counter) -> pa.RecordBatch:
    lang, n, item = zip(*total)
    return pa.RecordBatch.from_arrays([pa.array(lang), pa.array(n, pa.int32()), pa.array(item), pa.array(total.values(), pa.int64())],
                                      names=["lang", "n", "item", "c"])


@dataclass
class Model:
    langs: list[str]
    #: per length (0: words): item -> row of log frequencies, one per language
    logs: list[dict[str, np.ndarray]] = field(default_factory=list)

    def _unknown(self, word: str):
        for n in range(LONGEST, 0, -1):
            got = [r for g in _grams(word, n) if (r := self.logs[n].get(g)) is not None]
            if got:
                return np.mean(got, axis=0)
        return None

    def predict(self, text: str | None, memo: dict) -> tuple[str, float]:
        """``(language, score)``; ``und`` and 0 without a letter or a model."""
        total, n, seen = np.zeros(len(self.langs)), 0, False
        words = _words(text or "")
        while part := Counter(islice(words, 1 << 16)):
            seen = True
            rows, counts = [], []
            for word, c in part.items():
                row = self.logs[0].get(word) if self.langs else None
                if row is None and self.langs:
                    if word not in memo:
                        if len(memo) >= MEMO:
                            memo.clear()
                        memo[word] = self._unknown(word)
                    row = memo[word]
                if row is not None:
                    rows.append(row)
                    counts.append(c)
            if rows:
                total += np.asarray(counts, float) @ np.asarray(rows)
                n += sum(counts)
        if not seen or not self.langs:
            return "und", 0.0
        mean = total / max(n, 1)
        p = np.exp((mean - mean.max()) * min(max(n, 1), 10))
        best = int(np.argmax(mean))
        return self.langs[best], float(p[best] / p.sum())


def fit(docs: DataFrame, max_train: int = MAX_TRAIN, max_words: int = MAX_WORDS, max_grams: int = MAX_GRAMS) -> Model:
    """A model learned from ``text`` and non-null ``lang`` of at most
    ``max_train`` rows outside the held-out fold (rows without a known fold,
    that is with a null id, are not learned from)."""
    known = docs.where(F.col("lang").isNotNull() & F.coalesce(~held_out("doc_id"), F.lit(False)))
    w = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = known.select("doc_id", "lang").distinct().withColumn("turn", F.row_number().over(w)).where(F.col("turn") <= max_train)
    ids = ids.orderBy("turn", "lang").limit(max_train).select("doc_id", "lang")
    # bounded by max_train rows
    sample = known.select("doc_id", "lang", "text").join(F.broadcast(ids), ["doc_id", "lang"])
    counts = sample.select("lang", "text").mapInArrow(_count, "lang string, n int, item string, c long").groupBy(
        "lang", "n", "item").agg(F.sum("c").alias("c"))
    place = F.row_number().over(Window.partitionBy("lang", "n").orderBy(F.desc("c"), "item"))
    wide = counts.withColumn("place", place).groupBy("n", "item").agg(
        F.min("place").alias("place"), F.collect_list(F.struct("lang", "c")).alias("by"))
    totals = counts.groupBy("lang", "n").agg(F.sum("c").alias("c")).collect()  # one row per language and length
    langs = sorted({r["lang"] for r in totals})
    size = {(r["lang"], r["n"]): r["c"] for r in totals}
    top = Window.partitionBy("n").orderBy("place", "item")
    kept = wide.withColumn("r", F.row_number().over(top)).where(
        F.col("r") <= F.when(F.col("n") == 0, max_words).otherwise(max_grams)).select("n", "item", "by")
    logs: list[dict[str, np.ndarray]] = [{} for _ in range(LONGEST + 1)]
    at = {x: i for i, x in enumerate(langs)}
    for n, item, by in kept.toLocalIterator():  # bounded by max_words and max_grams
        row = np.full(len(langs), -PENALTY)
        for lang, c in by:
            row[at[lang]] = np.log(c / size[lang, n])
        logs[n][item] = row
    return Model(langs, logs)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row of ``docs(doc_id, text)``.
    Null texts and texts without a letter are ``und`` with score 0; repeated
    rows stay repeated; an empty table gives no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict = {}
        for batch in batches:
            got = [shared.value.predict(t.as_py(), memo) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([g[0] for g in got], pa.string()),
                                              pa.array([g[1] for g in got], pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def op6_word_first_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every whole text of ``documents``."""
    docs = read(spark, sf_dir, "documents")
    out = predict(docs, fit(docs))
    return out.select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "lang_pred", "score")
