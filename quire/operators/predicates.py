"""Search predicates over the stored index.

A search is a clause table ``(query_id, clause_id, occur, kind, text, boost,
slop, field)`` instead of a query string:

* ``occur``: ``must`` | ``should`` | ``must_not``. A document matches a query
  when it matches every ``must`` clause, no ``must_not`` clause, and (when
  the query has no ``must`` clause) at least one ``should`` clause. A query
  of only ``must_not`` clauses matches nothing.
* ``kind``: ``term`` (the analysed words of ``text``, each scored),
  ``phrase`` (the analysed words at consecutive positions; with ``slop`` > 0
  within that distance), ``prefix``, ``wildcard`` (``*`` any run, ``?`` one
  character), ``fuzzy`` (edit distance <= ``slop``, 2 if it is null) and ``regex``
  (the whole term matches). Pattern kinds match terms of the field's
  dictionary as written (not analysed).
* ``boost`` >= 0 multiplies the clause score; ``field`` names the searched
  field (default ``text``).

Scores (summed over matching ``must``/``should`` clauses):
term: boost * sum_t qtf * sqrt(tf) * idf_t / sqrt(dl); phrase: boost *
sqrt(freq) * sum_t idf_t / sqrt(dl), where a sloppy match at distance d adds
1 / (1 + d) to freq; pattern kinds: boost (constant score).
idf_t = 1 + ln((N + 1) / (df_t + 1)), N = documents with the field.

Sloppy distance of a match anchored at an occurrence p of the first phrase
word: each other word i takes its occurrence q_i closest to p + i; with
a_0 = p and a_i = q_i - i, d = max a - min a; the anchor counts when every
word is within ``slop`` of its place and d <= slop.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import token_array
from quire.operators.index import SPAN, Index
from quire.session import BROADCAST_MAX_ROWS, bounded_broadcast, staging_path, written

OCCURS = ("must", "should", "must_not")
KINDS = ("term", "phrase", "prefix", "wildcard", "fuzzy", "regex")
PATTERN_KINDS = ("prefix", "wildcard", "fuzzy", "regex")
DEFAULT_FUZZY_EDITS = 2   # of a fuzzy clause whose slop is null
MOST_EDITS = 2            # fuzzy clauses up to this are found by deletions
DOCS_OF_TASK = 8192       # documents whose clauses are put together in one task, about

CLAUSE_KEY = ["query_id", "clause_id"]


def normalise_clauses(clauses: DataFrame) -> DataFrame:
    """Fill defaults and validate occur, kind and boost (negative boosts are
    rejected)."""
    cols = set(clauses.columns)

    def opt(name, default):
        return F.coalesce(F.col(name), F.lit(default)) if name in cols else F.lit(default)

    c = clauses.select(
        F.col("query_id").cast("long").alias("query_id"), F.col("clause_id").cast("int").alias("clause_id"),
        F.lower(opt("occur", "should")).alias("occur"), F.lower(opt("kind", "term")).alias("kind"),
        F.col("text").cast("string").alias("text"),
        opt("boost", 1.0).cast("double").alias("boost"),
        (F.col("slop") if "slop" in cols else F.lit(None)).cast("int").alias("slop"),
        opt("field", "text").alias("field"))
    c = c.withColumn("slop", F.coalesce("slop", F.when(F.col("kind") == "fuzzy", DEFAULT_FUZZY_EDITS).otherwise(0)))
    bad = c.where(~F.col("occur").isin(*OCCURS) | ~F.col("kind").isin(*KINDS) | (F.col("boost") < 0))
    if bad.limit(1).count():
        raise ValueError("clauses need occur in %s, kind in %s and boost >= 0" % (OCCURS, KINDS))
    return c


def wildcard_to_like(pattern: Column) -> Column:
    """``*``/``?`` wildcard to a LIKE pattern (``%``, ``_`` and ``\\``
    escaped)."""
    esc = F.regexp_replace(pattern, r"([\\%_])", r"\\$1")
    return F.translate(esc, "*?", "%_")


def _pattern_match(term: Column, kind: Column, text: Column, slop: Column) -> Column:
    near = F.levenshtein(term, text, MOST_EDITS)
    return (F.when(kind == "prefix", F.startswith(term, text))
             .when(kind == "wildcard", F.like(term, wildcard_to_like(text)))
             .when((kind == "fuzzy") & (slop <= MOST_EDITS), (near >= 0) & (near <= slop))
             .when(kind == "fuzzy", F.levenshtein(term, text) <= slop)
             .when(kind == "regex", F.regexp_like(term, F.concat(F.lit("^(?:"), text, F.lit(")$"))))
             .otherwise(F.lit(False)))


def _runs(kind: Column, text: Column) -> Column:
    """Texts that every match of a pattern holds, ``^`` and ``$`` being the
    term's ends: the literal runs between the wildcards; of a regular
    expression without alternatives the runs between its special characters,
    or only its literal beginning if it has groups, sets or escapes. A
    character that a ``?``, ``*`` or ``{`` follows may be absent, so it ends the
    run before it."""
    wild = F.split(F.concat(F.lit("^"), text, F.lit("$")), r"[*?]+")
    plain = F.split(F.concat(F.lit("^"), text, F.lit("$")), r".[?*][?+]?|[.+][?]?")
    lead = F.array(F.concat(F.lit("^"), F.regexp_extract(text, r"^([\p{L}\p{N}_]*)(?![?*{])", 1)))
    regex = (F.when(text.rlike(r"[|\^$]"), F.array().cast("array<string>"))
              .when(text.rlike(r"[(\[{\\)\]}]"), lead).otherwise(plain))
    return (F.when(kind == "prefix", F.array(F.concat(F.lit("^"), text)))
             .when(kind == "wildcard", wild).otherwise(regex))


def _grams_of_terms(term: Column) -> Column:
    """Grams of three and of two characters of ``^term$``."""
    t = F.concat(F.lit("^"), term, F.lit("$"))
    places = F.sequence(F.lit(1), F.length(t) - 1)
    return F.array_distinct(F.concat(F.transform(places, lambda i: F.substring(t, i, F.lit(2))),
                                     F.transform(places, lambda i: F.substring(t, i, F.lit(3)))))


def _gram_of_pattern(kind: Column, text: Column) -> Column:
    """A gram that all terms a pattern matches have: the end of its longest
    run (the end of a run says more than the ``^`` before it); null without a
    run of two characters."""
    best = F.aggregate(_runs(kind, text), F.lit(""), lambda a, r: F.when(F.length(r) > F.length(a), r).otherwise(a))
    return F.when(F.length(best) >= 3, F.substring(best, F.length(best) - 2, F.lit(3))).when(F.length(best) == 2, best)


def _without_one(s: Column) -> Column:
    """A word without each of its characters in turn."""
    n = F.length(s)
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
                                     lambda i: F.concat(F.substring(s, F.lit(1), i - 1), F.substring(s, i + 1, n)))).otherwise(F.array().cast("array<string>"))


def _deletions(s: Column, edits: Column) -> Column:
    """A word with up to ``edits`` (at most 2) characters deleted. Two words
    within that many edits have one of these in common."""
    one = _without_one(s)
    two = F.flatten(F.transform(one, _without_one))
    none = F.array(s)
    return F.array_distinct(F.when(edits >= 2, F.concat(none, one, two)).when(edits == 1, F.concat(none, one)).otherwise(none))


def candidate_pairs(dictionary: DataFrame, patterns: DataFrame) -> DataFrame:
    """``(*clause, field, kind, text, slop, term)``: the dictionary terms
    that each pattern is compared with. ``dictionary`` is ``(field, term)``,
    ``patterns`` ``(query_id, clause_id, field, kind, text, slop)``.
    """
    return _meetings(dictionary, patterns).distinct()


def _meetings(dictionary: DataFrame, patterns: DataFrame) -> DataFrame:
    """``candidate_pairs``, of which some may come twice.

    Prefix, wildcard and regular expressions meet the terms that hold one gram
    they need; fuzzy patterns of up to two edits the terms that share a word
    with deletions; other fuzzy patterns the terms of a length in reach. Every
    meeting is a join with equality. Only a pattern without any fixed pair of
    characters meets the whole dictionary of its field.
    """
    kind, text, slop = F.col("kind"), F.col("text"), F.col("slop")
    keep = [*CLAUSE_KEY, "field", "kind", "text", "slop"]
    close = (kind == "fuzzy") & (slop <= MOST_EDITS)
    lengths = F.transform(F.sequence(F.greatest(F.length(text) - slop, F.lit(0)), F.length(text) + slop), lambda n: n.cast("string"))
    gram = _gram_of_pattern(kind, text)
    none = F.array().cast("array<string>")
    sides = []   # (patterns with their keys, keys of a term)
    edits = patterns.where(close).agg(F.max("slop")).first()[0]   # one number
    if edits is not None:
        sides.append((patterns.where(close), _deletions(text, slop), _deletions(F.col("term"), F.lit(edits))))
    sides.append((patterns.where((kind == "fuzzy") & ~close), lengths, F.array(F.length("term").cast("string"))))
    sides.append((patterns.where((kind != "fuzzy") & gram.isNotNull()), F.array(gram), _grams_of_terms(F.col("term"))))
    sides.append((patterns.where((kind != "fuzzy") & gram.isNull()), F.array(F.lit("")), F.array(F.lit(""))))
    out = None
    for some, keys, term_keys in sides:
        if some.isEmpty():
            continue
        asked = some.select(*keep, F.explode(F.coalesce(keys, none)).alias("key")).distinct()
        wanted = bounded_broadcast(asked.select("field", "key").distinct())
        # terms that no pattern asks for are left out before anything moves
        met = dictionary.select("field", "term", F.explode(term_keys).alias("key")).join(wanted, ["field", "key"], "left_semi")
        got = met.join(bounded_broadcast(asked), ["field", "key"]).select(*keep, "term")
        out = got if out is None else out.unionByName(got)
    if out is None:
        return dictionary.limit(0).join(patterns.limit(0), "field").select(*keep, "term")
    return out


def _pattern_hits(index: Index, expanded: DataFrame, dealt: int) -> DataFrame:
    """``(span, query_id, clause_id, doc_id, raw)`` of the pattern clauses,
    from ``(field, term, clauses)``: the clauses that each term matches.

    The score is constant, so only a block's documents move, as places in their
    span. They are united as arrays, first for every set of clauses and then
    for every clause, so no row is made of a posting, and a document's row
    is made once.
    """
    place = F.transform("docs", lambda d: (d - F.col("span") * SPAN).cast("short")).alias("docs")
    blocks = index.store.read("blocks").where(F.col("term").isNotNull()).select("span", "field", "term", place)
    met = blocks.join(bounded_broadcast(expanded), ["field", "term"]).select("span", "clauses", "docs").repartition(dealt, "span")
    # at most SPAN places are left of each
    united = F.array_distinct(F.flatten(F.collect_list("docs"))).alias("docs")
    per_set = met.groupBy("span", "clauses").agg(united).select("span", F.inline("clauses"), "docs")
    per = per_set.groupBy("span", *CLAUSE_KEY).agg(united)
    return per.select("span", *CLAUSE_KEY, F.explode("docs").alias("at")).select(
        "span", *CLAUSE_KEY, (F.col("span") * SPAN + F.col("at")).alias("doc_id"), F.lit(1.0).alias("raw"))


def search(source: Index | DataFrame, clauses: DataFrame, fields: Mapping[str, Column] | None = None,
           keyword_fields: Sequence[str] = (), id_col: str = "doc_id") -> DataFrame:
    """Run every query of the clause table: ``(query_id, doc_id, score)``.

    ``source`` is a stored index that holds the fields the clauses name, with
    its ``keyword_fields``, or a frame of documents with the ``fields`` to
    search, of which those that a clause names are indexed first. A field that
    is not indexed matches nothing.
    """
    cl = written(normalise_clauses(clauses), "clauses")
    # frames with a row per clause (or clause word) share one size check
    few = cl.limit(BROADCAST_MAX_ROWS + 1).count() <= BROADCAST_MAX_ROWS
    named = {r.field for r in cl.select("field").distinct().collect()}   # one row a field
    if isinstance(source, Index):
        index = source
    else:
        fields = {n: c for n, c in dict(fields or {"text": F.col("text")}).items() if n in named}
        keys = [c for c in keyword_fields if c in named]
        if not fields and not keys:
            return source.sparkSession.createDataFrame([], "query_id long, doc_id long, score double")
        index = Index(source.sparkSession, staging_path(source.sparkSession, "index")).add(source, fields, keys, id_col)

    def small(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if few else df

    kw = F.col("field").isin(*keyword_fields) if keyword_fields else F.lit(False)
    # words of term and phrase clauses, with their offset in the clause
    words = (cl.where(F.col("kind").isin("term", "phrase"))
               .select(*CLAUSE_KEY, "kind", "field", "slop",
                       F.when(kw, F.array(F.col("text"))).otherwise(token_array("text")).alias("_w"))
               .select(*CLAUSE_KEY, "kind", "field", "slop", F.posexplode("_w").alias("offset", "term")))
    dictionary = index.term_stats(None).where(F.col("field").isin(*named))
    pats = cl.where(F.col("kind").isin(*PATTERN_KINDS)).select(*CLAUSE_KEY, "field", "kind", "text", "slop")
    asks = words.select("field", "term")
    expanded = None
    if not pats.isEmpty():
        pairs = _meetings(dictionary.select("field", "term"), pats)
        pairs = pairs.where(_pattern_match(F.col("term"), F.col("kind"), F.col("text"), F.col("slop")))
        expanded = written(pairs.groupBy("field", "term").agg(F.array_sort(F.collect_set(F.struct(*CLAUSE_KEY))).alias("clauses")), "terms")   # at most the clauses
    asks = asks.distinct()
    n_of = {f: index.totals(f).doc_count for f in named}
    n = F.element_at(F.create_map(*[x for f, c in n_of.items() for x in (F.lit(f), F.lit(float(c)))]), F.col("field"))
    idf = dictionary.join(bounded_broadcast(words.select("field", "term").distinct()), ["field", "term"], "left_semi").select(
        "field", "term", (F.lit(1.0) + F.log((n + 1) / (F.col("df") + 1))).alias("idf"))
    idf = bounded_broadcast(idf)
    blocks = index.store.read("blocks").where(F.col("term").isNotNull()).join(bounded_broadcast(asks), ["field", "term"], "left_semi")
    arrays = ["docs", "tfs", "dls"] if cl.where(F.col("kind") == "phrase").isEmpty() else ["docs", "tfs", "dls", "places"]
    # the blocks move once, as stored; all rows of a document then lie in the
    # task of its span, with so few documents a task that none has to spill
    dealt = max(max((index.totals(f).max_doc for f in named), default=0) // DOCS_OF_TASK, index.store.spark.sparkContext.defaultParallelism)
    blocks = blocks.select("span", "field", "term", *arrays).repartition(int(dealt), "span")
    post = blocks.select("span", "field", "term", F.inline(F.arrays_zip(*arrays))).withColumnsRenamed(
        {"docs": "doc_id", "tfs": "tf", "dls": "dl"})

    # term clauses
    tw = (words.where(F.col("kind") == "term").groupBy(*CLAUSE_KEY, "field", "term")
               .agg(F.count(F.lit(1)).alias("qtf")).join(idf, ["field", "term"]))
    hits = None
    if expanded is None or not words.isEmpty():
        hits = (post.join(small(tw), ["field", "term"])
                    .groupBy("span", *CLAUSE_KEY, "doc_id")
                    .agg(F.sum(F.col("qtf") * F.sqrt(F.col("tf").cast("double")) * F.col("idf")
                               / F.sqrt(F.col("dl").cast("double"))).alias("raw")))
    if expanded is not None:   # pattern clauses: constant score
        found = _pattern_hits(index, expanded, int(dealt))
        hits = found if hits is None else hits.unionByName(found)
    pw = words.where(F.col("kind") == "phrase")
    if not pw.isEmpty():
        asked = index.store.read("blocks").where(F.col("term").isNotNull()).join(bounded_broadcast(asks), ["field", "term"], "left_semi")
        if not asked.where(F.exists("places", lambda p: p.isNull())).isEmpty():
            raise ValueError("phrases need an index with positions")
        hits = hits.unionByName(_phrases(pw, post, idf, small))

    info = cl.select(*CLAUSE_KEY, "occur", "boost")
    scored = hits.join(small(info), CLAUSE_KEY).withColumn("s", F.col("raw") * F.col("boost"))
    # a clause without words can neither match nor be required
    says = F.col("kind").isin(*PATTERN_KINDS) | kw | (F.size(token_array("text")) > 0)
    need = cl.groupBy("query_id").agg(F.sum(((F.col("occur") == "must") & says).cast("int")).alias("n_must"))
    per = scored.groupBy("span", "query_id", "doc_id").agg(
        F.sum((F.col("occur") == "must").cast("int")).alias("m"),
        F.sum((F.col("occur") == "must_not").cast("int")).alias("mn"),
        F.sum((F.col("occur") == "should").cast("int")).alias("sh"),
        F.sum(F.when(F.col("occur") != "must_not", F.col("s")).otherwise(F.lit(0.0))).alias("score"))
    ok = ((F.col("m") == F.col("n_must")) & (F.col("mn") == 0) & ((F.col("n_must") > 0) | (F.col("sh") > 0)))
    return per.join(small(need), "query_id").where(ok).select("query_id", "doc_id", "score")


def _sloppy_freq(words: Column, slop: Column) -> Column:
    """Sum of 1 / (1 + d) over the anchors of a phrase, from ``words``, the
    array of ``(offset, at)`` by offset, ``at`` being a word's positions less
    its offset.

    For every shift within ``slop``, nearest first, the anchors that another
    word meets at that shift are an intersection of arrays. One pass over
    these meetings, ordered by anchor, word and shift, keeps the nearest shift
    of every word, so the work grows with the positions and not with their
    pairs.
    """
    anchors = F.element_at(words, 1)["at"]
    shifts = F.array_sort(F.transform(F.sequence(-slop, slop), lambda d: F.struct(F.abs(d).alias("far"), d.alias("by"))))

    def of_word(w):
        def of_shift(s, rank):
            met = F.array_intersect(anchors, F.transform(w["at"], lambda p: p - s["by"]))
            return F.transform(met, lambda a: F.struct(a.alias("anchor"), w["offset"].alias("word"), rank.alias("rank"), s["by"].alias("by")))
        return F.flatten(F.transform(shifts, of_shift))

    met = F.array_sort(F.flatten(F.transform(F.slice(words, F.lit(2), F.size(words) - 1), of_word)))
    zero = F.struct(F.lit(None).cast("int").alias("anchor"), F.lit(-1).alias("word"), F.lit(0).alias("k"), F.lit(0).alias("lo"),
                    F.lit(0).alias("hi"), F.lit(0.0).alias("freq"))

    def counted(s):
        wide = s["hi"] - s["lo"]
        whole = (s["k"] == F.size(words) - 1) & (wide <= slop)
        return s["freq"] + F.when(whole, F.lit(1.0) / (F.lit(1.0) + wide)).otherwise(F.lit(0.0))

    def step(s, x):
        new = ~s["anchor"].eqNullSafe(x["anchor"])
        other = new | (s["word"] != x["word"])
        k, lo, hi = (F.when(new, F.lit(0)).otherwise(s[c]) for c in ("k", "lo", "hi"))
        return F.struct(x["anchor"].alias("anchor"), x["word"].alias("word"), F.when(other, k + 1).otherwise(k).alias("k"),
                        F.when(other, F.least(lo, x["by"])).otherwise(lo).alias("lo"), F.when(other, F.greatest(hi, x["by"])).otherwise(hi).alias("hi"),
                        F.when(new, counted(s)).otherwise(s["freq"]).alias("freq"))

    return F.aggregate(met, zero, step, counted)


def _phrases(pw: DataFrame, post: DataFrame, idf: DataFrame, small: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``(span, query_id, clause_id, doc_id, raw)`` for phrase clauses: the
    words' position arrays of a document, which lie in the task of its span,
    come together in one row and are merged there."""
    plen = pw.groupBy(*CLAUSE_KEY).agg(F.count(F.lit(1)).alias("L"), F.max("slop").alias("slop"))
    pidf = pw.join(idf, ["field", "term"]).groupBy(*CLAUSE_KEY).agg(F.sum("idf").alias("idf_sum"))
    told = plen.join(pidf, CLAUSE_KEY)
    occ = post.join(small(pw.select(*CLAUSE_KEY, "field", "term", F.col("offset").cast("int").alias("offset"))), ["field", "term"])
    at = F.transform("places", lambda p: p - F.col("offset"))
    rows = occ.groupBy("span", *CLAUSE_KEY, "doc_id").agg(F.array_sort(F.collect_list(F.struct("offset", at.alias("at")))).alias("words"), F.max("dl").alias("dl"))
    rows = rows.join(small(told), CLAUSE_KEY).where(F.size("words") == F.col("L"))
    exact = F.size(F.aggregate(F.col("words"), F.element_at("words", 1)["at"], lambda a, w: F.array_intersect(a, w["at"]))).cast("double")
    freq = F.when((F.col("slop") == 0) | (F.col("L") == 1), exact).otherwise(_sloppy_freq(F.col("words"), F.col("slop")))
    return (rows.withColumn("freq", freq).where(F.col("freq") > 0)
                .select("span", *CLAUSE_KEY, "doc_id",
                        (F.sqrt(F.col("freq")) * F.col("idf_sum") / F.sqrt(F.col("dl").cast("double"))).alias("raw")))
