"""Column-level text functions (all JVM-side, built-in functions).

Every function takes and returns ``Column`` objects so it can be used in any
``select``/``withColumn``/``where``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values ---------------------------------------------------------
# Word rule of the analyser (survey contract 2.9-a): letters, digits and
# underscore, with inner apostrophes, right single quotes and dots kept inside
# a token ("gerstmann's", "i.e", "3.5"); applied to lower-cased text; no
# stop-word list.
TOKEN_PATTERN = r"[\p{L}\p{N}_]+(?:['’.][\p{L}\p{N}_]+)*"
# Plain word rule used for the shingle judgements of the test binding.
WORD_PATTERN = r"[\p{L}\p{N}_]+"
# Characters deleted from query text before analysis.
QUERY_DELETE_CHARS = "()"
# Line limits of the file indexer's extra fields.
DEFAULT_TOP_LINES = 7
DEFAULT_BOTTOM_LINES = 2
# --------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def token_array(text, pattern: str = TOKEN_PATTERN) -> Column:
    """Lower-case ``text`` and return its tokens, in order, as ``array<string>``.
    A null text gives an empty array."""
    return F.coalesce(F.regexp_extract_all(F.lower(_col(text)), F.lit(pattern), 0),
                      F.array().cast("array<string>"))


def term_counts(tokens) -> Column:
    """``array<struct<term, tf>>`` of the distinct terms of a token array with
    their counts, ascending by term.

    Sorts the array once and measures the runs of equal neighbours, so a
    document's term frequencies are computed inside its own row: building
    postings needs no shuffle of the token stream.
    """
    tokens = _col(tokens)

    def with_sorted(s):
        n = F.size(s)
        starts = F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
                          lambda i: F.when(i == 1, F.lit(True))
                          .otherwise(F.element_at(s, i) != F.element_at(s, i - 1)))

        def with_starts(st):
            return F.transform(st, lambda x, j: F.struct(
                F.element_at(s, x).alias("term"),
                (F.coalesce(F.try_element_at(st, j + 2), n + 1) - x).cast("long").alias("tf")))

        counted = F.element_at(F.transform(F.array(starts), with_starts), 1)
        return F.when(n == 0, F.array().cast("array<struct<term:string,tf:bigint>>")).otherwise(counted)

    return F.element_at(F.transform(F.array(F.sort_array(tokens)), with_sorted), 1)


def term_places(tokens) -> Column:
    """``array<struct<term, tf, places>>`` of the distinct terms of a token
    array, ascending by term, with their counts and 0-based positions. As
    ``term_counts``, inside the row."""
    rows = F.sort_array(F.transform(_col(tokens), lambda t, i: F.struct(t.alias("term"), i.alias("place"))))

    def with_sorted(s):
        n = F.size(s)
        starts = F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
                          lambda i: F.when(i == 1, F.lit(True))
                          .otherwise(F.element_at(s, i)["term"] != F.element_at(s, i - 1)["term"]))

        def with_starts(st):
            def entry(x, j):
                count = F.coalesce(F.try_element_at(st, j + 2), n + 1) - x
                return F.struct(F.element_at(s, x)["term"].alias("term"), count.cast("long").alias("tf"),
                                F.transform(F.slice(s, x, count), lambda y: y["place"]).alias("places"))
            return F.transform(st, entry)

        kind = "array<struct<term:string,tf:bigint,places:array<int>>>"
        return F.when(n == 0, F.array().cast(kind)).otherwise(F.element_at(F.transform(F.array(starts), with_starts), 1))

    return F.element_at(F.transform(F.array(rows), with_sorted), 1)


def normalise_lines(text) -> Column:
    """Unify CR/LF and CR line ends to LF and drop one final line end, as a
    line reader joined with ``\\n`` would."""
    t = F.regexp_replace(F.regexp_replace(_col(text), "\r\n", "\n"), "\r", "\n")
    return F.regexp_replace(t, "\n$", "")


def _kept_lines(text):
    """Lines of ``text`` and how many remain once trailing blank lines are
    dropped (the split rule of the file indexer)."""
    lines = F.split(_col(text), "\n", -1)
    kept = F.coalesce(F.array_max(F.transform(
        lines, lambda x, i: F.when(x != "", i + 1).otherwise(F.lit(0)))), F.lit(0))
    return lines, kept


def top_lines(text, n: int = DEFAULT_TOP_LINES) -> Column:
    """First ``n`` lines joined with ``\\n``; ``n = 0`` gives ``''``."""
    lines, kept = _kept_lines(text)
    take = F.least(F.lit(n), kept)
    return F.when(_col(text).isNull(), None).otherwise(
        F.array_join(F.slice(lines, F.lit(1), take), "\n"))


def bottom_lines(text, n: int = DEFAULT_BOTTOM_LINES) -> Column:
    """Last ``n`` lines (trailing blank lines not counted) joined with ``\\n``."""
    lines, kept = _kept_lines(text)
    take = F.least(F.lit(n), kept)
    start = F.greatest(kept - take + 1, F.lit(1))
    return F.when(_col(text).isNull(), None).otherwise(
        F.array_join(F.slice(lines, start, take), "\n"))


def normalise_query(text) -> Column:
    """Lower-case and delete the grouping characters."""
    return F.translate(F.lower(_col(text)), QUERY_DELETE_CHARS, "")


def path_extension(path) -> Column:
    """Extension with the dot, from the last ``.`` of the file name; ``''``
    when the name has no dot."""
    name = F.regexp_extract(_col(path), r"([^/]*)$", 1)
    return F.regexp_extract(name, r"(\.[^.]*)$", 1)
