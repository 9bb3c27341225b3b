"""Removal of lines that repeat earlier text, by overlapping windows of three lines; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakeops.llm.common import fresh_name
from lakeops.session import materialize

SPAN = 3


def _windows(docs: DataFrame, key: str, text: str, span: int) -> DataFrame:
    """One row per window of a document: its place (document, text, first line) and a 128-bit hash of its lines."""
    lines = docs.select(docs[key].alias("key"), F.xxhash64(docs[text]).alias("body"),
                        F.split(docs[text], "\n", -1).alias("lines")).filter(F.size("lines") >= span)

    def window(i: Column) -> Column:
        cells = [F.get("lines", i + k) for k in range(span)]
        return F.struct(i.alias("line"), F.xxhash64(*cells).alias("h1"), F.xxhash64(F.lit(span), *cells).alias("h2"),
                        (F.length(F.trim(F.concat(*cells))) > 0).alias("written"))

    return (lines.select("key", "body", F.explode(F.transform(F.sequence(F.lit(0), F.size("lines") - span), window))
                         .alias("w"))
            .filter("w.written")
            .select(F.struct("key", "body", F.col("w.line").alias("line")).alias("place"), "w.h1", "w.h2"))


def mark_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", span: int = SPAN) -> tuple[DataFrame, str]:
    """``docs`` with one more column, whose name is returned: the line numbers (from 0) that repeat earlier text,
    NULL where there are none.

    A window is ``span`` neighbouring lines, not all blank. Of equal windows the first stays: that of the smallest
    key (NULL first), then the earlier line. Lines inside any later one are marked, overlaps together, judged on the
    input. Documents with fewer lines have no window. Rows that repeat key and text are one document. The first
    places come from one pre-aggregated count of the hashes; only hashes seen more than once, written once, are
    joined back to the windows, and skewed-join handling splits a window that fills a third of them.
    """
    windows = _windows(docs, key, text, span)
    repeated = materialize(windows.groupBy("h1", "h2").agg(F.min("place").alias("first"), F.count("*").alias("n"))
                           .filter("n > 1").select("h1", "h2", "first"))
    later = windows.join(repeated.hint("merge"), ["h1", "h2"]).filter("place > first")
    starts = (later.groupBy(F.col("place.key").alias("_key"), F.col("place.body").alias("_body"))
              .agg(F.collect_set("place.line").alias("_starts")))
    marks = materialize(starts.select("_key", "_body", F.array_distinct(F.flatten(F.transform(
        "_starts", lambda s: F.sequence(s, s + (span - 1))))).alias("_lines")))
    name = fresh_name(docs, "repeats")
    # The marks' own names may clash with those of docs, so they are made unlike them.
    names = {c: fresh_name(docs, c) for c in ("_key", "_body")}
    marks = marks.select(F.col("_key").alias(names["_key"]), F.col("_body").alias(names["_body"]),
                         F.col("_lines").alias(name))
    # The marks grow with the table, so the join is a shuffled one at every size.
    joined = docs.join(marks.hint("merge"), docs[key].eqNullSafe(marks[names["_key"]])
                       & (F.xxhash64(docs[text]) == marks[names["_body"]]), "left")
    return joined.select(*[docs[f"`{c}`"] for c in docs.columns], marks[name]), name


def _kept(text: Column, repeats: Column) -> Column:
    """The text without the marked lines."""
    lines = F.split(text, "\n", -1)
    places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), repeats)
    return F.when(repeats.isNull(), text).otherwise(
        F.array_join(F.transform(places, lambda i: F.get(lines, i)), "\n"))


def drop_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with the repeated lines taken out of the text; same rows and columns."""
    marked, name = mark_repeats(docs, key, text, **options)
    return marked.select(*[_kept(marked[text], marked[name]).alias(c) if c == text else marked[f"`{c}`"]
                           for c in docs.columns])


def report(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Per row: key, n_lines, n_removed, kept_sha256 (of the text left; of the empty text where it is NULL)."""
    marked, name = mark_repeats(docs.select(docs[key].alias(key), docs[text].alias(text)), key, text, **options)
    kept = F.coalesce(_kept(marked[text], marked[name]), F.lit(""))
    return marked.select(
        key, F.coalesce(F.size(F.split(text, "\n", -1)), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size(name), F.lit(0)).cast("long").alias("n_removed"), F.sha2(kept, 256).alias("kept_sha256"))


REPORT_SQL = """
    WITH docs AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
    windows AS (
        SELECT doc_id, line, lines[line + 1] || chr(10) || lines[line + 2] || chr(10) || lines[line + 3] AS body
        FROM (SELECT doc_id, lines, unnest(range(len(lines) - 2)) AS line FROM docs)
        WHERE trim(lines[line + 1] || lines[line + 2] || lines[line + 3]) <> ''),
    placed AS (
        SELECT doc_id, line, row_number() OVER (PARTITION BY body ORDER BY doc_id, line) AS place FROM windows),
    removed AS (
        SELECT DISTINCT doc_id, line + step AS line
        FROM placed CROSS JOIN (SELECT unnest([0, 1, 2]) AS step) WHERE place > 1),
    every AS (SELECT doc_id, unnest(lines) AS body, unnest(range(len(lines))) AS line FROM docs)
    SELECT e.doc_id, count(*) AS n_lines, count(r.line) AS n_removed,
           sha256(coalesce(string_agg(e.body, chr(10) ORDER BY e.line) FILTER (WHERE r.line IS NULL), ''))
               AS kept_sha256
    FROM every e LEFT JOIN removed r ON r.doc_id = e.doc_id AND r.line = e.line
    GROUP BY e.doc_id"""
