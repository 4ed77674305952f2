"""Lines that many documents share stay in the last document only.  Native expressions only.

Lines are keyed by 128 hash bits.  The hashes are range-partitioned together with a salt
taken from the document, and sorted inside each partition by document and position, so the
first row of each run is a document's first occurrence; those rows alone are counted per
key.  A key that a third of all documents hold is spread over ``SALTS`` ranges and reaches
the count as at most one row per document, combined before it is shuffled.  What returns to
the documents is one run-length compressed keep bitmap each, not text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickscore.llm.frames import BLANKS, let, lower_ascii, stored

SALTS = 64


def lines_of(text: Column) -> Column:
    """The lines between line feeds; NULL and '' hold one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def occurrences(docs: DataFrame, min_chars: int) -> DataFrame:
    """One row per line with a long enough key: document, position, hash and salt."""
    lines = docs.select(
        F.col("doc_id").alias("doc"),
        F.xxhash64("text").alias("row_hash"),
        F.posexplode(lines_of(F.col("text"))).alias("pos", "line"),
    )
    keyed = lines.select("doc", "row_hash", "pos", line_key(F.col("line")).alias("key"))
    return keyed.filter(F.char_length("key") >= min_chars).select(
        "doc", "row_hash", "pos",
        F.xxhash64("key").alias("h1"),
        F.xxhash64(F.lit(7), "key").alias("h2"),
        F.pmod(F.xxhash64("doc"), F.lit(SALTS)).cast("int").alias("salt"),
    )


def shared_keys(rows: DataFrame, min_docs: int) -> DataFrame:
    """Hashes held by ``min_docs`` documents or more, with the largest doc_id holding each."""
    ranged = rows.repartitionByRange("h1", "h2", "salt")
    order = W.partitionBy("h1", "h2", "salt").orderBy(F.col("doc").desc(), "pos")
    first = ranged.select(
        "h1", "h2", "doc", F.row_number().over(order).alias("n"), F.lag("doc").over(order).alias("before")
    ).filter((F.col("n") == 1) | ~F.col("doc").eqNullSafe(F.col("before")))
    return (
        first.groupBy("h1", "h2")
        .agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc").alias("last_doc"))
        .filter(F.col("n_docs") >= min_docs)
    )


def keep_runs(dropped: Column, n_lines: Column) -> Column:
    """The keep bitmap as runs ``(start, length)`` of kept lines, from sorted positions."""
    edges = F.concat(F.array(F.lit(-1)), dropped, F.array(n_lines))
    return let(
        edges,
        lambda e: F.filter(
            F.transform(
                F.sequence(F.lit(0), F.size(e) - 2),
                lambda i: F.struct(
                    (e[i] + 1).alias("start"), (e[i + 1] - e[i] - 1).alias("length")
                ),
            ),
            lambda r: r["length"] > 0,
        ),
    )


def keep_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``docs`` with ``n_lines``, ``n_dropped`` and the keep bitmap ``kept_runs``.

    A line's key is the line without outer white space, A-Z lower-cased.  A key of at least
    ``min_chars`` code points in at least ``min_docs`` documents loses all its lines except
    those in the largest doc_id holding it.

    NULL and empty texts have one line, which is kept.  Rows that repeat a doc_id count as
    one document for the limit and are cut alike; a NULL doc_id is a document smaller than
    all others.  NULL in other columns has no effect; other columns pass through, whatever
    their names.  An empty table gives an empty result.  Texts of any length are read whole.
    """
    rows = occurrences(docs, min_chars)
    dropped = (
        rows.join(stored(shared_keys(rows, min_docs), "shared-lines"), ["h1", "h2"])
        .filter(~F.col("doc").eqNullSafe(F.col("last_doc")))
        .groupBy("doc", "row_hash")
        .agg(F.sort_array(F.collect_set("pos")).alias("dropped_at"))
    )
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.xxhash64("text").alias("hash"))
    at = F.coalesce(F.col("dropped_at"), F.array().cast("array<int>"))
    n_lines = F.size(lines_of(F.col("row.text")))
    return whole.join(
        dropped,
        F.col("row.doc_id").eqNullSafe(F.col("doc")) & (F.col("hash") == F.col("row_hash")),
        "left",
    ).select(
        "row",
        n_lines.cast("long").alias("n_lines"),
        F.size(at).cast("long").alias("n_dropped"),
        F.when(F.size(at) > 0, keep_runs(at, n_lines)).alias("kept_runs"),
    )


def kept_text(text: Column, kept_runs: Column) -> Column:
    """The kept lines joined by line feeds; ``kept_runs`` NULL keeps the text as it is."""
    cut = let(
        lines_of(text),
        lambda ls: F.concat_ws(
            "\n", F.flatten(F.transform(kept_runs, lambda r: F.slice(ls, r["start"] + 1, r["length"])))
        ),
    )
    return F.when(kept_runs.isNull(), F.coalesce(text, F.lit(""))).otherwise(cut)


def op2(docs: DataFrame) -> DataFrame:
    text = kept_text(F.col("row.text"), F.col("kept_runs"))
    return keep_bitmaps(docs).select(
        F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2(text, 256).alias("kept_sha256")
    )


SQL = """
WITH split AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), lines AS (
    SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM split
), keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
), shared AS (
    SELECT key, max(doc_id) AS last_doc FROM keyed WHERE length(key) >= 20
    GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
    SELECT k.doc_id, k.pos, k.line, s.key IS NOT NULL AND k.doc_id <> s.last_doc AS gone
    FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
