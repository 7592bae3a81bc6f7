"""Line deduplication by content-defined chunks, with built-in DataFrame functions only.

A polynomial hash rolls over the hashes of ``WINDOW`` consecutive lines; where it is divisible by ``DIVISOR`` a chunk
ends. Boundaries depend on the neighbouring lines alone, so a passage that is shifted by inserted lines falls into the
same chunks again. A chunk of at least two lines that occurs more than once in all documents stays in its first place
(smallest doc_id, then chunk number) and goes everywhere else, after its bytes were compared with the first one.

Only chunk keys (digest, bytes, lines) are grouped, pre-aggregated per task; texts of chunks are moved only for repeated
ones. Hot keys meet in joins that adaptive execution splits, never in one group.

Edge cases: a null text stays null and has no lines, an empty one has one empty line; a text whose chunks all go becomes
empty; rows without doc_id come last in the order; rows of one doc_id (or without any) are told apart by the MD5 of their
text and ordered by it, and those that repeat a doc_id with its text keep or lose their chunks together; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslab.session import written_table

WINDOW = 3  # lines that decide on a boundary
DIVISOR = 4  # lines of a chunk on average
BASE = 31
LEAST_LINES = 2


def line_hash(line: Column) -> Column:
    """24 bits of the line's MD5."""
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 6), 16, 10).cast("bigint")


def boundaries(hashes: Column) -> Column:
    """Numbers of the lines that end a chunk; the last line always does."""
    roll = lambda i: sum((F.get(hashes, i - j) * BASE**j for j in range(1, WINDOW)), F.get(hashes, i))
    last = F.size(hashes) - 1
    return F.filter(F.sequence(F.lit(0), last), lambda i: (i == last) | ((i >= WINDOW - 1) & (roll(i) % DIVISOR == 0)))


def with_chunks(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, mark, lines, chunks``: ``mark`` tells texts of one doc_id apart; a chunk is ``no, start, n`` (0-based first
    line, lines)."""
    rows = docs.select("doc_id", F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))).alias("mark"), F.split(F.col(text), "\n", -1).alias("lines"))
    rows = rows.withColumn("hashes", F.transform("lines", line_hash))
    rows = rows.select("doc_id", "mark", "lines", boundaries(F.col("hashes")).alias("ends"))
    number = F.sequence(F.lit(0), F.size("ends") - 1)

    def chunk(c: Column) -> Column:
        start = F.when(c == 0, F.lit(0)).otherwise(F.get("ends", c - 1) + 1)
        return F.struct(c.alias("no"), start.alias("start"), (F.get("ends", c) - start + 1).alias("n"))

    return rows.select("doc_id", "mark", "lines", F.when(F.col("lines").isNotNull(), F.transform(number, chunk)).alias("chunks"))


def chunk_text(lines: Column, chunk: Column) -> Column:
    return F.array_join(F.slice(lines, chunk["start"] + 1, chunk["n"]), "\n")


def repeated_chunks(chunked: DataFrame) -> DataFrame:
    """``doc_id, mark, no, first_doc, first_mark, first_no``: every chunk of several lines that occurs elsewhere, bytes compared."""
    long_ones = F.filter("chunks", lambda c: c["n"] >= LEAST_LINES)

    def key(c: Column) -> Column:
        body = chunk_text(F.col("lines"), c)
        return F.struct(F.md5(body.cast("binary")).alias("digest"), F.octet_length(body).alias("bytes"), c["n"].alias("n"), c["no"].alias("no"))

    # no filter below the explode: it would be pushed through the projections and repeat the hashing for every line
    keyed = chunked.select("doc_id", "mark", F.explode_outer(F.transform(long_ones, key)).alias("k"))
    keyed = written_table(keyed.filter(F.col("k").isNotNull()).select("doc_id", "mark", "k.*"), "line-chunks")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark", "no")
    names = ["digest", "bytes", "n"]
    often = keyed.groupBy(*names).agg(F.count(F.lit(1)).alias("times"), F.min(place).alias("first")).filter("times > 1")
    often = often.select(*names, F.col("first.doc_id").alias("first_doc"), F.col("first.mark").alias("first_mark"), F.col("first.no").alias("first_no"))
    met = written_table(keyed.join(often, names), "line-repeats")

    # texts of the repeated chunks only; always the same kind of join, since repeats grow with the table
    asked = met.groupBy(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")).agg(F.collect_set("no").alias("asked"))  # a document's own chunks
    rows = chunked.join(asked.hint("merge"), _same("_id", "_mark"))
    named = F.transform("asked", lambda no: F.struct(
        no.alias("no"), chunk_text(F.col("lines"), F.get("chunks", no)).alias("body")))
    texts = rows.select("doc_id", "mark", F.explode_outer(named).alias("t")).select("doc_id", "mark", "t.no", "t.body")
    texts = written_table(texts.distinct(), "line-texts")
    own = texts.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), F.col("no").alias("_no"), "body")
    first = texts.select(F.col("doc_id").alias("_fid"), F.col("mark").alias("_fmark"), F.col("no").alias("_fno"), F.col("body").alias("first_body"))
    proven = met.join(own, _same("_id", "_mark") & (F.col("no") == F.col("_no"))).join(
        first, F.col("first_doc").eqNullSafe(F.col("_fid")) & (F.col("first_mark") == F.col("_fmark")) & (F.col("first_no") == F.col("_fno")))
    names = ["doc_id", "mark", "no", "first_doc", "first_mark", "first_no"]
    return proven.filter(F.col("body") == F.col("first_body")).select(*names)


def _same(key: str, mark: str) -> Column:
    return F.col("doc_id").eqNullSafe(F.col(key)) & (F.col("mark") == F.col(mark))


def dedup_lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, text, n_lines, n_chunks, removed_chunks, removed_lines`` of every row, ``text`` without repeats."""
    chunked = with_chunks(docs, text)
    later = repeated_chunks(chunked).filter(
        ~(_same("first_doc", "first_mark") & (F.col("no") == F.col("first_no"))))
    gone = later.groupBy(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")).agg(F.collect_set("no").alias("gone"))
    rows = chunked.join(gone.hint("merge"), _same("_id", "_mark"), "left")
    none = F.array().cast("array<int>")
    gone = F.coalesce("gone", none)
    dropped = F.filter("chunks", lambda c: F.array_contains(gone, c["no"]))
    kept = F.filter("chunks", lambda c: ~F.array_contains(gone, c["no"]))
    body = F.array_join(F.transform(kept, lambda c: chunk_text(F.col("lines"), c)), "\n")
    lines = F.aggregate(dropped, F.lit(0), lambda n, c: n + c["n"])
    return rows.select(
        "doc_id",
        F.when(F.size(gone) == 0, F.array_join("lines", "\n")).otherwise(body).alias("text"),
        F.coalesce(F.when(F.col("lines").isNotNull(), F.size("lines")), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.when(F.col("lines").isNotNull(), F.size("chunks")), F.lit(0)).cast("bigint").alias("n_chunks"),
        F.size(gone).cast("bigint").alias("removed_chunks"),
        F.coalesce(lines, F.lit(0)).cast("bigint").alias("removed_lines"),
    )


SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i,
         len(string_split(text, chr(10))) AS n_lines
  FROM documents WHERE text IS NOT NULL),
h AS (SELECT *, CAST('0x' || substr(md5(line), 1, 6) AS BIGINT) AS h FROM l),
b AS (SELECT *, i = n_lines OR (i >= 3 AND (h + 31 * lag(h, 1) OVER w + 961 * lag(h, 2) OVER w) % 4 = 0) AS ends
      FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
c AS (SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS no
      FROM b),
k AS (SELECT doc_id, no, any_value(n_lines) AS n_lines, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS body
      FROM c GROUP BY doc_id, no),
r AS (SELECT *, n >= 2 AND row_number() OVER (PARTITION BY body, n ORDER BY doc_id, no) > 1 AS gone FROM k)
SELECT d.doc_id,
       CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(string_agg(body, chr(10) ORDER BY no) FILTER (NOT gone), '') END AS text,
       coalesce(any_value(n_lines), 0)::BIGINT AS n_lines, count(no) AS n_chunks,
       count(*) FILTER (gone) AS removed_chunks, coalesce(sum(n) FILTER (gone), 0)::BIGINT AS removed_lines
FROM documents d LEFT JOIN r ON d.doc_id = r.doc_id GROUP BY d.doc_id, d.text
"""
