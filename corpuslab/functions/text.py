"""Text expressions: cleaning, prefixing and file-name derivation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and strings that decide results.
URL = r"https?://\S+"
CONTROLS = "".join(chr(c) for c in range(0x21))
UNICODE_SPACES = "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B)) + (
    "\u2028\u2029\u202f\u205f\u3000"
)
LINE_BREAKS = r"[\n\r]+"
BRACED = r"\A\{(.*)\}\z"
QUERY_PREFIX = "query: "
EMPTY_QUERY = "query: empty comment"
COMMENTS_SUFFIX = "_comments.json"
SAMPLE_RATE = 0.01


def strip_controls(c: Column) -> Column:
    """Remove every character up to U+0020 from both ends (SQL ``trim`` removes only blanks)."""
    return F.btrim(c, F.lit(CONTROLS))


def clean_comment(c: Column) -> Column:
    """Delete links, strip the ends, then fold each run of line breaks to one blank."""
    unlinked = F.when(F.contains(c, F.lit("://")), F.regexp_replace(c, URL, "")).otherwise(c)
    return F.regexp_replace(strip_controls(unlinked), LINE_BREAKS, " ")


def unwrap_braces(c: Column) -> Column:
    """``{text}`` becomes ``text``; anything else only loses its outer white space."""
    line = strip_controls(c)
    return F.when(line.rlike(BRACED), strip_controls(F.regexp_extract(line, BRACED, 1))).otherwise(line)


def prepare_comment(c: Column) -> Column:
    """Encoder input: Unicode-stripped text behind the query prefix."""
    text = F.btrim(F.coalesce(c, F.lit("")), F.lit(UNICODE_SPACES))
    return F.when(F.length(text) == 0, F.lit(EMPTY_QUERY)).otherwise(F.concat(F.lit(QUERY_PREFIX), text))


def squash_name(c: Column) -> Column:
    """Lower-case letters and digits only: the key used to compare file names."""
    return F.regexp_replace(F.lower(c), "[^a-z0-9]+", "")


def spaced_name(c: Column) -> Column:
    """Like :func:`squash_name`, but inner white space stays."""
    return strip_controls(F.regexp_replace(F.lower(c), r"[^a-z0-9\s]", ""))


def video_of_file(c: Column) -> Column:
    """``<video>_comments.json`` to ``<video>``; NULL for other names."""
    return F.nullif(F.regexp_extract(c, r"\A(.*)_comments\.json\z", 1), F.lit(""))


def txt_to_json_name(c: Column) -> Column:
    return F.regexp_replace(c, r"\.txt\z", ".json")


def embedding_base(c: Column) -> Column:
    """File stem without extension and without the ``_embeddings`` ending."""
    return F.regexp_replace(F.regexp_replace(c, r"\.[^.]*\z", ""), r"_embeddings\z", "")


def dedup_file_name(c: Column) -> Column:
    return F.replace(c, F.lit(".npz"), F.lit("_deduplicated.npz"))


def search_key(song: Column, artist: Column) -> Column:
    return F.format_string("%s %s", song, artist)


def sample_quota(n: Column, rate: float = SAMPLE_RATE) -> Column:
    """Rows to draw from ``n``: half-up rounding of ``rate * n``, at least one."""
    return F.greatest(F.lit(1).cast("bigint"), F.floor(n * F.lit(float(rate)) + F.lit(0.5)).cast("bigint"))
