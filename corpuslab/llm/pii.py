"""Personal data by anchor expansion.

One Aho-Corasick pass over a whole text finds anchors: at-signs, plus signs, digits, address schemes and identifier
cues. From every anchor a small deterministic parser expands to the boundaries of the item and validates it. Five kinds
are searched independently of each other; inside a kind the leftmost match wins and matches do not overlap.

``email ip card phone`` follow fixed patterns and checks. The method adds ``address`` (an address with login data,
``scheme://user:secret@host``, or a ``mailto:`` target) and ``account`` (the identifier after a cue such as IBAN,
account no., passport; an IBAN must pass its check digits, other identifiers need six digits).

Offsets are code points, ends exclusive. Rows are independent: nothing is shuffled and memory is one batch of texts.

Edge cases: null and empty texts have no spans; a text of any length is scanned whole; repeated rows repeat their
result; null ids are kept; other columns stay as they are, a column named like the output is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

# Kinds in output order, boundaries of the four base kinds.
KINDS = ["email", "ip", "card", "phone", "address", "account"]
BASE_KINDS = KINDS[:4]
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
QUAD = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Cues and schemes.
CUES = ["iban", "account", "acct", "konto", "kontonummer", "cuenta", "compte", "passport", "ssn", "sort code", "routing"]
SCHEMES = ["http://", "https://", "ftp://", "sftp://", "ssh://", "postgres://", "mysql://", "redis://", "mailto:"]
AFTER_CUE = re.compile(r"(?:[\x20]?(?:no|nr|number|id|num|n°)\b\.?)?[\x20:#=.]{0,4}", re.I)
IDENTIFIER = re.compile(r"[A-Z0-9]+(?:[\x20-][A-Z0-9]{2,})*")
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
LOGIN = re.compile(r"[^\s/@:\"'<>]+(?::[^\s/@\"'<>]*)?@[A-Za-z0-9.-]+(?::[0-9]+)?(?:/[^\s\"'<>]*)?")

SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
SPANS_TYPE = "array<struct<kind: string, start: bigint, end: bigint>>"
Span = tuple[int, int, int]  # start, number of the kind, end


def luhn(digits: str) -> bool:
    total = 0
    for at, d in enumerate(reversed(digits)):
        n = int(d)
        if at % 2:
            n = 2 * n - 9 * (n > 4)
        total += n
    return total % 10 == 0


def iban_ok(compact: str) -> bool:
    return int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97 == 1


def build_anchors() -> ahocorasick.Automaton:
    anchors = ahocorasick.Automaton()
    for ch in "0123456789":
        anchors.add_word(ch, ("digit", 1))
    anchors.add_word("@", ("at", 1))
    anchors.add_word("+", ("plus", 1))
    for kind, words in (("scheme", SCHEMES), ("cue", CUES)):
        for word in words:
            for form in {word, word.upper(), word.capitalize()}:
                anchors.add_word(form, (kind, len(form)))
    anchors.make_automaton()
    return anchors


def expand_email(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """Local part to the left (not below ``floor``), dotted labels to the right."""
    start = at
    while start > floor and text[start - 1] in LOCAL:
        start -= 1
    right = DOMAIN.match(text, at + 1) if start < at else None
    return (start, right.end()) if right else None


def expand_account(text: str, start: int, end: int) -> tuple[int, int] | None:
    """Identifier after the cue ``text[start:end]``, which must be a word of its own."""
    if start and text[start - 1].isalnum() or end < len(text) and text[end].isalnum():
        return None
    at = AFTER_CUE.match(text, end).end()
    if at == end:  # something must separate cue and identifier
        return None
    found = IBAN.match(text, at)
    if found:
        compact = found.group().replace(" ", "")
        stop = found.end()
        while len(compact) >= 15:  # the identifier may be followed by capital words
            if iban_ok(compact):
                return at, stop
            compact = compact[:-1]
            stop = stop - 1 - (text[stop - 2] == " ")
    found = IDENTIFIER.match(text, at)
    if not found or sum(c.isdigit() for c in found.group()) < 6:
        return None
    if found.end() < len(text) and text[found.end()].isalnum():
        return None
    return at, found.end()


def spans_of(text: str, anchors: ahocorasick.Automaton) -> list[Span]:
    """All spans of one text, by start, then kind."""
    out: list[Span] = []
    ends = [0] * len(KINDS)  # end of the last match (kept or not) of each kind
    for last, (anchor, width) in anchors.iter(text):
        at = last - width + 1
        if anchor == "digit":
            if at >= ends[1] and not (at and "0" <= text[at - 1] <= "9" and at - 1 >= ends[1]):
                found = QUAD.match(text, at)
                if found:
                    ends[1] = found.end()
                    if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in found.groups()):
                        out.append((at, 1, found.end()))
            if at >= ends[2]:
                found = CARD.match(text, at)
                if found:
                    ends[2] = found.end()
                    digits = found.group().replace(" ", "").replace("-", "")
                    if 12 <= len(digits) <= 19 and luhn(digits):
                        out.append((at, 2, found.end()))
        elif anchor == "at":
            if at >= ends[0] and (hit := expand_email(text, at, ends[0])):
                ends[0] = hit[1]
                out.append((hit[0], 0, hit[1]))
        elif anchor == "plus":
            if at >= ends[3] and (found := PHONE.match(text, at)):
                ends[3] = found.end()
                if 9 <= sum("0" <= c <= "9" for c in found.group()) <= 15:
                    out.append((at, 3, found.end()))
        elif anchor == "scheme":
            if at >= ends[4] and (found := LOGIN.match(text, last + 1)):
                ends[4] = found.end()
                out.append((at, 4, found.end()))
        elif at >= ends[5] and (hit := expand_account(text, at, last + 1)):
            ends[5] = hit[1]
            out.append((hit[0], 5, hit[1]))
    out.sort()
    return out


def with_spans(docs: DataFrame, text: str = "text", out: str = "spans") -> DataFrame:
    """Adds the array of spans (``kind, start, end``) of every whole text."""

    @arrow_udf(SPANS_TYPE)
    def find(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        anchors = build_anchors()
        for column in columns:
            rows = [spans_of(t, anchors) if t else [] for t in column.to_pylist()]
            named = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in row] for row in rows]
            yield pa.array(named, pa.list_(SPAN))

    # evaluated once, whatever later steps do with the result
    return docs.withColumn(out, find.asNondeterministic()(F.col(text)))


def redacted(text: Column, spans: Column) -> Column:
    """The text with each stretch of (overlapping) spans replaced by its first kind in brackets."""
    text = F.coalesce(text, F.lit(""))
    start = F.struct(F.lit("").alias("done"), F.lit(0).cast("bigint").alias("at"))
    piece = lambda acc, s: F.when(
        s["start"] >= acc["at"],
        F.struct(
            F.concat(acc["done"], F.substr(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")),
                     F.lit("["), s["kind"], F.lit("]")).alias("done"),
            s["end"].alias("at"),
        ),
    ).otherwise(F.struct(acc["done"].alias("done"), F.greatest(acc["at"], s["end"]).alias("at")))
    rest = lambda acc: F.concat(acc["done"], F.substr(text, (acc["at"] + 1).cast("int"), F.length(text)))
    return F.aggregate(spans, start, piece, rest)


def pii_digests(docs: DataFrame) -> DataFrame:
    """The contract's rows: counts of the base kinds, checksum of the base spans, all spans."""
    found = with_spans(docs.select("doc_id", "text")).select("doc_id", "spans")
    base = F.filter("spans", lambda s: s["kind"].isin(BASE_KINDS))
    joined = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[count(k) for k in BASE_KINDS], F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
