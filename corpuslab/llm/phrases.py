"""Phrase collocation mining with the stripes pattern.

A stripe is the associative counter of next words behind one prefix. Level ``k`` (0 to 3) has prefixes of ``k`` words:

1. Tasks hash the words of whole texts in numpy and reduce a few megabytes of text at a time to stripes. A prefix's
   stripe travels as eight sub-stripes (by the next word's hash), so a very frequent prefix is spread over tasks.
2. Stripes are shuffled as they are and merged elementwise: counts of the same next word are added by a hash aggregate.
3. Entries that reach the least count are the phrases of ``k + 1`` words. Level 0 also gives the totals per language.

A phrase cannot be frequent unless the phrases without its last and without its first word are, so a level skips all
occurrences whose parts were dropped before. Tasks test that with a bitmap of fixed size (8 MB, ``BITMAP_BITS``) of the
hashes of the level below; a false positive costs work, never a result.

Counts of parts come from the same stripes, and so do the subsumption maxima: a phrase lies inside a longer one that
reaches a share of its count exactly when it does so inside one that is one word longer, as counts fall with length.

Words are counted by name on level 0 and by 64-bit hash (language included) above it.

Edge cases: null text counts as empty, null lang as ``und``; texts of any length are worked through in slices cut at
piece ends; repeated rows and ids count as often as they occur; ties end with the phrase; an empty table gives an empty
result; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslab.llm.common import mix
from corpuslab.operators.ordering import top_per_group
from corpuslab.session import written_table

UNKNOWN = "und"
SEPARATORS = b".,;:!?\n\x0b\x0c\r"  # fixed values: what ends a piece
BLANKS = b" \t"
SLICE = 2 << 20  # bytes of text worked on at once
ROWS = 256  # rows turned into Python objects at once
ENTRIES = 1 << 19  # stripe entries held before they are sent
PARTS_SHIFT = 61  # the upper three bits of a word's hash choose the sub-stripe
BITMAP_BITS = 26
LONG_WORD = 64
MIXER = np.uint64(0x9E3779B97F4A7C15)

_CLASS = np.zeros(256, np.uint8)
_CLASS[list(BLANKS)] = 1
_CLASS[list(SEPARATORS)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# -- words of a slice --------------------------------------------------------------------------------------------

def text_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], list[bytes]]]:
    """Languages and texts of about ``SLICE`` bytes; a longer text is cut behind a piece."""
    langs, texts, size = [], [], 0
    for batch in batches:
        rows = (row for at in range(0, batch.num_rows, ROWS) for row in zip(*(c.to_pylist() for c in batch.slice(at, ROWS).columns)))
        for lang, text in rows:
            while text:
                cut = len(text)
                if cut > SLICE:
                    last = max(text.rfind(bytes([s]), 0, SLICE) for s in SEPARATORS)
                    if last < 0:
                        nexts = [text.find(bytes([s]), SLICE) for s in SEPARATORS]
                        last = min((p for p in nexts if p >= 0), default=len(text) - 1)
                    cut = last + 1
                langs.append(lang)
                texts.append(text[:cut])
                size += cut
                text = text[cut:]
                if size >= SLICE:
                    yield langs, texts
                    langs, texts, size = [], [], 0
    if texts:
        yield langs, texts


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every span of bytes: eight bytes a round, long spans one by one."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    length = ends - starts
    total = mix(length.astype(np.uint64) + MIXER)
    at = 0
    todo = np.flatnonzero(length <= LONG_WORD)
    while len(todo):
        left = np.minimum(length[todo] - at, 8).astype(np.uint64)
        mask = np.where(left == 8, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << (left * np.uint64(8))) - np.uint64(1))
        total[todo] = mix(total[todo] * MIXER + (eights[starts[todo] + at] & mask))
        at += 8
        todo = todo[length[todo] > at]
    for i in np.flatnonzero(length > LONG_WORD):
        total[i] = xxhash.xxh64_intdigest(data[starts[i]:ends[i]].tobytes())
    return total


def lang_seed(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode("utf-8"), 1)


class Words:
    """Words of a slice: ``ids`` (hash with language), ``piece`` numbers, and where they lie in ``data``."""

    def __init__(self, langs: list[str], texts: list[bytes]):
        self.data = _LOWER[np.frombuffer(b"\n".join(texts), np.uint8)]
        kind = _CLASS[self.data]
        inside = np.concatenate([[False], kind == 0, [False]])
        self.starts = np.flatnonzero(inside[1:-1] & ~inside[:-2])
        self.ends = np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
        self.piece = np.cumsum(kind == 2)[self.starts]
        begin = np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]
        self.doc = np.searchsorted(begin, self.starts, "right") - 1
        seeds = np.array([lang_seed(lang) for lang in langs], np.uint64)
        self.ids = mix(hash_spans(self.data, self.starts, self.ends) ^ seeds[self.doc])


def joined_id(prefix: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Hash of a phrase from its prefix and its last word; order counts."""
    return mix(prefix * MIXER + following + np.uint64(1))


def grams(ids: np.ndarray, m: int) -> np.ndarray:
    """Hash of the ``m`` words from each position on."""
    out = ids[:max(0, len(ids) - m + 1)]
    for j in range(1, m):
        out = joined_id(out, ids[j:len(ids) - m + 1 + j])
    return out


# -- bitmaps -----------------------------------------------------------------------------------------------------

def _cell(ids: np.ndarray, bits: int) -> np.ndarray:
    return mix(ids ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(64 - bits)


def bitmap(phrases: DataFrame, id_col: str = "id", bits: int | None = None) -> np.ndarray:
    """Bitmap of the hashes in ``id_col``, ``2 ** bits`` (``BITMAP_BITS``) bits whatever the number of rows."""
    bits = bits or BITMAP_BITS

    def cells(batches):
        for batch in batches:
            cell = np.unique(_cell(batch.column(0).to_numpy().view(np.uint64), bits)).astype(np.int64)
            yield pa.record_batch([pa.array(cell >> 6), pa.array(np.int64(1) << (cell & 63))], names=["slot", "bits"])

    found = phrases.select(id_col).mapInArrow(cells, "slot long, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits"))
    rows = found.toArrow()
    words = np.zeros(1 << (bits - 6), np.int64)
    words[rows.column("slot").to_numpy()] = rows.column("bits").to_numpy()
    return words


def held(words: np.ndarray, ids: np.ndarray, bits: int | None = None) -> np.ndarray:
    cell = _cell(ids, bits or BITMAP_BITS).astype(np.int64)
    return (words[cell >> 6] >> (cell & 63)) & 1 == 1


# -- stripes -----------------------------------------------------------------------------------------------------

def word_counts(texts: DataFrame) -> DataFrame:
    """``lang, word, f``: the stripe of the empty prefix. ``texts`` has ``lang`` and ``text`` as bytes."""

    def count(batches):
        for langs, parts in text_slices(batches):
            w = Words(langs, parts)
            _, first, n = np.unique(w.ids, return_index=True, return_counts=True)
            names = [w.data[a:b].tobytes() for a, b in zip(w.starts[first], w.ends[first])]
            yield pa.record_batch(
                [pa.array([langs[d] for d in w.doc[first]], pa.string()),
                 pa.array(names, pa.binary()).cast(pa.string()), pa.array(n, pa.int64())],
                names=["lang", "word", "f"])

    return texts.mapInArrow(count, "lang string, word string, f long").groupBy("lang", "word").agg(F.sum("f").alias("f"))


def _merged(parts: list[tuple]) -> tuple:
    """Sum of several (phrase, prefix, next, count) tables."""
    phrase, prefix, following, n = (np.concatenate(c) for c in zip(*parts))
    _, first, place = np.unique(phrase, return_index=True, return_inverse=True)
    return phrase[first], prefix[first], following[first], np.bincount(place, weights=n).astype(np.int64)


def _stripe_batch(phrase: np.ndarray, prefix: np.ndarray, following: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    part = (following >> np.uint64(PARTS_SHIFT)).astype(np.int32)
    order = np.lexsort((part, prefix))
    prefix, part, following, n = prefix[order], part[order], following[order], n[order]
    new = np.flatnonzero(np.concatenate([[True], (prefix[1:] != prefix[:-1]) | (part[1:] != part[:-1])]))
    offsets = pa.array(np.append(new, len(n)).astype(np.int32))
    return pa.record_batch(
        [pa.array(prefix[new].view(np.int64)), pa.array(part[new]),
         pa.ListArray.from_arrays(offsets, pa.array(following.view(np.int64))),
         pa.ListArray.from_arrays(offsets, pa.array(n))],
        names=["prefix", "part", "nexts", "counts"])


def stripes(texts: DataFrame, words: int, below: Broadcast) -> DataFrame:
    """Stripes of the prefixes of ``words`` words: ``prefix, part, nexts, counts``, several per prefix.

    ``below`` is the bitmap of the phrases of ``words`` words; only occurrences whose prefix and suffix are in it count.
    """
    def collect(batches):
        pending, size = [], 0
        known = below.value
        for langs, parts in text_slices(batches):
            w = Words(langs, parts)
            ids = w.ids
            if len(ids) <= words:
                continue
            short = grams(ids, words)
            good = held(known, short)
            at = np.flatnonzero(good[:-1] & good[1:] & (w.piece[:-words] == w.piece[words:]))
            prefix, following = short[at], ids[at + words]
            phrase, first, n = np.unique(joined_id(prefix, following), return_index=True, return_counts=True)
            if not len(phrase):
                continue
            pending.append((phrase, prefix[first], following[first], n))
            size += len(phrase)
            if size >= ENTRIES:
                pending = [_merged(pending)]
                size = len(pending[0][0])
                if size >= ENTRIES // 2:
                    yield _stripe_batch(*pending[0])
                    pending, size = [], 0
        if pending:
            yield _stripe_batch(*_merged(pending))

    return texts.mapInArrow(collect, "prefix long, part int, nexts array<long>, counts array<long>")


def merge_stripes(parts: DataFrame, least: int) -> DataFrame:
    """``id, prefix, next, f`` of the entries that reach ``least`` after all stripes of a prefix are added."""
    entries = parts.repartition("prefix", "part").select(
        "prefix", "part", F.inline(F.arrays_zip("nexts", "counts"))).groupBy("prefix", "part", "nexts")
    kept = entries.agg(F.sum("counts").alias("f")).filter(F.col("f") >= least)

    def name(batches):
        for batch in batches:
            prefix, following = (batch.column(i).to_numpy().view(np.uint64) for i in (0, 1))
            yield pa.record_batch(
                [pa.array(joined_id(prefix, following).view(np.int64)), *batch.columns], names=["id", "prefix", "next", "f"])

    return kept.select("prefix", F.col("nexts").alias("next"), "f").mapInArrow(name, "id long, prefix long, next long, f long")


def with_word_ids(words: DataFrame) -> DataFrame:
    """Adds the hash that stripes use for a word of a language."""

    def name(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            parts = [w.encode("utf-8") for w in batch.column(1).to_pylist()]
            ends = np.cumsum([len(p) for p in parts])
            seeds = np.array([lang_seed(lang) for lang in batch.column(0).to_pylist()], np.uint64)
            data = np.frombuffer(b"".join(parts), np.uint8)
            ids = mix(hash_spans(data, np.append(0, ends[:-1]), ends) ^ seeds)
            yield pa.record_batch([*batch.columns, pa.array(ids.view(np.int64))], names=["lang", "phrase", "f", "id"])

    return words.select("lang", "word", "f").mapInArrow(name, "lang string, phrase string, f long, id long")


# -- phrases -----------------------------------------------------------------------------------------------------

def frequent_phrases(docs: DataFrame, least: int, longest: int, text: str = "text", lang: str = "lang") -> tuple[list[DataFrame], DataFrame]:
    """Per length the table ``lang, phrase, f, id`` of phrases with at least ``least`` occurrences, and ``lang, n``."""
    context = docs.sparkSession.sparkContext
    texts = docs.select(
        F.coalesce(F.col(lang), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    counts = written_table(word_counts(texts), "phrases-words")
    totals = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    levels = [written_table(with_word_ids(counts.filter(F.col("f") >= least)), "phrases-1")]
    last_words = levels[0].select(F.col("id").alias("next"), F.col("phrase").alias("_word"))
    for words in range(1, longest):
        below = context.broadcast(bitmap(levels[-1]))
        kept = written_table(merge_stripes(stripes(texts, words, below), least), f"phrases-stripes-{words}")
        below.destroy()
        before = levels[-1].select("lang", F.col("phrase").alias("_prefix"), F.col("id").alias("prefix"))
        named = kept.join(before, "prefix").join(last_words, "next").select(
            "lang", F.concat_ws(" ", "_prefix", "_word").alias("phrase"), "f", "id")
        levels.append(written_table(named, f"phrases-{words + 1}"))
    return levels, totals


def _whole(c: Column) -> Column:
    return c.cast("decimal(38,0)")


def scored(levels: list[DataFrame]) -> DataFrame:
    """``lang, phrase, a, l, r, score``: the lowest-scoring cut of every phrase of two or more words."""
    counts = levels[0].select("lang", "phrase", "f")
    for level in levels[1:]:
        counts = counts.unionByName(level.select("lang", "phrase", "f"))
    words = F.split("phrase", " ")
    cuts = counts.filter(F.instr("phrase", " ") > 0).select(
        "lang", "phrase", F.col("f").alias("a"), words.alias("w"), F.explode(F.sequence(F.lit(1), F.size(words) - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("_left"),
                       F.array_join(F.slice("w", F.col("k") + 1, F.size("w")), " ").alias("_right"))
    left = counts.select("lang", F.col("phrase").alias("_left"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("_right"), F.col("f").alias("r"))
    both = cuts.join(left, ["lang", "_left"]).join(right, ["lang", "_right"])
    score = F.call_function("div", _whole(F.lit(2_000_000)) * _whole(F.col("a")), _whole(F.col("l")) + _whole(F.col("r")))
    best = F.min(F.struct(score.cast("long").alias("score"), "k", "l", "r")).alias("_best")
    return both.groupBy("lang", "phrase", "a").agg(best).select("lang", "phrase", "a", "_best.l", "_best.r", "_best.score")


def subsumption_maxima(levels: list[DataFrame]) -> DataFrame:
    """``lang, phrase, longer``: largest count of the phrases that are longer by one word at either end."""
    longer = levels[2].select("lang", "phrase", "f")
    for level in levels[3:]:
        longer = longer.unionByName(level.select("lang", "phrase", "f"))
    inner = F.array(F.regexp_extract("phrase", r"(?s)\A(.*) [^ ]*\z", 1), F.regexp_extract("phrase", r"(?s)\A[^ ]* (.*)\z", 1))
    return longer.select("lang", F.explode(inner).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))


def mine_phrases(
    docs: DataFrame, most: int = 2000, least: int = 30, longest: int = 4, share: int = 80, text: str = "text", lang: str = "lang"
) -> DataFrame:
    """The best ``most`` phrases of every language: ``lang, rank, phrase, a, l, r, n, score``.

    A phrase has 2 to ``longest`` (3 at least) words and ``a >= least`` occurrences; the score is 1,000,000 times the
    Dice coefficient of its weakest cut, rounded down. Phrases inside a longer one with ``share`` percent of their
    occurrences are dropped.
    """
    levels, totals = frequent_phrases(docs, least, longest, text, lang)
    found = scored(levels).join(subsumption_maxima(levels), ["lang", "phrase"], "left")
    kept = found.filter(F.col("longer").isNull() | (_whole(F.col("longer")) * 100 < _whole(F.col("a")) * share)).join(totals, "lang")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    ranked = top_per_group(kept, ["lang"], order, F.lit(most), most, ["phrase"])
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
           FROM documents),
w AS (SELECT lang, [x FOR x IN string_split_regex(piece, '[\x20\x09]+') IF x <> ''] AS ws FROM p),
g AS (SELECT lang, m, unnest([array_to_string(ws[i:i + m - 1], ' ') FOR i IN generate_series(1, len(ws) - m + 1)]) AS phrase
      FROM w CROSS JOIN (VALUES (1), (2), (3), (4)) t(m)),
f AS (SELECT lang, m, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE m >= 2 AND f >= 30),
k AS (SELECT lang, m, phrase, a, ws, unnest(generate_series(1, m - 1)) AS k FROM c),
s AS (SELECT k.lang, k.m, k.phrase, k.a, k.k, l.f AS l, r.f AS r, 2000000::HUGEINT * k.a // (l.f + r.f) AS score
      FROM k JOIN f l ON l.lang = k.lang AND l.phrase = array_to_string(k.ws[1:k.k], ' ')
             JOIN f r ON r.lang = k.lang AND r.phrase = array_to_string(k.ws[k.k + 1:], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
x AS (SELECT b.* FROM b WHERE NOT EXISTS (
        SELECT 1 FROM c WHERE c.lang = b.lang AND c.m > b.m AND 100 * c.a >= 80 * b.a
        AND contains(' ' || c.phrase || ' ', ' ' || b.phrase || ' ')))
SELECT x.lang, row_number() OVER (PARTITION BY x.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM x JOIN n ON n.lang = x.lang
QUALIFY rank <= 2000
"""
