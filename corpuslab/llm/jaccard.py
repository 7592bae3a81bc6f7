"""N-gram Jaccard join with set-relation skipping.

Sets are the distinct ``k``-word shingles of whole texts. Two sets link when ``100 * |A and B| >= percent * |A or B|``.

1. Equal sets become one class (128-bit digest of the set); only class representatives are joined.
2. Shingles are ordered: those that are rare first, those found in many documents last, the most frequent at the very
   end. Any total order gives the same links; this one keeps widely shared passages out of the index. In that order two
   linked sets share at least ``s`` shingles of prefixes of length ``n - ceil(percent * n / 100) + s``, where ``s`` is
   ``common_part`` of the smaller set: an eighth of the set and at most ``SHARED``, so that the prefix of a short set does
   not reach into the passages that many documents share. Prefixes are the index lists.
3. Skipping inside index lists: an entry holds the position of the shingle in its set. A pair of entries whose
   positions or sizes rule out the needed overlap is skipped.
4. Skipping by answers: in every list the entries are first compared with one leader only. Sets that resemble a leader
   form a unit, whether they link with it or not, and their answers follow from the leader's:

   * A set that is in no unit, but shares enough lists with some members of one, is compared with its leader too and
     joins the unit if it resembles the leader.
   * Across units, whole units are compared through their leaders. As the Jaccard distance is a metric, the leaders'
     distance settles all members when it exceeds the units' radii and the threshold together. Where it does not, the
     smaller unit's members become guests of the larger one: they are compared with its leader, and with its members as below.
   * Inside a unit with leader ``o`` only differences are joined. With ``Dx = o - x`` and ``Ax = x - o``,
     ``|x & y| = |o| - |Dx| - |Dy| + |Dx & Dy| + |Ax & Ay|``. Two members that do not both link with ``o`` must
     therefore share so many of their (few) differences that a prefix of those, rarest first, finds them. Differences
     that only one member has are left out before prefixes are cut. So a group of near copies costs as much as its
     differences, not the square of its size.

Links that could join two components are all found; a link between two sets that both link with their unit's leader
need not be listed, since the result is the component of every document. Exact: sets are compared as 64-bit shingle hashes, everything else follows from them.

Edge cases: null and empty texts and texts without a word have no shingle and link with nothing (their component is
their own id); a text with fewer than ``k`` words is one shingle; repeated rows share class and component (an id may repeat
only with its text); a row without id shares the component of its class, if that has an id; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from corpuslab.llm.common import WordHashes, map_batches, mix, row_marked, shingle_hashes, split_words, text_bytes
from corpuslab.llm.graph import components
from corpuslab.session import written_table

SHARED = 12  # most shingles that linked sets must share inside their prefixes
SHARED_PART = 8  # of a set of n, n // SHARED_PART where that is less
ROWS = 1_000  # texts whose shingles a task holds together
BUFFER = 1 << 20  # shingles counted together inside a task
CARRIED = 1 << 18  # counts a task keeps between buffers
FREQUENT = 4  # times in a task
MOST_FREQUENT = 1 << 18  # shingles that are moved to the end
MARGIN = 1e-9
EXPECTED = 0.25  # share of the shorter prefix that a leader and a member have in common
ALIKE = 0.3  # least similarity of a unit's member to its leader
UNLINKED = 16  # members without a link to their leader that a unit may have before another one leads
BITMAP_BITS = 28  # power of two: at most 32 MB


def least_overlap(n: int, percent: int) -> int:
    """Smallest overlap of a linked partner of a set of ``n``."""
    return -(-percent * n // 100)


def common_part(n: int, percent: int) -> int:
    """Shingles that a set of ``n`` shares with a linked partner that is no smaller, inside their prefixes; never falls with ``n``."""
    return max(1, min(SHARED, least_overlap(n, percent), n // SHARED_PART))


def prefix_length(n: int, percent: int) -> int:
    return min(n, n - least_overlap(n, percent) + common_part(n, percent))


# -- sets and their order ----------------------------------------------------------------------------------------

def frequent_shingles(docs: DataFrame, k: int, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the shingles that occur in most documents, at most ``MOST_FREQUENT``, and their ranks, the most frequent last.

    Every task counts the shingles of its documents buffer by buffer, carries the repeated ones on (of ``CARRIED`` at most
    the most frequent) and passes on those it met ``FREQUENT`` times. A miss costs time, never a link.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, size = WordHashes(), [], 0
        values, times = np.empty(0, np.uint64), np.empty(0, np.int64)

        def merge() -> None:
            nonlocal values, times
            new = np.concatenate(held)
            merged, place = np.unique(np.concatenate([values, new]), return_inverse=True)
            total = np.bincount(place, np.concatenate([times, np.ones(len(new), np.int64)]), len(merged)).astype(np.int64)
            least = 2
            while (total >= least).sum() > CARRIED:
                least *= 2
            values, times = merged[total >= least], total[total >= least]

        for batch in batches:
            for data in batch.column(0).to_pylist():
                own = np.unique(shingle_hashes(hashes.of(split_words(data)), k))
                held.append(own)
                size += len(own)
                if size >= BUFFER:
                    merge()
                    held, size = [], 0
        if size:
            merge()
        often = times >= FREQUENT
        yield pa.RecordBatch.from_arrays([pa.array(values[often].view(np.int64)), pa.array(times[often])], ["s", "n"])

    counted = docs.select(text_bytes(text).alias("data")).mapInArrow(count, "s long, n long")
    top = counted.groupBy("s").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "s").limit(MOST_FREQUENT)
    found = top.toArrow()
    values, times = found.column("s").to_numpy().view(np.uint64), found.column("n").to_numpy()
    ranks = np.empty(len(values), np.int32)
    ranks[np.lexsort((values, times))] = np.arange(len(values), dtype=np.int32)
    order = np.argsort(values)
    return values[order], ranks[order]


def ordered(shingles: np.ndarray, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Sorted distinct shingles with the frequent ones moved to the end, by rank."""
    values, ranks = frequent
    if not len(values):
        return shingles
    at = np.minimum(np.searchsorted(values, shingles), len(values) - 1)
    often = values[at] == shingles
    return np.concatenate([shingles[~often], shingles[often][np.argsort(ranks[at[often]])]])


def set_rows(docs: DataFrame, k: int, percent: int, frequent: Broadcast, key: str, text: str) -> DataFrame:
    """``doc_id, n, d1, d2, prefix``: size, digest and index prefix of every document's set."""

    def work():
        hashes = WordHashes()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            sizes, first, second, prefixes = [], [], [], []
            for data in batch.column(1).to_pylist():
                own = np.unique(shingle_hashes(hashes.of(split_words(data)), k))
                sizes.append(len(own))
                first.append(int(mix(own + np.uint64(0x1234567)).sum(dtype=np.uint64).view(np.int64)))
                second.append(int(mix(own ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64).view(np.int64)))
                prefixes.append(ordered(own, frequent.value)[:prefix_length(len(own), percent)])
            ends = np.concatenate(([0], np.cumsum([len(p) for p in prefixes]))).astype(np.int32)
            flat = np.concatenate(prefixes).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64()), lists],
                ["doc_id", "n", "d1", "d2", "prefix"])

        return step

    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), text_bytes(text).alias("data"))
    return map_batches(rows, work, "doc_id long, n long, d1 long, d2 long, prefix array<long>", ROWS)


# -- filters -----------------------------------------------------------------------------------------------------

def common_column(n: Column, percent: int) -> Column:
    """``common_part`` of a size, or less."""
    overlap = F.ceil(n * percent / F.lit(100.0) - MARGIN)
    return F.greatest(F.lit(1), F.least(F.lit(SHARED), overlap, F.floor(n / SHARED_PART)))


def needed(n: Column, percent: int) -> Column:
    """Shingles that a set of ``n`` shares inside prefixes with any linked partner, smaller ones included."""
    return common_column(F.ceil(n * percent / F.lit(100.0) - MARGIN), percent)


def may_link(a: dict[str, Column], b: dict[str, Column], percent: int) -> Column:
    """Size and position bounds of two index entries, or of two groups of entries by their extremes.

    ``low, high``: sizes; ``before, after``: most shingles before and after the shared one.
    """
    sizes = (a["high"] * 100 >= b["low"] * percent) & (b["high"] * 100 >= a["low"] * percent)
    reach = F.least(a["before"], b["before"]) + 1 + F.least(a["after"], b["after"])
    return sizes & (reach * (100 + percent) >= (a["low"] + b["low"]) * percent)


def entry(prefix: str) -> dict[str, Column]:
    n, pos = F.col(f"{prefix}n"), F.col(f"{prefix}pos")
    return {"low": n, "high": n, "before": pos, "after": n - pos - 1}


def span(side: str) -> dict[str, Column]:
    return {c: F.col(f"{side}.{c}") for c in ("low", "high", "before", "after")}


# -- comparing sets ----------------------------------------------------------------------------------------------

def id_bitmap(ids: DataFrame, most_bits: int = BITMAP_BITS) -> np.ndarray:
    """A set of ids as a bitmap of hashes: no id is missed, few others pass. Its size is bounded by ``most_bits``."""
    bits = 1 << min(most_bits, max(6, (16 * ids.count()).bit_length()))
    place = F.pmod(F.xxhash64("id"), F.lit(bits))
    words = ids.select(F.shiftright(place, 6).cast("int").alias("w"), F.expr("1L").alias("one"), (place % 64).cast("int").alias("b"))
    words = words.groupBy("w").agg(F.bit_or(F.expr("shiftleft(one, b)")).alias("v")).toArrow()
    bitmap = np.zeros(bits // 64, np.int64)
    bitmap[words.column("w").to_numpy()] = words.column("v").to_numpy()
    return bitmap


def full_sets(docs: DataFrame, wanted: DataFrame, k: int, key: str, text: str) -> DataFrame:
    """``id, bag``: distinct shingle hashes of all wanted documents (and a few others); texts are not shuffled."""
    bitmap = docs.sparkSession.sparkContext.broadcast(id_bitmap(wanted.select("id")))
    place = F.xxhash64(F.col("id"))
    rows = docs.select(F.col(key).cast("bigint").alias("id"), text_bytes(text).alias("data")).select("id", "data", place.alias("h"))

    def work():
        hashes = WordHashes()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch | None:
            at = batch.column(2).to_numpy() & (len(bitmap.value) * 64 - 1)
            hit = np.flatnonzero(bitmap.value[at >> 6] >> (at & 63) & 1)
            if not len(hit):
                return None
            batch = batch.take(pa.array(hit))
            bags = [np.unique(shingle_hashes(hashes.of(split_words(d)), k)) for d in batch.column(1).to_pylist()]
            ends = np.concatenate(([0], np.cumsum([len(x) for x in bags]))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(bags).view(np.int64)))
            return pa.RecordBatch.from_arrays([batch.column(0), lists], ["id", "bag"])

        return step

    return map_batches(rows, work, "id long, bag array<long>", ROWS).filter("id IS NOT NULL")


def compare(pairs: DataFrame, bags: DataFrame) -> DataFrame:
    """``a, b, shared, joint``: sizes of intersection and union of distinct pairs, row by row in the JVM.

    Hints keep these sort-merge joins at every size: pairs grow with the table, and a hot side can be split.
    """
    bag = lambda side: bags.select(F.col("id").alias(side), F.col("bag").alias(f"bag_{side}"))
    both = pairs.select("a", "b").hint("merge").join(bag("a"), "a").hint("merge").join(bag("b"), "b")
    shared = F.size(F.array_intersect("bag_a", "bag_b")).cast("bigint")
    sized = both.select("a", "b", shared.alias("shared"), (F.size("bag_a") + F.size("bag_b")).cast("bigint").alias("sum"))
    return sized.dropDuplicates(["a", "b"]).select("a", "b", "shared", (F.col("sum") - F.col("shared")).alias("joint"))


def linked(percent: int) -> Column:
    return F.col("shared") * 100 >= F.col("joint") * percent


# -- units -------------------------------------------------------------------------------------------------------

def members_of(pairs: DataFrame, percent: int) -> DataFrame:
    """``id, unit, far, hit``: every ``b`` that resembles an ``a``, with the most similar one as its leader ``unit``; their
    distance, and whether they link."""
    best = F.min(F.struct((1 - F.col("shared") / F.col("joint")).alias("far"), F.col("a").alias("unit"), linked(percent).alias("hit")))
    return pairs.filter(F.col("shared") >= ALIKE * F.col("joint")).groupBy(F.col("b").alias("id")).agg(best.alias("m")).select(
        "id", "m.unit", "m.far", "m.hit")


def units_of(near: DataFrame, percent: int) -> DataFrame:
    """Members of units. A leader is no member itself."""
    alike = near.filter(F.col("shared") >= ALIKE * F.col("joint"))
    leaders = alike.select("a").distinct().join(alike.select(F.col("b").alias("a")).distinct(), "a", "left_anti")
    return members_of(alike.join(leaders, "a"), percent)


def centred(units: DataFrame, bags: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Units again, and the pairs compared for it: where more than ``UNLINKED`` members, and most of them, do not link with
    the leader, the member nearest to it leads, as a leader with edits of its own is far from all, and its nearest member has the fewest."""
    large = units.groupBy("unit").agg(
        F.count_if(~F.col("hit")).alias("m"), F.count_if("hit").alias("linked"), F.min(F.struct("far", "id")).alias("first"))
    large = large.filter((F.col("m") > UNLINKED) & (F.col("m") > F.col("linked"))).select("unit", F.col("first.id").alias("a"))
    pairs = units.join(large, "unit").filter("a <> id").select("a", F.col("id").alias("b")).unionByName(large.select("a", F.col("unit").alias("b")))
    led = written_table(compare(pairs, bags), "jaccard-centres")
    return units.join(large, "unit", "left_anti").select(units.columns).unionByName(members_of(led, percent)), led


def unit_spans(lists: DataFrame, units: DataFrame, name: str) -> DataFrame:
    """``shingle, unit, low, high, before, after``: extremes of a unit's entries, in lists of several units. A set without unit is one of its own."""
    owned = lists.select("shingle", "id", "n", "pos").join(units.select("id", "unit"), "id", "left").withColumn(
        "unit", F.coalesce("unit", "id"))
    spans = owned.groupBy("shingle", "unit").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.max("pos").alias("before"), F.max(F.col("n") - F.col("pos") - 1).alias("after"))
    in_list = Window.partitionBy("shingle")
    return written_table(spans.withColumn("_units", F.count(F.lit(1)).over(in_list)).filter("_units > 1").drop("_units"), name)


def met_units(x: DataFrame, y: DataFrame, which: Column, percent: int) -> DataFrame:
    """``a, b``: units of ``x`` and ``y`` that share enough lists; ``which`` picks the pairs."""
    met = x.alias("x").join(y.alias("y"), (F.col("x.shingle") == F.col("y.shingle")) & which & may_link(span("x"), span("y"), percent))
    met = met.groupBy(F.col("x.unit").alias("a"), F.col("y.unit").alias("b")).agg(
        F.count(F.lit(1)).alias("c"), F.min(F.greatest("x.low", "y.low")).alias("n"))
    return met.filter(F.col("c") >= needed(F.col("n"), percent)).select("a", "b")


def near_units(lists: DataFrame, units: DataFrame, near: DataFrame, bags: DataFrame, percent: int) -> DataFrame:
    """``a, b, shared, joint``: leaders of units, and sets without unit that share enough lists with any members of theirs.

    The first comparison misses a set that differs much from the leader: what it shares with it is mostly outside of prefixes.
    """
    spans = unit_spans(lists, units, "jaccard-single")
    led = units.select("unit").distinct()
    met = met_units(spans.join(led, "unit", "left_semi"), spans.join(led, "unit", "left_anti"), F.lit(True), percent)
    return compare(met.join(near, ["a", "b"], "left_anti"), bags)


def links_inside(units: DataFrame, guests: DataFrame, bags: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` between members of one unit, guests included, of which at least one does not link with the leader.

    Two guests are left out: they were compared where they are members.
    """
    bag = lambda side: bags.select(F.col("id").alias(side), F.col("bag").alias(f"bag_{side}"))
    present = units.select("id", "unit", "hit", F.lit(False).alias("guest")).unionByName(guests.withColumn("guest", F.lit(True)))
    active = present.filter("NOT hit").select("unit").distinct()  # elsewhere all members are in one component
    both = present.join(active, "unit").hint("merge").join(bag("id"), "id").hint("merge").join(bag("unit"), "unit")
    # short of linking with the leader: negative for linked members
    rate = percent / (100 + percent)
    short = rate * (F.size("bag_unit") + F.size("bag_id")) - F.size(F.array_intersect("bag_unit", "bag_id"))
    slack = (1 - 2 * rate) * F.size("bag_unit")
    tagged = F.concat(
        F.transform(F.array_except("bag_id", "bag_unit"), lambda e: F.struct(e.alias("e"), F.lit(True).alias("added"))),
        F.transform(F.array_except("bag_unit", "bag_id"), lambda e: F.struct(e.alias("e"), F.lit(False).alias("added"))))
    own = ["id", "unit", "hit", "guest", "short", "slack"]
    differ = both.select("id", "unit", "hit", "guest", short.alias("short"), slack.alias("slack"), tagged.alias("tagged"))
    rows = written_table(differ.select(*own, F.explode("tagged").alias("t")).select(*own, "t.e", "t.added"), "jaccard-differences")
    # a difference of one member alone is in common with nobody: only the others count
    often = rows.groupBy("unit", "e", "added").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    of_member = Window.partitionBy("id", "unit")
    ranked = rows.join(often, ["unit", "e", "added"]).withColumns({
        "pos": F.row_number().over(of_member.orderBy("times", "e", "added")), "n": F.count(F.lit(1)).over(of_member)})
    # two unlinked members share at least short + slack differences, a linked and an unlinked one at least
    # the unlinked one's short and the linked one's short + slack
    least = lambda c: F.greatest(F.lit(1), F.ceil(c - MARGIN))
    ranked = ranked.withColumns({
        "inner": F.col("n") - least(F.col("short") + F.col("slack")) + 1, "outer": F.col("n") - least(F.col("short")) + 1})
    index = ranked.filter(F.col("pos") <= F.when(F.col("hit"), F.col("inner")).otherwise(F.col("outer")))
    index = written_table(index.select(
        "unit", "e", "added", "id", "hit", "guest", "short", "slack", "pos", "n", (F.col("pos") <= F.col("inner")).alias("early")), "jaccard-index")
    x, y = index.filter("NOT hit").alias("x"), index.alias("y")
    same = (F.col("x.unit") == F.col("y.unit")) & (F.col("x.e") == F.col("y.e")) & (F.col("x.added") == F.col("y.added"))
    allowed = F.col("y.hit") | (F.col("x.early") & F.col("y.early") & (F.col("x.id") < F.col("y.id")))
    # differences before, at and after this one must be enough for what the two need in common
    reach = F.least("x.pos", "y.pos") + F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos"))
    enough = reach >= F.col("x.short") + F.col("y.short") + F.col("x.slack") - MARGIN
    met = x.join(y, same & allowed & enough & ~(F.col("x.guest") & F.col("y.guest"))).select(
        F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()
    return compare(written_table(met, "jaccard-inside"), bags).filter(linked(percent)).select("a", "b")


def links_across(lists: DataFrame, units: DataFrame, near: DataFrame, bags: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links ``a, b`` between leaders of different units; and ``id, unit, hit``: guests, members that this leaves open.

    Of two units that may hold further links, the members of the smaller one and its leader are guests of the larger one.
    """
    spans = unit_spans(lists, units, "jaccard-spans")
    met = written_table(met_units(spans, spans, F.col("x.unit") < F.col("y.unit"), percent), "jaccard-met")
    known = near.filter("a < b").join(met, ["a", "b"], "left_semi").distinct()
    answers = written_table(compare(met.join(known, ["a", "b"], "left_anti"), bags).unionByName(known), "jaccard-answers")
    sizes = units.groupBy("unit").agg(F.max("far").alias("r"), F.count(F.lit(1)).alias("m"))
    side = lambda c: sizes.select(F.col("unit").alias(c), F.col("r").alias(f"r_{c}"), F.col("m").alias(f"m_{c}"))
    distance = (1 - F.col("shared") / F.col("joint")).alias("distance")
    limit = 1 - percent / 100 + MARGIN
    judged = answers.select("a", "b", linked(percent).alias("hit"), distance).join(side("a"), "a", "left").join(side("b"), "b", "left")
    judged = written_table(judged.na.fill(0), "jaccard-judged")
    open_ = judged.filter("m_a + m_b > 0").filter(F.col("distance") - F.col("r_a") - F.col("r_b") <= limit)
    turned = F.col("m_a") < F.col("m_b")
    either = lambda c, d, name: F.when(turned, F.col(c)).otherwise(F.col(d)).alias(name)
    open_ = open_.select(either("b", "a", "a"), either("a", "b", "unit"), either("r_b", "r_a", "r"), "distance")
    visits = open_.join(units.select("unit", "id", "far"), "unit").filter(F.col("distance") - F.col("far") - F.col("r") <= limit)
    visits = visits.select("a", F.col("id").alias("b")).unionByName(open_.select("a", F.col("unit").alias("b")))
    compared = compare(visits, bags).join(side("a"), "a").filter(distance - F.col("r_a") <= limit)
    guests = written_table(compared.select(F.col("b").alias("id"), F.col("a").alias("unit"), linked(percent).alias("hit")), "jaccard-guests")
    return judged.filter("hit").select("a", "b"), guests


# -- the join ----------------------------------------------------------------------------------------------------

def component_rows(docs: DataFrame, k: int = 4, percent: int = 85, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row; see the module text."""
    if not 0 < percent <= 100:
        raise ValueError("percent must be in 1..100")
    context = docs.sparkSession.sparkContext
    frequent = context.broadcast(frequent_shingles(docs, k, text))  # at most MOST_FREQUENT hashes and ranks
    sets = written_table(set_rows(docs, k, percent, frequent, key, text), "jaccard-sets")
    classes = sets.filter("n > 0 AND doc_id IS NOT NULL").groupBy("n", "d1", "d2").agg(
        F.min("doc_id").alias("id"), F.first("prefix").alias("prefix"))  # equal sets have equal prefixes

    entries = classes.select("id", F.col("n").cast("int").alias("n"), F.posexplode("prefix").alias("pos", "shingle"))
    of_list = Window.partitionBy("shingle")
    leader = F.min(F.struct("id", "n", "pos")).over(of_list)
    lists = entries.withColumn("leader", leader).withColumn("_size", F.count(F.lit(1)).over(of_list)).filter("_size > 1")
    lists = written_table(lists.select(
        "shingle", "id", "n", "pos", F.col("leader.id").alias("l_id"), F.col("leader.n").alias("l_n"),
        F.col("leader.pos").alias("l_pos")), "jaccard-lists")

    wanted = lists.groupBy("id").agg(F.count(F.lit(1)).alias("c"), F.min("n").alias("n")).filter(
        F.col("c") >= needed(F.col("n"), percent))
    bags = written_table(full_sets(docs, wanted, k, key, text), "jaccard-bags")

    # every entry against the leader of its list, where enough of the prefixes is common to expect some likeness
    prefix = F.col("n") * (1 - percent / 100) + common_column(F.col("n"), percent)
    first = lists.filter("id <> l_id").groupBy(F.col("l_id").alias("a"), F.col("id").alias("b")).agg(
        F.count(F.lit(1)).alias("c"), F.min(F.least("n", "l_n")).alias("n")).filter(
        F.col("c") >= EXPECTED * F.least(prefix, F.col("n")))
    near = written_table(compare(first, bags), "jaccard-near")
    units, led = centred(written_table(units_of(near, percent), "jaccard-led"), bags, percent)
    units = written_table(units, "jaccard-units")
    near = near.unionByName(led)
    more = written_table(near_units(lists, units, near, bags, percent), "jaccard-more")
    near = near.unionByName(more)
    units = written_table(units.unionByName(members_of(more, percent)), "jaccard-units")
    leading, guests = links_across(lists, units, near, bags, percent)
    links = [near.filter(linked(percent)).select("a", "b"), leading, guests.filter("hit").select(F.col("unit").alias("a"), F.col("id").alias("b")),
             links_inside(units, guests, bags, percent)]
    merged = components(reduce(DataFrame.unionByName, links), "jaccard-merged")
    of_id = merged.select(F.col("node").alias("id"), F.col("label").alias("component"))
    labels = classes.drop("prefix").join(of_id, "id", "left").select(
        "n", "d1", "d2", F.coalesce("component", "id").alias("component"))
    rows = sets.select("doc_id", "n", "d1", "d2").join(labels, ["n", "d1", "d2"], "left")
    return rows.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def one_per_component(docs: DataFrame, k: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of every component, with all columns: the first by id (rows without one last, repeated ones in the order of the table).

    Rows that are surely no other member pass without a shuffle; only those whose id may be one meet the exact list.
    """
    columns = docs.columns
    docs, unique = row_marked(docs, key, "_row_mark")
    rows = component_rows(docs, k, percent, "_row_mark", text)
    if unique:
        rows = rows.filter(F.col("doc_id") != F.col("component_id"))
    else:  # numbers of rows say nothing about the ids
        order = F.struct(F.col("_id").isNull().alias("none"), "_id", F.col("doc_id").alias("mark"))
        named = written_table(rows.join(docs.select(F.col("_row_mark").alias("doc_id"), F.col(key).alias("_id")), "doc_id"), "jaccard-named")
        best = named.groupBy("component_id").agg(F.min(order).alias("_best"))
        rows = named.join(best, "component_id").filter(F.col("doc_id") != F.col("_best.mark"))
    key = "_row_mark"
    others = written_table(rows.select(F.col("doc_id").alias("id")).distinct(), "jaccard-others")
    bitmap = docs.sparkSession.sparkContext.broadcast(id_bitmap(others))

    @arrow_udf("boolean")
    def may_be_other(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            at = column.to_numpy() & (len(bitmap.value) * 64 - 1)
            yield pa.array((bitmap.value[at >> 6] >> (at & 63) & 1).astype(bool))

    other = may_be_other(F.xxhash64(F.col(key).cast("bigint")))
    exact = docs.filter(other).join(others.select(F.col("id").alias(key)).hint("merge"), key, "left_anti")
    return docs.filter(~other).unionByName(exact).select(*columns)
