"""Document fingerprints: one-permutation MinHash in SQL functions only.

Each run of five words is hashed once; the top bits of the hash name one of BINS bins, and a bin keeps its least hash.
Empty bins are filled by optimal densification: bin i asks other bins in an order that depends on i alone until it
finds a filled one. The first ROUNDS bins it asks are drawn by hash; after them, all filled bins are ranked by the hash
of the pair, which is a draw without end that always finds one. Of each bin's hash, mixed with the bin's number so that
a borrowed hash shows other bits in every bin, the lowest BITS bits are kept, one hex digit: a fingerprint is a string of BINS digits.

Likeness is the share of equal digits, corrected for digits equal by chance: (share - 2^-BITS) / (1 - 2^-BITS), within 0 and 1.

Texts of fewer than five words are one run; texts without a word (null and empty too) have the fingerprint '', alike with
each other (1) and with no other text (0). Everything is worked out within a row: no shuffle, no state beside the
text's own hashes, and repeated texts get the same fingerprint.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import WORDS_PER_SHINGLE, saved

BINS = 256
BITS = 4
ROUNDS = 6
_SHIFT = 64 - 8
_LOW = (1 << _SHIFT) - 1


def let(value: Column, body) -> Column:
    """body(value) with value worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _probes(round_: int) -> Column:
    """The bin that each bin asks in a round; drawn once for good by a seeded generator."""
    draw = random.Random(round_)
    return F.array(*[F.lit(draw.randrange(BINS)) for _ in range(BINS)])


def _shingles(text: Column) -> Column:
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def runs(h: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(h) - WORDS_PER_SHINGLE)
        whole = F.transform(at, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WORDS_PER_SHINGLE)]))
        return F.when(F.size(h) >= WORDS_PER_SHINGLE, whole).when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))

    return let(F.transform(words, lambda w: F.xxhash64(w)), runs)


def bins(shingles: Column) -> Column:
    """Least hash of each bin, null where it is empty. A bound above all hashes of a bin stands in for an empty one."""
    bounds = F.array(*[F.lit(_signed(b << _SHIFT | _LOW)) for b in range(BINS)])
    first = let(F.sort_array(F.concat(shingles, bounds)), lambda s: F.filter(
        s, lambda x, i: (i == 0) | (F.shiftrightunsigned(x, _SHIFT) != F.shiftrightunsigned(F.get(s, i - 1), _SHIFT))))
    return F.transform(first, lambda x: F.when(x.bitwiseAND(F.lit(_LOW)) != _LOW, x))


def densify(found: Column) -> Column:
    def fill(own: Column) -> Column:
        out = own
        for r in range(ROUNDS):
            probes = _probes(r)
            out = let(out, lambda v: F.when(F.exists(v, lambda x: x.isNull()), F.transform(v, lambda x, i: F.coalesce(x, F.get(own, F.get(probes, i))))).otherwise(v))

        def rest(v: Column) -> Column:
            filled = F.filter(F.transform(own, lambda x, j: F.struct(j.alias("j"), x.alias("x"))), lambda s: s["x"].isNotNull())
            ranked = lambda i, every: F.array_min(F.transform(every, lambda s: F.struct(F.xxhash64(i, s["j"]).alias("r"), s["x"].alias("x"))))["x"]
            return F.when(F.exists(v, lambda x: x.isNull()), let(filled, lambda every: F.transform(v, lambda x, i: F.coalesce(x, ranked(i, every))))).otherwise(v)

        return let(out, rest)

    return let(found, fill)


def fingerprint(text: Column) -> Column:
    digits = F.array(*[F.lit(f"{d:x}") for d in range(1 << BITS)])

    def pack(shingles: Column) -> Column:
        packed = F.array_join(F.transform(densify(bins(shingles)), lambda x, i: F.get(digits, F.xxhash64(x, i).bitwiseAND(F.lit((1 << BITS) - 1)).cast("int"))), "")
        return F.when(F.size(shingles) > 0, packed).otherwise(F.lit(""))

    return let(_shingles(text), pack)


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles (Jaccard) of two fingerprints."""
    equal = F.size(F.filter(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x == y), lambda same: same)) / BINS
    chance = 2.0 ** -BITS
    estimate = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (equal - chance) / (1 - chance)))
    return F.when(a == b, F.lit(1.0)).when((a == "") | (b == ""), F.lit(0.0)).otherwise(estimate)


def successors(ids: DataFrame, id_col: str) -> DataFrame:
    """The next id of each distinct id (after the last: the first): id_col, __next. Null ids have no place.

    Ids are dealt to ranges; a window runs inside each range, and the ends of the ranges, one row each, are joined by a
    small one.
    """
    distinct = ids.where(F.col(id_col).isNotNull()).select(id_col).distinct()
    # Saved, as the ranges must not change between two readings.
    ranged = saved(distinct.repartitionByRange(id_col).select(id_col, F.spark_partition_id().alias("__part")), "ranges")
    heads = ranged.groupBy("__part").agg(F.min(id_col).alias("__head"))
    order = Window.orderBy("__part")
    first = F.first("__head").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = heads.select("__part", F.coalesce(F.lead("__head").over(order), first).alias("__head"))
    follow = F.lead(id_col).over(Window.partitionBy("__part").orderBy(id_col))
    return ranged.withColumn("__lead", follow).join(F.broadcast(heads), "__part").select(id_col, F.coalesce("__lead", "__head").alias("__next"))


def with_next_half(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text with an edited form: its last half replaced by the first characters of the next text in id order.

    Columns id_col, text, edited and next_id. Of several rows of one id each is edited by itself; the least text stands for the id
    when it is the next one. A null id has no next text.
    """
    every = df.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # Both joins below are inner ones on the same rows and key, so the texts are shuffled once.
    rows = every.where(F.col(id_col).isNotNull())
    halves = df.groupBy(id_col).agg(F.max(F.floor(F.char_length(F.coalesce(F.col(text_col), F.lit(""))) / 2).cast("int")).alias("__half"))
    before = saved(successors(df, id_col).join(halves, id_col).select(F.col("__next").alias(id_col), F.col(id_col).alias("__before"), "__half"), "order")
    # Only the part that the text before needs goes on to the second shuffle.
    part = rows.join(before, id_col).select("__before", F.col(id_col).alias("next_id"), F.substring("text", F.lit(1), F.col("__half")).alias("__start"))
    part = part.groupBy("__before").agg(F.min("__start").alias("__start"), F.min("next_id").alias("next_id"))
    joined = rows.join(part, F.col(id_col) == F.col("__before"))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("__start", F.lit(1), half))
    nameless = every.where(F.col(id_col).isNull())
    alone = nameless.select(id_col, "text", F.substring("text", F.lit(1), n - half).alias("edited"), F.col(id_col).alias("next_id"))
    return joined.select(id_col, "text", edited.alias("edited"), "next_id").union(alone)
