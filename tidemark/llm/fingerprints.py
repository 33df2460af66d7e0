"""Document fingerprints by one-permutation MinHash, in DataFrame expressions alone."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Bins, and bits kept of each: the standard error of a likeness is at most 0.5 / sqrt(256) = 0.031.
BINS, BITS = 256, 8
#: Words of a shingle.
WIDTH = 5

_LOW = 64 - BITS
#: The largest value of each bin, in the order in which signed hashes sort; in a bin without shingles it is all there is.
_TOPS = [(b - BINS // 2 << _LOW) + (1 << _LOW) - 1 for b in range(BINS)]
_random = random.Random(19)
#: Where bin i looks when it is empty: first _AT[i], then _STEP[i] further each time; odd steps reach all bins.
_AT = [_random.randrange(BINS) for _ in range(BINS)]
_STEP = [_random.randrange(BINS // 2) * 2 + 1 for _ in range(BINS)]
#: So many looks are tried one by one before the rest are searched at once.
_LOOKS = 40


def _let(value: Column, body) -> Column:
    """body(value), with value computed once: a lambda's variable, as Catalyst repeats an expression in a lambda for each element."""
    return F.transform(F.array(value), body)[0]


def shingles(text: Column) -> Column:
    """64-bit hashes of all sequences of WIDTH words; of fewer words, of their whole sequence; no words: none."""
    def of(words: Column) -> Column:
        n = F.size(words)
        return (F.when(n >= WIDTH, F.transform(F.sequence(F.lit(0), n - WIDTH), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WIDTH)])))
                .when(n > 0, F.array(F.xxhash64(words))).otherwise(F.expr("array()").cast("array<bigint>")))

    return _let(F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), ""), of)


def _minima(hashes: Column) -> Column:
    """The smallest hash of each bin, in order of the bins; an empty bin has its largest value.

    The top bits of a hash are its bin, so sorting brings a bin's hashes together, the smallest first.
    """
    def first(c: Column) -> Column:
        return F.filter(c, lambda x, i: (i == 0) | (F.shiftright(x, _LOW) != F.shiftright(F.get(c, i - 1), _LOW)))

    return _let(F.sort_array(F.concat(hashes, F.lit(_TOPS).cast("array<bigint>"))), first)


def _filled(minima: Column) -> Column:
    """Optimal densification: an empty bin takes the value of the first full one on its own way through all bins."""
    tops, at, step = F.lit(_TOPS).cast("array<bigint>"), F.lit(_AT), F.lit(_STEP)

    def fill(d: Column) -> Column:
        def value(j: Column) -> Column:
            x = F.get(d, j)
            return F.when(x != F.get(tops, j), x)

        def look(i: Column, t) -> Column:
            return F.pmod(F.get(at, i) + F.get(step, i) * t, F.lit(BINS))

        def rest(i: Column) -> Column:
            ways = F.filter(F.sequence(F.lit(_LOOKS), F.lit(BINS - 1)), lambda t: F.get(d, look(i, t)) != F.get(tops, look(i, t)))
            return F.get(d, look(i, F.get(ways, F.lit(0))))

        return F.transform(d, lambda x, i: F.coalesce(value(i), *[value(look(i, F.lit(t))) for t in range(_LOOKS)], rest(i)))

    return _let(minima, fill)


def fingerprint(text: Column) -> Column:
    """The low BITS bits of each bin as array<tinyint>; null for a text without words. Equal texts have equal ones."""
    packed = F.transform(_filled(_minima(shingles(text))), lambda x: F.shiftright(F.shiftleft(x, 64 - BITS), 64 - BITS).cast("tinyint"))
    return F.when(F.regexp_like(text, F.lit("[^\\x20\\x09-\\x0D]")), packed)


def as_text(packed: Column) -> Column:
    """Two hexadecimal digits a bin; empty for a text without words."""
    return F.coalesce(F.array_join(F.transform(packed, lambda x: F.lower(F.substring(F.hex(x.cast("int") + 256), -2, 2))), ""), F.lit(""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated similarity of two shingle sets: equal bins less those equal by chance, 0 to 1. Two texts without words: 1; one: 0."""
    equal = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    chance = 1 / 2**BITS
    share = (equal.cast("double") / BINS - chance) / (1 - chance)
    return (F.when(a.isNull() & b.isNull(), F.lit(1.0)).when(a.isNull() | b.isNull(), F.lit(0.0))
            .otherwise(F.greatest(F.lit(0.0), share)))


def with_next(df: DataFrame, key: str, columns: list[str], blocks: int) -> DataFrame:
    """df with next_<c> for each c of columns: the value in the next row by ascending key (nulls first), after the last the first.

    Rows are cut into blocks at quantiles of the key. The first row of each block also goes to the block before as a
    guest, so each block finds its rows' successors alone: one shuffle, and no task sees more than a block. Rows of one
    key follow each other in the order of the hash of `columns`; at most one key's rows go to one block more.
    """
    shares = [i / blocks for i in range(1, blocks)]
    found = df.agg(F.min(key).alias("low"), F.percentile_approx(key, shares, 10_000).alias("cuts") if shares else F.lit(None).alias("cuts"),
                   F.count(F.when(F.col(key).isNull(), 1)).alias("nulls")).first()
    cuts = sorted({c for c in found["cuts"] or [] if c > found["low"]})
    bounds = F.lit(cuts).cast("array<bigint>") if cuts else F.expr("array()").cast("array<bigint>")
    steps = F.lit([1 << k for k in reversed(range(max(1, len(cuts).bit_length())))])
    block = F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(F.get(bounds, at + step - 1) <= F.col(key), step).otherwise(F.lit(0)))
    rows = df.withColumn("__own", block)
    is_first = F.col(key).isNull() if found["nulls"] else F.col(key) == F.lit(found["low"])
    is_bound = (F.col("__own") > 0) & (F.get(bounds, F.col("__own") - 1) == F.col(key))
    place = lambda at, guest: F.struct(at.cast("int").alias("block"), F.lit(guest).alias("guest"))
    spots = F.array_compact(F.array(place(F.col("__own"), 0), F.when(is_bound, place(F.col("__own") - 1, 1)), F.when(is_first, place(F.lit(len(cuts)), 2))))
    dealt = rows.withColumn("__at", F.explode(spots))
    order = Window.partitionBy("__at.block").orderBy("__at.guest", F.col(key).asc_nulls_first(), F.xxhash64(*columns))
    after = F.lead(F.struct(*columns)).over(order)
    return (dealt.withColumn("__next", after).filter("__at.guest = 0")
            .select(*df.columns, *[F.col(f"__next.{c}").alias(f"next_{c}") for c in columns]))


def compare_with_edits(docs: DataFrame, blocks: int | None = None) -> DataFrame:
    """Each document's fingerprint, that of its text with the last quarter replaced by the next document's beginning, and likenesses.

    A null text is an empty one; a null doc_id comes before all others; rows that repeat a doc_id follow each other in
    the order of a hash of their texts. A single document is followed by itself.
    """
    spark = docs.sparkSession
    blocks = blocks or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("print", fingerprint(F.col("text")))
    n = F.length("text")
    edited = F.concat(F.expr("left(text, length(text) - length(text) div 4)"), F.expr("left(next_text, cast(length(text) div 4 as int))"))
    both = (with_next(own, "doc_id", ["text", "print"], blocks)
            .select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "print", "next_print")
            .withColumn("edited_print", fingerprint(F.col("edited"))))
    return both.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                       as_text(F.col("print")).alias("fingerprint"), as_text(F.col("edited_print")).alias("edited_fingerprint"),
                       likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
                       likeness(F.col("print"), F.col("next_print")).alias("near_next"))
