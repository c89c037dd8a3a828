"""Exact sets of offsets: bitmaps per bucket, runs, holes, repeats, and merging of ranges.

A partition's offsets are cut into buckets of :data:`BUCKET` neighbours. Which offsets of a bucket
occur is a bitmap, built by a partial aggregation: whatever a task reads of a bucket leaves it as
one row of at most 4 KB, and the buckets of a partition that holds a third of all records are
spread over all tasks. Everything per offset happens inside buckets; across them only their
edges meet, a row or two per bucket.

Runs are half-open ranges ``[from_offset, until_offset)``. Records without topic, partition or
offset have no place in a log and are left out here; the stream store raises for them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from keytally.operators.offsets import MAX_BROADCAST_POSITIONS, PARTITION_KEYS, bounded_broadcast

#: Offsets of a bucket; the bits of Spark's bitmaps.
BUCKET = 32_768
BUCKET_KEYS = (*PARTITION_KEYS, "bucket")
_WORD = 64  # bits read at once
#: Buckets and words as powers of two: offsets are shifted, which rounds down below zero too.
_BUCKET_SHIFT, _WORD_SHIFT = BUCKET.bit_length() - 1, _WORD.bit_length() - 1
#: Most buckets of :func:`range_masks` that are broadcast (4 KB each).
MAX_BROADCAST_BUCKETS = 8_192


def bucket_of(offset: Column | str) -> Column:
    return F.call_function("div", F.col(offset) if isinstance(offset, str) else offset, F.lit(BUCKET))


def _bit(place: Column) -> Column:
    """Bit number of a place in the bucket, such that the bytes read from their high bits on are in order."""
    return place.bitwiseXOR(F.lit(7).cast("bigint"))


def offset_bitmaps(records: DataFrame) -> DataFrame:
    """Per (topic, partition, bucket): ``bitmap`` of the offsets, ``n_records``, least and largest offset."""
    placed = records.filter(F.col("topic").isNotNull() & F.col("partition").isNotNull() & F.col("offset").isNotNull())
    return (placed.select(*PARTITION_KEYS, "offset", bucket_of("offset").alias("bucket"))
            .groupBy(*BUCKET_KEYS)
            .agg(F.bitmap_construct_agg(_bit(F.pmod("offset", F.lit(BUCKET)))).alias("bitmap"),
                 F.count(F.lit(1)).alias("n_records"), F.min("offset").alias("low"), F.max("offset").alias("high")))


def union_bitmaps(bitmaps: DataFrame) -> DataFrame:
    """One row per (topic, partition, bucket) from several (of several batches, say)."""
    return bitmaps.groupBy(*BUCKET_KEYS).agg(F.bitmap_or_agg("bitmap").alias("bitmap"), F.sum("n_records").alias("n_records"),
                                             F.min("low").alias("low"), F.max("high").alias("high"))


def bucket_runs(bitmaps: DataFrame) -> DataFrame:
    """Runs inside buckets: ``topic, partition, bucket, from_offset, until_offset``.

    A bucket without holes gives its run from its least and largest offset; only others are
    decoded: to a text of a character per bit, cut into stretches of zeros and ones.
    """
    whole = F.bitmap_count("bitmap") == F.col("high") - F.col("low") + 1
    keys = [F.col(k) for k in BUCKET_KEYS]
    plain = bitmaps.filter(whole).select(*keys, F.col("low").alias("from_offset"), (F.col("high") + 1).alias("until_offset"))
    # Ends with a one, so that every stretch is a match: zeros behind it would be tried again and again.
    bits = F.rtrim(F.array_join(F.transform(
        F.sequence(F.lit(0), F.lit(BUCKET // _WORD - 1)),
        lambda k: F.lpad(F.conv(F.hex(F.substring("bitmap", k * (_WORD // 8) + 1, F.lit(_WORD // 8))), 16, 2), _WORD, "0")), ""), F.lit("0"))
    stretches = F.expr("regexp_extract_all(bits, '0*+1++', 0)")
    cut = (bitmaps.filter(~whole).select(*keys, bits.alias("bits")).select(*keys, F.posexplode(stretches).alias("k", "stretch"))
           .select(*keys, "k", F.length("stretch").alias("n"), F.length(F.ltrim(F.col("stretch"), F.lit("0"))).alias("ones")))
    until = F.col("bucket") * BUCKET + F.sum("n").over(Window.partitionBy(*BUCKET_KEYS).orderBy("k"))
    return plain.unionByName(cut.withColumn("until_offset", until)
                             .select(*keys, (F.col("until_offset") - F.col("ones")).alias("from_offset"), "until_offset"))


def merge_ranges(ranges: DataFrame, keys: tuple[str, ...] = PARTITION_KEYS, sums: tuple[str, ...] = ()) -> DataFrame:
    """Ranges that touch or overlap made one: ``*keys, from_offset, until_offset`` and the ``sums`` of other columns.

    Gaps and islands: a range that begins beyond every end before it begins an island. The
    windows are over ranges, never over records.
    """
    by_key = Window.partitionBy(*keys).orderBy("from_offset", "until_offset")
    before = F.max("until_offset").over(by_key.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.coalesce(before, F.col("from_offset") - 1) < F.col("from_offset")
    marked = ranges.select(*keys, "from_offset", "until_offset", *sums).withColumn("_new", begins.cast("int"))
    return (marked.withColumn("_island", F.sum("_new").over(by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
            .groupBy(*keys, "_island")
            .agg(F.min("from_offset").alias("from_offset"), F.max("until_offset").alias("until_offset"), *[F.sum(c).alias(c) for c in sums])
            .drop("_island"))


def offset_runs(bitmaps: DataFrame) -> DataFrame:
    """The runs of a set of offsets: ``topic, partition, from_offset, until_offset``.

    Runs that end inside their bucket on both sides are whole; only those at an edge, two a
    bucket at most, are merged across buckets.
    """
    runs = bucket_runs(bitmaps).drop("bucket")
    at_edge = (F.pmod("from_offset", F.lit(BUCKET)) == 0) | (F.pmod("until_offset", F.lit(BUCKET)) == 0)
    return runs.filter(~at_edge).unionByName(merge_ranges(runs.filter(at_edge)))


def offset_gaps(bitmaps: DataFrame) -> DataFrame:
    """The holes between the least and the largest offset: ``topic, partition, from_offset, until_offset, n_missing``."""
    runs = bucket_runs(bitmaps)
    inside = runs.withColumn("_next", F.lead("from_offset").over(Window.partitionBy(*BUCKET_KEYS).orderBy("from_offset")))
    edges = bitmaps.select(*PARTITION_KEYS, (F.col("high") + 1).alias("until_offset"),
                           F.lead("low").over(Window.partitionBy(*PARTITION_KEYS).orderBy("bucket")).alias("_next"))
    holes = (inside.select(*PARTITION_KEYS, "until_offset", "_next").unionByName(edges)
             .filter(F.col("_next") > F.col("until_offset")))
    return holes.select(*PARTITION_KEYS, F.col("until_offset").alias("from_offset"), F.col("_next").alias("until_offset"),
                        (F.col("_next") - F.col("until_offset")).alias("n_missing"))


def range_gaps(ranges: DataFrame) -> DataFrame:
    """The holes between ranges that do not overlap: ``topic, partition, from_offset, until_offset``."""
    following = F.lead("from_offset").over(Window.partitionBy(*PARTITION_KEYS).orderBy("from_offset"))
    return (ranges.select(*PARTITION_KEYS, "until_offset", following.alias("_next")).filter(F.col("_next") > F.col("until_offset"))
            .select(*PARTITION_KEYS, F.col("until_offset").alias("from_offset"), F.col("_next").alias("until_offset")))


def repeated_offsets(records: DataFrame, bitmaps: DataFrame, max_broadcast_rows: int = MAX_BROADCAST_POSITIONS) -> DataFrame:
    """Offsets that occur more than once: ``topic, partition, offset, n``; looks only into buckets with more records than bits."""
    crowded = bitmaps.filter(F.col("n_records") > F.bitmap_count("bitmap")).select(*BUCKET_KEYS)
    looked = records.withColumn("bucket", bucket_of("offset")).join(bounded_broadcast(crowded, max_broadcast_rows), list(BUCKET_KEYS), "left_semi")
    return looked.groupBy(*PARTITION_KEYS, "offset").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def _pieces(ranges: DataFrame, shift: int, number: str) -> DataFrame:
    """A row for each stretch of ``2 ** shift`` offsets that a range meets; ``from_offset`` and ``until_offset`` stay those of the range."""
    at = F.sequence(F.shiftright("from_offset", shift), F.shiftright(F.col("until_offset") - 1, shift))
    return ranges.withColumn(number, F.explode(at))


def range_masks(ranges: DataFrame) -> DataFrame:
    """Ranges as bits: ``topic, partition, _bucket, _words``, by offset of the bucket.

    ``_words`` is an array of :data:`BUCKET` bits in 64-bit words, so that a record needs one look;
    it is null for a bucket that one range covers as a whole. A range gives a row per bucket, and
    in buckets that it covers in part a row per word.
    """
    by_bucket = _pieces(ranges.select(*PARTITION_KEYS, "from_offset", "until_offset"), _BUCKET_SHIFT, "_bucket")
    start = F.shiftleft("_bucket", _BUCKET_SHIFT)
    by_bucket = by_bucket.select(*PARTITION_KEYS, "_bucket", F.greatest("from_offset", start).alias("from_offset"),
                                 F.least("until_offset", start + BUCKET).alias("until_offset"))
    covered = F.col("until_offset") - F.col("from_offset") == BUCKET
    whole = by_bucket.filter(covered).select(*PARTITION_KEYS, "_bucket", F.lit(None).cast("array<bigint>").alias("_words"))
    part = by_bucket.filter(~covered)
    begin = F.shiftleft("_word", _WORD_SHIFT)
    low, high = F.greatest(F.col("from_offset") - begin, F.lit(0)), F.least(F.col("until_offset") - begin, F.lit(_WORD))
    ones = F.call_function("shiftrightunsigned", F.lit(-1).cast("bigint"), (F.lit(_WORD) - (high - low)).cast("int"))
    masks = (_pieces(part, _WORD_SHIFT, "_word")
             .select(*PARTITION_KEYS, "_bucket", "_word", F.call_function("shiftleft", ones, low.cast("int")).alias("_mask")))
    # Every word of a bucket has a row, so that the sorted masks are the array.
    first = F.shiftleft("_bucket", _BUCKET_SHIFT - _WORD_SHIFT)
    empty = (part.select(*PARTITION_KEYS, "_bucket").distinct()
             .select(*PARTITION_KEYS, "_bucket", F.explode(F.sequence(first, first + (BUCKET // _WORD - 1))).alias("_word"), F.lit(0).cast("bigint").alias("_mask")))
    words = masks.unionByName(empty).groupBy(*PARTITION_KEYS, "_bucket", "_word").agg(F.bit_or("_mask").alias("_mask"))
    arrays = words.groupBy(*PARTITION_KEYS, "_bucket").agg(F.sort_array(F.collect_list(F.struct("_word", "_mask"))).alias("_sorted"))  # 512 of a bucket
    return whole.unionByName(arrays.select(*PARTITION_KEYS, "_bucket", F.col("_sorted._mask").alias("_words")))


def without_ranges(records: DataFrame, ranges: DataFrame, max_broadcast_rows: int = MAX_BROADCAST_POSITIONS) -> DataFrame:
    """Records whose offset is in none of the ``ranges (topic, partition, from_offset, until_offset)``, which do not overlap.

    The first range of a partition, which holds nearly all of a log that was read in order, is
    compared; the others are bits of buckets, in which a record is looked up at one place however
    many ranges its bucket has. So neither a hot partition nor one with many ranges is a join key
    of its own. The tables are broadcast if they are counted to be small.
    """
    first = (ranges.groupBy(*PARTITION_KEYS).agg(F.min(F.struct("from_offset", "until_offset")).alias("_first"))
             .select(*PARTITION_KEYS, F.col("_first.from_offset").alias("_first_from"), F.col("_first.until_offset").alias("_first_until")))
    first = bounded_broadcast(first, max_broadcast_rows)
    kept = (records.join(first, list(PARTITION_KEYS), "left")
            .filter(F.col("_first_from").isNull() | F.col("offset").isNull() | ~F.col("offset").between(F.col("_first_from"), F.col("_first_until") - 1))
            .drop("_first_from", "_first_until"))
    later = ranges.join(first, list(PARTITION_KEYS)).filter(F.col("from_offset") > F.col("_first_from"))
    if later.isEmpty():
        return kept
    held = bounded_broadcast(range_masks(later).withColumn("_held", F.lit(True)), min(max_broadcast_rows, MAX_BROADCAST_BUCKETS))
    word = F.get("_words", F.shiftright("offset", _WORD_SHIFT).bitwiseAND(F.lit(BUCKET // _WORD - 1)).cast("int"))
    inside = F.coalesce("_held", F.lit(False)) & (F.col("_words").isNull() | (F.getbit(word, F.col("offset").bitwiseAND(F.lit(_WORD - 1)).cast("int")) == 1))
    return (kept.withColumn("_bucket", F.shiftright("offset", _BUCKET_SHIFT)).join(held, [*PARTITION_KEYS, "_bucket"], "left")
            .filter(~inside).drop("_bucket", "_words", "_held"))
