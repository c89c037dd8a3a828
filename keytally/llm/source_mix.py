"""Mixing sources to target weights, with DataFrame operations only.

Sizes are words. The words of a source, its documents in id order, are packed into blocks of
``block_words``. A source is to give ``target`` words: its weight's share of all words, but
never more than ``most`` times its own (the excess goes to the others by weight).

* Output slots are numbered ``0 .. M-1`` and dealt to shards of ``shard_slots``. A pseudorandom
  permutation of the slots says which source fills which slot, so a shard's source counts are a
  multinomial draw given that the totals over all shards are the targets (to within a block).
* A source's ``j``-th slot takes block ``p(j mod n)`` where ``p`` is the source's own
  pseudorandom permutation of its ``n`` blocks; ``j div n`` is the epoch. So no block is taken
  twice before all were taken once, and none more than ``most`` times.
* Slots and the documents' parts of blocks are joined by (source, block).

Word positions are running sums per (source, bucket), a bucket being a hash class of ids of
about ``bucket_rows`` rows; bucket offsets are summed over one row per bucket. So a source with
a third of all rows is spread over all tasks. Only the table of sources, one row each, is ever
sorted as a whole. All draws are functions of the seed, the sources and the ids: reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from keytally.llm.common import WORD, parts_for, shared_table

BLOCK_WORDS = 64
MOST = 3
SHARD_SLOTS = 4096
BUCKET_ROWS = 16_384
#: Slots that one row of the slot generator unfolds to.
CHUNK_SLOTS = 16_384
#: Rounds of a permutation; an element has 2**rounds places it can go to.
ROUNDS = 20
SEED = 20240229


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def permuted(x: Column, n: Column, seed: Column) -> Column:
    """Pseudorandom permutation of ``0 .. n-1``: rounds of swap-or-not.

    A round pairs ``x`` with ``(k - x) mod n``; both of a pair see the same hash bit, which says
    whether they change places, so each round is a bijection for any ``n``.
    """
    def one_round(at: Column, r: Column) -> Column:
        key = F.pmod(F.xxhash64(seed, r), n)
        partner = F.pmod(key - at, n)
        swap = F.pmod(F.xxhash64(seed, r, F.greatest(at, partner)), F.lit(2)) == 1
        return F.when(swap, partner).otherwise(at)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), x.cast("long"), one_round)


def source_targets(sizes: DataFrame, most: int = MOST, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per source of ``sizes (source, size)``: its weight, target, blocks and slots.

    Sources weigh 1, 2, 3, 1, 2, 3 ... in code-point order, null last. With sources in order of
    cap / weight, a source is capped while its share of what the caps before it leave exceeds
    its cap; the first that is not fixes the level for itself and all after it.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    ranked = (per_source.withColumn("src", F.row_number().over(by_name))
              .withColumn("weight", (F.col("src") - 1) % 3 + 1)
              .withColumn("cap", F.col("source_size") * most))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "src")
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).orderBy("src")
    leveled = (ranked
               .withColumn("level", (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
                           / F.sum("weight").over(rest))
               .withColumn("free", F.col("level") * F.col("weight") <= F.col("cap"))
               .withColumn("level", F.min(F.when(F.col("free"), F.struct(F.col("cap") / F.col("weight"), "src", "level")))
                           .over(everything)["level"]))
    target = F.when(F.col("free"), F.col("level") * F.col("weight")).otherwise(F.col("cap")).cast("double")
    blocks = F.ceil(F.col("source_size") / block_words)
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size") * F.col("blocks")).otherwise(0.0)
    up_to = Window.orderBy("src").rowsBetween(Window.unboundedPreceding, 0)
    slots = (leveled.withColumn("target", target).withColumn("blocks", blocks).withColumn("wanted", wanted)
             .withColumn("all_wanted", F.sum("wanted").over(everything))
             .withColumn("all_slots", F.floor(F.col("all_wanted") + 1e-6))
             .withColumn("upper", F.when(F.col("all_wanted") > 0, F.floor(
                 F.sum("wanted").over(up_to) / F.col("all_wanted") * F.col("all_slots") + 0.5)).otherwise(0))
             .withColumn("lower", F.coalesce(F.lag("upper").over(Window.orderBy("src")), F.lit(0))))
    count = F.least(F.col("upper") - F.col("lower"), F.col("blocks") * most)
    return slots.select("source", "src", "source_size", "target", "blocks", "all_slots",
                        F.col("lower").alias("first_slot"), count.alias("slots"))


class Mix:
    """What a mix takes: ``sizes`` (a row per document) and ``taken`` (a row per document part and slot)."""

    def __init__(self, sizes: DataFrame, sources: DataFrame, taken: DataFrame):
        self.sizes, self.sources, self.taken = sizes, sources, taken


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        row_col: str | None = None, block_words: int = BLOCK_WORDS, most: int = MOST,
        shard_slots: int = SHARD_SLOTS, bucket_rows: int = BUCKET_ROWS, seed: int = SEED) -> Mix:
    """Draw the mix of ``df``.

    ``sizes``: doc_id, row_id, src, size; ``taken``: row_id, from_word, words, slot, shard, epoch.
    Null text has size 0 and is never taken; null sources are a source of their own, weighed
    last; documents with equal ids follow each other by row id. No words, no slots.
    """
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    sizes = shared_table(df.select(F.col(id_col).cast("long").alias("doc_id"), row.alias("row_id"),
                                   F.col(source_col).cast("string").alias("source"),
                                   word_count(F.col(text_col)).alias("size")), "sizes")
    sources = shared_table(source_targets(sizes.select("source", "size"), most, block_words), "sources")
    sized = sizes.alias("d").join(sources.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source"))) \
        .select("d.doc_id", "d.row_id", "d.size", "s.src", "s.blocks")

    buckets = parts_for(sizes.count(), bucket_rows)
    sized = sized.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)))
    offsets = (sized.groupBy("src", "bucket").agg(F.sum("size").alias("bucket_size"))
               .withColumn("offset", F.sum("bucket_size").over(Window.partitionBy("src").orderBy("bucket")) - F.col("bucket_size"))
               .select("src", "bucket", "offset"))
    inside = Window.partitionBy("src", "bucket").orderBy(F.asc_nulls_last("doc_id"), "row_id")
    placed = (sized.filter(F.col("size") > 0)
              .withColumn("start", F.sum("size").over(inside) - F.col("size"))
              .join(offsets, ["src", "bucket"])
              .withColumn("start", F.col("start") + F.col("offset")))
    length = F.lit(block_words)
    first, last = F.floor(F.col("start") / length), F.floor((F.col("start") + F.col("size") - 1) / length)
    from_word = F.greatest(F.col("block") * length - F.col("start"), F.lit(0))
    to_word = F.least((F.col("block") + 1) * length - F.col("start"), F.col("size"))
    parts = (placed.select("row_id", "src", "start", "size", F.explode(F.sequence(first, last)).alias("block"))
             .select("row_id", "src", "block", from_word.alias("from_word"), (to_word - from_word).alias("words")))

    n_slots = sources.agg(F.max("all_slots")).first()[0] or 1
    chunks = (sources.filter(F.col("slots") > 0)
              .select("src", "blocks", "slots", "first_slot", "all_slots",
                      F.explode(F.sequence(F.lit(0), F.floor((F.col("slots") - 1) / CHUNK_SLOTS))).alias("chunk"))
              .repartition(parts_for(n_slots, 4 * CHUNK_SLOTS), "src", "chunk"))
    to = F.least((F.col("chunk") + 1) * CHUNK_SLOTS, F.col("slots")) - 1
    slots = chunks.withColumn("j", F.explode(F.sequence(F.col("chunk") * CHUNK_SLOTS, to)))
    slot = permuted(F.col("first_slot") + F.col("j"), F.col("all_slots"), F.lit(seed).cast("long"))
    block = permuted(F.pmod("j", "blocks"), F.col("blocks"), F.xxhash64(F.lit(seed), F.col("src")))
    slots = slots.select("src", block.alias("block"), slot.alias("slot"), F.floor(F.col("j") / F.col("blocks")).alias("epoch"))
    # Neither side is small, whatever the generator's few chunk rows suggest.
    taken = (parts.join(slots.hint("merge"), ["src", "block"])
             .select("row_id", "from_word", "words", "slot", F.floor(F.col("slot") / shard_slots).alias("shard"), "epoch"))
    return Mix(sized.select("doc_id", "row_id", "src", "size"), sources, taken)


def source_mix(df: DataFrame, **options) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken``.

    ``taken`` counts the words the mix takes of it, repeats included. An empty input gives an
    empty result.
    """
    m = mix(df, **options)
    per_row = m.taken.groupBy("row_id").agg(F.sum("words").alias("taken"))
    return (m.sizes.join(per_row, "row_id", "left").join(m.sources.select("src", "source_size", "target"), "src")
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))


def mixed_documents(df: DataFrame, text_col: str = "text", row_col: str = "row_id", **options) -> DataFrame:
    """The mix as documents: for each epoch in which a document is taken, a row with the words taken.

    The row has the document's columns and ``epoch`` (a column of that name gives way to it); its
    text is the document's if taken whole, else its taken words with the white space after them.
    """
    m = mix(df, text_col=text_col, row_col=row_col, **options)
    copies = (m.taken.groupBy("row_id", "epoch")
              .agg(F.sort_array(F.collect_list(F.struct("from_word", "words"))).alias("pieces"), F.sum("words").alias("words"))
              .join(m.sizes.select("row_id", "size"), "row_id")
              .select("row_id", "epoch", F.when(F.col("words") < F.col("size"), F.col("pieces")).alias("pieces")))
    columns = [c for c in df.columns if c.lower() != "epoch"]
    held = {c: f"__doc_{i}" for i, c in enumerate(columns)}
    text, rows = F.col(held[text_col]), df.select(*[F.col(c).alias(h) for c, h in held.items()])
    words = F.regexp_extract_all(text, F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0))
    cut = F.aggregate("pieces", F.lit(""), lambda made, p: F.concat(
        made, F.array_join(F.slice(F.col("words"), (p["from_word"] + 1).cast("int"), p["words"].cast("int")), "")))
    mixed = (rows.join(copies, rows[held[row_col]] == copies["row_id"])
             .withColumn("words", F.when(F.col("pieces").isNotNull(), words))
             .withColumn(held[text_col], F.when(F.col("pieces").isNull(), text).otherwise(cut)))
    return mixed.select(*held.values(), "epoch").toDF(*columns, "epoch")
