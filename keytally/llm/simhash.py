"""SimHash near-dedup by Golay-code fuzzy hashing.

A document's 64-bit fingerprint has a bit set where over half of its shingles' hashes have it.
Documents link when their fingerprints differ in ``distance`` (at most 2) bits or fewer.

1. Documents with equal fingerprints are one class from the start (partially aggregated, so a
   fingerprint that a third of all documents have is one row a task).
2. A fingerprint is cut into three segments of at most 23 bits. The binary Golay code is perfect:
   every 23-bit word is within 3 bits of exactly one of its 4,096 codewords. Words that differ in
   2 bits or fewer have a word half-way, so both lie within 4 bits of the codeword next to that:
   decoded to all codewords within 4 bits (one if the next is at most 2 bits away, else six),
   they share one. Of at most 2 differing bits, some segment has none (pigeonhole) and the one
   behind it 2 at most. So a fingerprint gets, for each segment as the equal one, that segment
   with each codeword index of the next: 3 to 18 keys of 33 to 35 bits.
3. Keys are counted. The members of a key with at most ``RUN`` are compared with each other and
   give a spanning forest of their links. The members of more frequent keys (crowds of
   fingerprints around one another) are never gathered: each is sent to its 65 words within one
   bit, and members that meet at one word, 65 at most, differ in 2 bits or fewer all of them, and
   give a star. Every pair that links meets half-way, so nothing is lost.
4. Links make components by large and small stars.

Keys, fingerprints and ids shuffle, never texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from keytally.llm.common import shared_table
from keytally.llm.components import connected_components
from keytally.operators.offsets import bounded_broadcast

SHINGLE, SEED, DISTANCE = 3, 42, 2
#: Bits of the three segments, highest first; each is a word of the Golay code, filled up with zeros.
SEGMENTS = (22, 21, 21)
#: Members of a key up to which they are compared with each other.
RUN = 64
#: Most frequent keys that are broadcast (8 bytes each); beyond it they are joined by a shuffle.
MOST_BROADCAST = 1 << 20
LENGTH, DIMENSION = 23, 12
CHECK = LENGTH - DIMENSION
#: Generator of the binary Golay code: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101
RADIUS = 4


def syndromes() -> np.ndarray:
    """The remainder of ``x^i`` by the generator for each bit ``i``: a word's syndrome is the sum over its bits."""
    out = []
    x = 1
    for _ in range(LENGTH):
        out.append(x)
        x <<= 1
        if x >> CHECK:
            x ^= GENERATOR
    return np.array(out, np.int64)


def near_codewords() -> np.ndarray:
    """For each syndrome the patterns of at most ``RADIUS`` bits that turn a word into a codeword, -1 for none."""
    of_bit = syndromes().tolist()
    found: list[list[int]] = [[] for _ in range(1 << CHECK)]
    for weight in range(RADIUS + 1):
        for bits in combinations(range(LENGTH), weight):
            s = pattern = 0
            for b in bits:
                s ^= of_bit[b]
                pattern |= 1 << b
            found[s].append(pattern)
    width = max(map(len, found))
    return np.array([x + [-1] * (width - len(x)) for x in found], np.int64)


class Golay:
    """Indices of the codewords near 23-bit words."""

    def __init__(self):
        self.near = near_codewords()
        of_bit = syndromes()
        high = np.zeros(1 << DIMENSION, np.int64)  # syndrome of a word's upper bits
        for b in range(DIMENSION):
            high[1 << b:2 << b] = high[:1 << b] ^ of_bit[CHECK + b]
        self.high = high

    def indices(self, words: np.ndarray) -> np.ndarray:
        """The codewords' upper bits, which tell them apart, per word; -1 where there are fewer than six."""
        patterns = self.near[self.high[words >> CHECK] ^ (words & ((1 << CHECK) - 1))]
        return np.where(patterns < 0, -1, (words[:, None] ^ patterns) >> CHECK)


def keys_of(prints: np.ndarray, code: Golay) -> tuple[np.ndarray, np.ndarray]:
    """``(key, position)``: the keys of fingerprints (uint64), and which fingerprint each is of."""
    parts, shift = [], 64
    for bits in SEGMENTS:
        shift -= bits
        parts.append(((prints >> np.uint64(shift)) & np.uint64((1 << bits) - 1)).astype(np.int64))
    keys, owners = [], []
    for k in range(len(SEGMENTS)):
        index = code.indices(parts[(k + 1) % len(SEGMENTS)])
        key = ((np.int64(k) << 40) | (parts[k] << DIMENSION))[:, None] | index
        row, column = np.nonzero(index >= 0)
        keys.append(key[row, column])
        owners.append(row)
    return np.concatenate(keys), np.concatenate(owners)


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit fingerprint; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, seed)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate([[0], ends[:-shingle]]).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], seed) for a, b in zip(starts, (ends[shingle - 1:] - 1).tolist())]
    n = len(hashes)
    total = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):  # long texts in blocks
        block = np.array(hashes[at:at + (1 << 16)], ">u8")
        total += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > n).tobytes(), "big")


def forest(prints: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among a few fingerprints, as pairs of positions."""
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= distance
    left, out = np.ones(len(prints), bool), []
    for root in range(len(prints)):
        if not left[root]:
            continue
        left[root] = False
        reached = [root]
        while reached:
            at = reached.pop()
            new = np.flatnonzero(near[at] & left)
            left[new] = False
            out += [(at, x) for x in new.tolist()]
            reached += new.tolist()
    return out


def links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints ``fp`` (longs) that connect what all links connect."""
    names = ["key", "fp"]
    if distance == 0:  # distinct fingerprints do not link
        return prints.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)

    def key_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Golay()
        for b in batches:
            fp = b.column(0).to_numpy()
            key, owner = keys_of(fp.view(np.uint64), code)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[owner])], names)

    posted = shared_table(prints.select("fp").mapInArrow(key_all, "key long, fp long"), "keys")
    frequent = shared_table(posted.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > RUN).select("key"), "frequent")
    # Counted first; beyond the bound a shuffled join, whose frequent keys can be split.
    crowded = posted.join(bounded_broadcast(frequent, MOST_BROADCAST), "key", "left_semi").select("fp").distinct()
    # What remains has at most RUN members a key, so a list of them is bounded.
    few = (posted.join(bounded_broadcast(frequent, MOST_BROADCAST), "key", "left_anti")
           .groupBy("key").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1).select("fps"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists, found = b.column(0), []
            values, at = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())]).tolist()
            for lo, hi in zip(at, at[1:]):
                found += [(lo + x, lo + y) for x, y in forest(values[lo:hi].view(np.uint64), distance)]
            a, c = (np.array([f[k] for f in found], np.int64) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(values[a]), pa.array(values[c])], ["a", "b"])

    bit = lambda k: F.call_function("shiftleft", F.lit(1).cast("long"), k)
    if distance == 2:  # the word itself and those one bit away
        meeting = F.concat(F.array("fp"), F.transform(F.sequence(F.lit(0), F.lit(63)), lambda k: F.col("fp").bitwiseXOR(bit(k))))
    else:  # one bit left out
        meeting = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda k: F.struct(k.alias("bit"), F.col("fp").bitwiseAND(F.bitwise_not(bit(k))).alias("rest")))
    met = (crowded.select("fp", F.explode(meeting).alias("word")).groupBy("word").agg(F.collect_list("fp").alias("fps"))  # at most 65 each
           .filter(F.size("fps") > 1))
    stars = met.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).filter("a <> b")
    return few.mapInArrow(compare, "a long, b long").unionByName(stars)


def simhash_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED,
                  distance: int = DISTANCE) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``.

    Words are runs of anything but ASCII white space, A-Z in lower case; ``shingle`` words in a
    row, joined by one space, are hashed (XXH64), repeats included, fewer words as a whole.
    ``fingerprint`` is written as 16 hex digits; ``component_id`` is the smallest ``doc_id`` that
    can be reached by links, the own included. Null, empty and wordless texts have fingerprint
    zero and link like any other. A null ``doc_id`` takes part but is never a component's id,
    unless there is no other (then null). Repeated rows give repeated results. An empty input
    gives an empty result. ``distance`` is 0, 1 or 2.
    """
    if distance not in (0, 1, 2):
        raise ValueError("distance must be 0, 1 or 2")

    def print_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = np.array([fingerprint(t, shingle, seed) for t in b.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    docs = shared_table(df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
                        .mapInArrow(print_all, "doc_id long, fp long"), "fingerprints")
    distinct = shared_table(docs.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    joined = connected_components(links(distinct, distance))
    grouped = distinct.join(joined.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    ids = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    # Written, so that both sides of the last join are plain scans: a side with a fingerprint that many documents have can be split.
    known = shared_table(grouped.join(ids, "component").select("fp", "component_id"), "components")
    return docs.join(known, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
