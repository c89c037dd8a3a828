"""N-gram Jaccard join with token-combination prefixes.

A document is the set of hashes of its word n-grams (tokens). Documents with equal sets are one
class from the start. Tokens are ordered by hash; of linked classes the first tokens cannot all
differ, which gives the prefix of a class.

* Tokens that more than a given number of prefixes hold are frequent, all others rare. A rare
  token in a prefix is a key by itself. A frequent one is a key only combined with the token that
  follows it in its set, and the prefix is extended: of a set that lacks ``e`` tokens of the other
  and meets ``f`` new ones, at most ``e + min(frequent, e + f)`` keys differ, so a prefix with one
  key more shares a key with every set it links to.
  Which tokens are frequent is counted over first prefixes, and again over the extended ones. Prefixes
  hold the upper 40 bits of tokens: where two tokens share them, there are candidates more, not fewer.
* Keys shuffle once and are read in sorted runs. A run of few classes gives its pairs, those that
  the length filter leaves. A longer run (classes alike in nearly everything) gives a star, by
  which its classes are gathered into dense groups. Long runs also come about by chance, and join ever
  more classes as the corpus grows: classes of a large group are keyed once more, by their tokens in
  another order and inside their group only, as long as that makes the groups much smaller.
* Pairs pass a filter on 128 token counts per class, which bounds the distance from below, and pairs
  of large sets, of which 128 counts tell little, another on a count for about every four tokens. What
  is left is verified on whole sets: first one pair of each class, then those of the others whose classes
  these links have not connected yet.
* Dense groups are cut into bands of set sizes, of which only neighbours can link, and bands into
  blocks of bounded size; block against block is verified, and gives a spanning forest of its links
  instead of all links. What is sent to the blocks is not a class's set but its difference from the
  set of one class of the group: of sets ``A`` and ``B`` that lack ``a`` and ``b`` tokens of the set
  ``R``, ``|A and B| = |R| - a - b + |(A xor R) and (B xor R)|``, exactly.
* Links make components. Nothing is capped: every link lies in a pair or in a dense group.
* Class ids are 64 bits of a 128-bit hash of the set. Two sets with one id would show by the other
  64 bits; the ids are then made anew with another seed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from keytally.llm.common import drop_table, shared_table, shuffle_partitions
from keytally.llm.components import connected_components
from keytally.operators.offsets import bounded_broadcast

#: A token is frequent in more than so many prefixes. If that are more than 2**20 tokens, a count adds the most
#: frequent ones only, up to that number (4 bytes each in the broadcast set).
FREQUENT, MOST_FREQUENT = 64, 1 << 20
#: Bytes of a token that prefixes hold.
PREFIX_BYTES = 5
#: Counts of frequent tokens; the first is over the prefixes without extension.
COUNTS = 2
#: Classes of a run up to which its pairs are listed.
RUN = 64
#: Candidates that a task gathers before it hands them on (about 200 bytes each, twice that meanwhile).
DRAIN = 100_000
#: Classes of a block in a dense group, and tokens handled at once there.
BLOCK, VOCABULARY = 1024, 8192
#: Groups of more blocks are keyed once more, until that takes less than a quarter of the classes from them. What
#: chance joins differs in size, so that fewer blocks are one or two in each band.
MOST_BLOCKS = 16
BUCKETS = 128
#: Most tokens a count; sets of more than ``PER_COUNT * BUCKETS`` tokens get finer counts too.
PER_COUNT = 4
#: Most document keys that are broadcast to fetch texts (about 40 bytes each).
MOST_BROADCAST = 1 << 20
#: Most tokens of the dense groups' sets to compare with that are broadcast (8 bytes each).
MOST_TOKENS = 1 << 22


class Rule:
    """Sizes and bounds for Jaccard similarity >= num / den of sets of ``shingle``-word tokens."""

    def __init__(self, shingle: int = 3, num: int = 90, den: int = 100):
        self.shingle, self.num, self.den = shingle, num, den
        # Below about 0.76 the extended prefix can exceed the set; then no token is treated as frequent.
        self.combine = 100 * num >= 76 * den

    def lacks(self, n: int) -> int:
        """Most tokens of a set of ``n`` that a linked set can lack."""
        return n - -(-self.num * n // self.den)

    def adds(self, n: int) -> int:
        """Most tokens beyond a set of ``n`` that a linked set can have."""
        return (self.den - self.num) * n // self.num

    def longest(self, n: int) -> int:
        """Tokens of a set that its keys can need."""
        return min(n, 2 * self.lacks(n) + self.adds(n) + 3)

    def link(self, inter, n_a, n_b):
        return self.den * inter >= self.num * (n_a + n_b - inter)

    def distance(self, n_a, n_b):
        """Most tokens in which linked sets of these sizes can differ."""
        total = n_a + n_b
        return total - 2 * (-(-self.num * total // (self.den + self.num)))


def token_set(text: str | None, shingle: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct word n-grams; of fewer words, one hash of them all."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if len(words) < shingle:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), 1)] if words else [], np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(h) - shingle + 1
    with np.errstate(over="ignore"):
        x = np.full(n, shingle, np.uint64)
        for k in range(shingle):
            x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + h[k:k + n]
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(32)
    return np.unique(x)


def packed(tokens: np.ndarray) -> bytes:
    """The upper ``PREFIX_BYTES`` bytes of tokens."""
    return (tokens >> np.uint64(64 - 8 * PREFIX_BYTES)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :PREFIX_BYTES].tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    """Tokens of :func:`packed`, with zeros for their lower bytes."""
    out = np.zeros((len(raw) // PREFIX_BYTES, 8), np.uint8)
    out[:, 8 - PREFIX_BYTES:] = np.frombuffer(raw, np.uint8).reshape(-1, PREFIX_BYTES)
    return out.view("<u8").ravel()


def class_id(tokens: np.ndarray, seed: int = 0) -> tuple[int, int]:
    """The id of a set, and 64 more bits that tell whether two sets share it."""
    digest = xxhash.xxh3_128_digest(tokens.tobytes(), seed)
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)


def bucket_counts(tokens: np.ndarray, buckets: int = BUCKETS) -> bytes:
    """Tokens by the upper bits of their hash, 255 at most; ``buckets`` is a power of two."""
    upper = tokens >> np.uint64(65 - buckets.bit_length())
    return np.minimum(np.bincount(upper, minlength=buckets), 255).astype(np.uint8).tobytes()


def fine_counts(tokens: np.ndarray) -> bytes | None:
    """Counts in as many buckets as a large set needs; a smaller one has no more than ``BUCKETS``."""
    buckets = 1 << (-(-len(tokens) // PER_COUNT) - 1).bit_length()
    return bucket_counts(tokens, buckets) if buckets > BUCKETS else None


def differ_at_least(x: bytes, y: bytes) -> int:
    """Tokens in which two sets differ at least, by counts in buckets of either number."""
    x, y = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    buckets = min(len(x), len(y))
    x, y = (v.reshape(buckets, -1).sum(axis=1, dtype=np.int64) for v in (x, y))
    return int(np.abs(x - y).sum())


def classes(df: DataFrame, id_col: str, text_col: str, rule: Rule, row_col: str | None) -> tuple[DataFrame, int]:
    """``doc_id, row_id, text_hash, sid, n, prefix, counts, fine``, a row per document, and the seed of the ids.

    ``prefix``, ``counts`` and, for large sets, ``fine`` are given for a task's first document of each class, and only for
    sets large enough to link to a different set.
    """
    seed = 0
    while True:
        described = described_by(df, id_col, text_col, rule, row_col, seed)
        shared = described.groupBy("sid").agg(F.min("other").alias("a"), F.max("other").alias("b")).filter("a <> b")
        if not shared.limit(1).count():
            return described.drop("other"), seed
        seed += 1


def described_by(df: DataFrame, id_col: str, text_col: str, rule: Rule, row_col: str | None, seed: int) -> DataFrame:
    names = ["doc_id", "row_id", "text_hash", "sid", "other", "n", "prefix", "counts", "fine"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), *[pa.binary()] * 3]

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for b in batches:
            sid, other, size, prefix, counts, fine = [], [], [], [], [], []
            for text in b.column("text").to_pylist():
                t = token_set(text, rule.shingle)
                n = len(t)
                s, more = class_id(t, seed) if n else (None, None)
                sid.append(s)
                other.append(more)
                size.append(n)
                if n and s not in met and rule.lacks(n) + rule.adds(n) > 0:
                    met.add(s)
                    prefix.append(packed(t[:rule.longest(n)]))
                    counts.append(bucket_counts(t))
                    fine.append(fine_counts(t))
                else:
                    for column in (prefix, counts, fine):
                        column.append(None)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("row_id"), b.column("text_hash"),
                 *(pa.array(c, t) for c, t in zip((sid, other, size, prefix, counts, fine), types[3:]))], names)

    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    frame = df.select(F.col(id_col).cast("long").alias("doc_id"), row.alias("row_id"),
                      F.xxhash64(F.col(text_col)).alias("text_hash"), F.col(text_col).alias("text"))
    return shared_table(frame.mapInArrow(
        describe, "doc_id long, row_id long, text_hash long, sid long, other long, n long, prefix binary, counts binary, fine binary"), "classes")


def upper_half(tokens: np.ndarray) -> np.ndarray:
    """What tokens are counted by: half of the hash, which any two documents see alike."""
    return (tokens >> np.uint64(32)).astype(np.uint32)


def keys_of(tokens: np.ndarray, n: int, frequent: np.ndarray | None, rule: Rule, rare_only: bool = False) -> np.ndarray:
    """Keys of one class: rare tokens, and (unless ``rare_only``) frequent ones combined with the next, as far as needed.

    ``frequent`` is sorted; with None all tokens are frequent.
    """
    lacks, adds = rule.lacks(n), rule.adds(n)
    if frequent is None:
        hot = np.ones(len(tokens), bool)
    elif not len(frequent):
        return tokens[:lacks + 1]
    else:
        upper = upper_half(tokens)
        hot = frequent[np.minimum(np.searchsorted(frequent, upper), len(frequent) - 1)] == upper
    enough = np.arange(1, len(tokens) + 1) >= lacks + np.minimum(np.cumsum(hot), lacks + adds) + 1
    length = int(np.argmax(enough)) + 1 if enough.any() else len(tokens)
    if rare_only:
        return tokens[:length][~hot[:length]]
    following = np.append(tokens[1:], np.uint64(0))[:length]
    tokens, hot = tokens[:length], hot[:length]
    with np.errstate(over="ignore"):
        pair = (tokens ^ (tokens >> np.uint64(30))) * np.uint64(0x9E3779B97F4A7C15) + following
        pair = (pair ^ (pair >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return np.where(hot, pair, tokens)


def other_order(tokens: np.ndarray, seed: int) -> np.ndarray:
    """Tokens under other names, sorted by these: in an order that has nothing to do with theirs."""
    with np.errstate(over="ignore"):
        x = tokens ^ np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return np.sort(x)


def least_frequent(held: dict[int, int]) -> int:
    """From how many prefixes on a token is frequent, ``held[n]`` tokens being in ``n`` prefixes each: at most ``MOST_FREQUENT`` are."""
    least, tokens = FREQUENT + 1, 0
    for n in sorted(held, reverse=True):
        tokens += held[n]
        if tokens > MOST_FREQUENT:
            return max(least, n + 1)
    return least


def read_runs(batches: Iterator[pa.RecordBatch], rule: Rule, longest: int) -> Iterator[pa.RecordBatch]:
    """Candidates of keys sorted by (key, n, class): ``a, b, dense``; holds at most one short run."""
    pairs: set[tuple[int, int]] = set()
    stars: set[tuple[int, int]] = set()
    key, members, dense = None, [], False  # members: (n, sid) of a run that may still be short
    last_n = last_sid = first = None  # of a dense run

    def star(ns: list[int], sids: list[int]) -> None:
        nonlocal last_n, last_sid, first
        for n, s in zip(ns, sids):
            if s == last_sid:
                continue
            if first is None or rule.num * n > rule.den * last_n:  # no set from here on links to one before
                first = s
            else:
                stars.add((first, s))
            last_n, last_sid = n, s

    def finish() -> None:
        if not dense:
            for i, (n, s) in enumerate(members):
                for m, t in members[i + 1:]:
                    if rule.num * m > rule.den * n:
                        break
                    pairs.add((s, t) if s < t else (t, s))

    def drain() -> pa.RecordBatch:
        rows = [(a, b, False) for a, b in pairs] + [(a, b, True) for a, b in stars]
        pairs.clear()
        stars.clear()
        columns = list(zip(*rows)) or [()] * 3
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.bool_())],
                                          ["a", "b", "dense"])

    for b in batches:
        k, n, s = (b.column(c).to_numpy() for c in ("key", "n", "sid"))
        if not len(k):
            continue
        starts = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
        ends = np.r_[starts[1:], len(k)]
        # Runs of one row inside the batch give nothing.
        for lo, hi in ((lo, hi) for lo, hi in zip(starts.tolist(), ends.tolist()) if hi - lo > 1 or lo == 0 or hi == len(k)):
            if k[lo] != key:
                finish()
                key, members, dense, last_n, last_sid, first = k[lo], [], False, None, None, None
            ns, sids = n[lo:hi].tolist(), s[lo:hi].tolist()
            if not dense:
                for x, y in zip(ns, sids):
                    if not members or members[-1][1] != y:
                        members.append((x, y))
                if len(members) > longest:
                    dense = True
                    star(*map(list, zip(*members)))
                    members = []
            else:
                star(ns, sids)
        if len(pairs) + len(stars) > DRAIN:
            yield drain()
    finish()
    yield drain()


def spanning(links: Iterator[tuple[int, int]], size: int) -> list[tuple[int, int]]:
    """Links that connect what others have not connected yet."""
    parent = list(range(size))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for a, b in links:
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[ra] = rb
            out.append((a, b))
    return out


def block_links(differ: list[np.ndarray], of: np.ndarray, rule: Rule, n: np.ndarray, lacks: np.ndarray, size: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among sets; with two blocks in ``of``, links across only.

    A set of ``n`` tokens is given by the tokens in which it differs from a common set of
    ``size`` tokens, of which it ``lacks`` so many.
    """
    tokens = np.concatenate(differ)
    owner = np.repeat(np.arange(len(differ)), [len(x) for x in differ])
    _, code, times = np.unique(tokens, return_inverse=True, return_counts=True)
    shared = times > 1
    column = np.cumsum(shared) - 1
    keep = shared[code]
    code, owner = column[code[keep]], owner[keep]
    order = np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    left, right = (np.flatnonzero(of == of.min()), np.flatnonzero(of == of.max()))
    row_l, row_r = np.full(len(differ), -1), np.full(len(differ), -1)
    row_l[left], row_r[right] = np.arange(len(left)), np.arange(len(right))
    inter = np.zeros((len(left), len(right)), np.float32)
    for lo in range(0, int(shared.sum()), VOCABULARY):
        a, b = np.searchsorted(code, [lo, lo + VOCABULARY])
        x, y = (np.zeros((len(r), VOCABULARY), np.float32) for r in (left, right))
        for m, rows in ((x, row_l), (y, row_r)):
            at = rows[owner[a:b]]
            m[at[at >= 0], code[a:b][at >= 0] - lo] = 1
        inter += x @ y.T
    inter = np.rint(inter).astype(np.int64) + size - lacks[left][:, None] - lacks[right][None, :]
    i, j = np.nonzero(rule.link(inter, n[left][:, None], n[right][None, :]))
    i, j = left[i], right[j]
    return spanning(zip(i[i != j].tolist(), j[i != j].tolist()), len(differ))


def runs_of(posted: DataFrame, rule: Rule) -> DataFrame:
    """Candidates ``a, b, dense`` of keys ``key, n, sid``, written."""
    longest = RUN
    runs = posted.repartition(shuffle_partitions(posted.sparkSession), "key").sortWithinPartitions("key", "n", "sid")
    return shared_table(runs.mapInArrow(lambda it: read_runs(it, rule, longest), "a long, b long, dense boolean"), "runs")


def near_pairs(found: DataFrame, summary: DataFrame, rule: Rule) -> DataFrame:
    """The pairs ``a, b`` among candidates whose counts (``sid, n, counts, fine``) let them link, written."""
    counted = summary.select("sid", "n", "counts").dropDuplicates(["sid"])
    pairs = found.filter(~F.col("dense")).select("a", "b").distinct()
    pairs = (pairs.join(counted.toDF("a", "n_a", "counts_a"), "a").join(counted.toDF("b", "n_b", "counts_b"), "b"))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(-1, BUCKETS).astype(np.int16) for c in ("counts_a", "counts_b"))
            at_least = np.abs(x - y).sum(axis=1)
            n_a, n_b = (b.column(c).to_numpy() for c in ("n_a", "n_b"))
            keep = np.flatnonzero(at_least <= rule.distance(n_a, n_b))
            yield b.select(["a", "b", "n_a", "n_b"]).take(keep)

    def nearer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            most = rule.distance(b.column("n_a").to_numpy(), b.column("n_b").to_numpy()).tolist()
            keep = [r for r, (x, y, m) in enumerate(zip(b.column("fine_a").to_pylist(), b.column("fine_b").to_pylist(), most)) if differ_at_least(x, y) <= m]
            yield b.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    close = shared_table(pairs.select("a", "b", "n_a", "n_b", "counts_a", "counts_b").mapInArrow(near, "a long, b long, n_a long, n_b long"), "near")
    large = F.least("n_a", "n_b") > PER_COUNT * BUCKETS
    of_large = close.filter(large).select(F.explode(F.array("a", "b")).alias("sid")).distinct()
    fine = summary.filter(F.col("fine").isNotNull()).select("sid", "fine").join(bounded_broadcast(of_large, MOST_BROADCAST), "sid", "left_semi").dropDuplicates(["sid"])
    nearest = (close.filter(large).join(fine.toDF("a", "fine_a"), "a").join(fine.toDF("b", "fine_b"), "b")
               .select("a", "b", "n_a", "n_b", "fine_a", "fine_b").mapInArrow(nearer, "a long, b long"))
    return shared_table(close.filter(~large).select("a", "b").unionByName(nearest), "pairs")


def candidates(described: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """Pairs ``a, b`` of classes that may link, and dense groups ``node, component``: every link lies in one of them."""
    spark = described.sparkSession
    heads = described.filter(F.col("prefix").isNotNull())

    def keys(frequent, rare_only: bool):
        """A function that gives the keys of classes, with the set of frequent tokens broadcast."""
        shipped = spark.sparkContext.broadcast(frequent)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                prefixes = b.column("prefix").to_pylist()
                found = [keys_of(unpacked(x), n, shipped.value, rule, rare_only) for x, n in zip(prefixes, b.column("n").to_pylist())]
                lengths = np.array([len(x) for x in found], int)
                flat = np.concatenate(found) if found else np.zeros(0, np.uint64)
                if rare_only:
                    yield pa.RecordBatch.from_arrays([pa.array(upper_half(flat).view(np.int32))], ["key"])
                    continue
                yield pa.RecordBatch.from_arrays(
                    [pa.array(flat.view(np.int64)), pa.array(np.repeat(b.column("n").to_numpy(), lengths)), pa.array(np.repeat(b.column("sid").to_numpy(), lengths))],
                    ["key", "n", "sid"])

        return run

    frequent = np.zeros(0, np.uint32)
    if rule.combine:
        for _ in range(COUNTS):
            tokens = heads.select("sid", "n", "prefix").mapInArrow(keys(frequent, True), "key int")
            held = shared_table(tokens.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > FREQUENT), "frequent")
            least = least_frequent({r["n"]: r["tokens"] for r in held.groupBy("n").agg(F.count(F.lit(1)).alias("tokens")).collect()})
            hot = held.filter(F.col("n") >= least).select("key").toArrow().column("key").to_numpy()
            frequent = np.union1d(frequent, hot.astype(np.int32).view(np.uint32))

    found = runs_of(heads.select("sid", "n", "prefix").mapInArrow(keys(frequent, False), "key long, n long, sid long"), rule)
    pairs = near_pairs(found, heads, rule)
    return pairs, shared_table(connected_components(found.filter("dense").select("a", "b")), "dense")


def keyed_again(sets: DataFrame, dense: DataFrame, rule: Rule) -> tuple[list[DataFrame], DataFrame]:
    """Dense groups by keys of other orders of tokens, where they are large: pairs ``a, b`` besides, and smaller groups."""
    pairs, done, before, seed = [], [], math.inf, 0
    while True:
        large = dense.groupBy("component").agg(F.count(F.lit(1)).alias("nodes")).filter(F.col("nodes") > MOST_BLOCKS * BLOCK)
        nodes = large.agg(F.sum("nodes").alias("n")).first()["n"] or 0
        if not nodes or 4 * nodes > 3 * before:
            done.append(dense)
            break
        large = bounded_broadcast(large.select("component"), MOST_BROADCAST)
        done.append(dense.join(large, "component", "left_anti").select("node", "component"))
        members = dense.join(large, "component", "left_semi").select(F.col("node").alias("sid"), "component")
        members = sets.join(bounded_broadcast(members, MOST_BROADCAST), "sid").select("sid", "component", "tokens")

        def keys(batches: Iterator[pa.RecordBatch], seed: int = seed) -> Iterator[pa.RecordBatch]:
            for b in batches:
                sizes, found = [], []
                for tokens, component in zip(b.column("tokens").to_pylist(), b.column("component").to_numpy().view(np.uint64)):
                    tokens = other_order(np.frombuffer(tokens, np.uint64), seed)
                    sizes.append(len(tokens))
                    found.append(keys_of(tokens[:rule.longest(len(tokens))], len(tokens), None if rule.combine else np.zeros(0, np.uint32), rule) ^ component)
                lengths = np.array([len(x) for x in found], int)
                flat = np.concatenate(found) if found else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(flat.view(np.int64)), pa.array(np.repeat(np.array(sizes, np.int64), lengths)), pa.array(np.repeat(b.column("sid").to_numpy(), lengths))],
                    ["key", "n", "sid"])

        def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                own = [np.frombuffer(x, np.uint64) for x in b.column("tokens").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [b.column("sid"), pa.array([len(t) for t in own], pa.int64()), pa.array(map(bucket_counts, own), pa.binary()), pa.array(map(fine_counts, own), pa.binary())],
                    ["sid", "n", "counts", "fine"])

        found = runs_of(members.mapInArrow(keys, "key long, n long, sid long"), rule)
        summary = shared_table(members.select("sid", "tokens").mapInArrow(summed, "sid long, n long, counts binary, fine binary"), "summary")
        pairs.append(near_pairs(found, summary, rule))
        dense = shared_table(connected_components(found.filter("dense").select("a", "b")), "dense")
        before, seed = nodes, seed + 1
    return pairs, reduce(DataFrame.unionByName, done)


def links(df: DataFrame, described: DataFrame, pairs: DataFrame, dense: DataFrame, seed: int, id_col: str, text_col: str, rule: Rule) -> DataFrame:
    """Links ``(a, b)`` between classes that connect what all links connect."""
    # Whole sets of the classes concerned, from one document each.
    wanted = (pairs.select(F.explode(F.array("a", "b")).alias("sid")).unionByName(dense.select(F.col("node").alias("sid"))).distinct())
    of_class = described.join(wanted, "sid", "left_semi")
    some = (of_class.groupBy("sid").agg(F.min(F.struct("text_hash", "doc_id")).alias("d"))
            .select(F.col("d.text_hash").alias("h"), F.col("d.doc_id").alias("i")))
    texts = df.select(F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("text_hash"), F.col(id_col).cast("long").alias("doc_id"))
    few = bounded_broadcast(some.distinct(), MOST_BROADCAST)  # counted first; beyond the bound the texts shuffle
    texts = texts.join(few, (F.col("text_hash") == F.col("h")) & F.col("doc_id").eqNullSafe(F.col("i")))
    if of_class.groupBy("text_hash", "doc_id").count().filter("count > 1").limit(1).count():  # repeated rows: one of each
        texts = texts.dropDuplicates(["text_hash", "doc_id"])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [token_set(t, rule.shingle) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([class_id(t, seed)[0] for t in sets], pa.int64()), pa.array([t.tobytes() for t in sets], pa.binary())],
                                             ["sid", "tokens"])

    sets = shared_table(texts.select("text").mapInArrow(whole, "sid long, tokens binary"), "sets")
    more, dense = keyed_again(sets, dense, rule)
    if more:
        pairs = shared_table(reduce(DataFrame.unionByName, [pairs, *more]).distinct(), "pairs")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for r, (x, y) in enumerate(zip(b.column("x").to_pylist(), b.column("y").to_pylist())):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if rule.link(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)):
                    keep.append(r)
            yield pa.RecordBatch.from_arrays([b.column("a").take(pa.array(keep, pa.int64())), b.column("b").take(pa.array(keep, pa.int64()))], ["a", "b"])

    def verified(some: DataFrame) -> DataFrame:
        return (some.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b").select("a", "b", "x", "y").mapInArrow(verify, "a long, b long"))

    first = pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    first_links = shared_table(verified(first), "links")
    met = shared_table(connected_components(first_links), "met")
    left = (pairs.join(first, ["a", "b"], "left_anti")
            .join(met.toDF("a", "with_a"), "a", "left").join(met.toDF("b", "with_b"), "b", "left")
            .filter(F.coalesce("with_a", "a") != F.coalesce("with_b", "b")).select("a", "b"))
    found_links = first_links.unionByName(verified(left))

    # Each class of a dense group by its difference from the set of the group's least class.
    heads_of = dense.filter(F.col("node") == F.col("component")).select(F.col("node").alias("sid"))
    held = sets.join(heads_of, "sid").agg(F.sum(F.octet_length("tokens") / 8).alias("n")).first()["n"] or 0
    common = sets.join(bounded_broadcast(heads_of, MOST_BROADCAST), "sid").toDF("component", "common")
    members = sets.join(bounded_broadcast(dense.withColumnRenamed("node", "sid"), MOST_BROADCAST), "sid")
    members = members.join(F.broadcast(common) if held <= MOST_TOKENS else common, "component")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for mine, theirs in zip(b.column("tokens").to_pylist(), b.column("common").to_pylist()):
                mine, theirs = np.frombuffer(mine, np.uint64), np.frombuffer(theirs, np.uint64)
                differ = np.setxor1d(mine, theirs, assume_unique=True)
                rows.append((len(mine), (len(differ) + len(theirs) - len(mine)) // 2, len(theirs), differ.tobytes()))
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [b.column("component"), b.column("sid"), *(pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 3 + [pa.binary()]))],
                ["component", "sid", "n", "lacks", "size", "differ"])

    dense_sets = shared_table(members.select("component", "sid", "tokens", "common")
                              .mapInArrow(compare, "component long, sid long, n long, lacks long, size long, differ binary"), "differences")

    # Sizes of linked sets differ by a factor of den / num at most, so by one band.
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(max(1e-6, math.log(rule.den / rule.num) * (1 + 1e-9))))
    banded = dense_sets.select("component", "sid", band.alias("band"))
    blocks = banded.groupBy("component", "band").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    own = banded.join(blocks, ["component", "band"]).select(
        "component", "sid", F.struct("band", F.pmod(F.xxhash64("sid"), F.col("blocks")).alias("block")).alias("own"),
        F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"))
    units = (own.join(blocks, ["component", "band"])
             .withColumn("other", F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
                                                        lambda k: F.struct(F.col("band"), k.alias("block")))))
             .select("component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "sid",
                     (F.col("own") <= F.col("other")).alias("first")).join(dense_sets.drop("component"), "sid"))

    def solve(unit: pa.Table) -> pa.Table:
        sids, of = unit.column("sid").to_numpy(), unit.column("first").to_numpy().astype(int)
        alone = unit.column("i")[0].as_py() != unit.column("j")[0].as_py() and of.min() == of.max()  # the other block is empty
        rows = [] if alone else block_links([np.frombuffer(x, np.uint64) for x in unit.column("differ").to_pylist()], of, rule,
                                            unit.column("n").to_numpy(), unit.column("lacks").to_numpy(), unit.column("size")[0].as_py())
        a, b = (np.array([r[k] for r in rows], int) for k in (0, 1))
        return pa.table([pa.array(sids[a], pa.int64()), pa.array(sids[b], pa.int64())], names=["a", "b"])

    return found_links.unionByName(units.groupBy("component", "i", "j").applyInArrow(solve, "a long, b long"))


def jaccard_join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, num: int = 90, den: int = 100,
                 row_col: str | None = None) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, class_id, row_id``.

    Documents link when ``den * |A and B| >= num * |A or B|``. ``component_id`` is the smallest
    ``doc_id`` reachable by links, the own one included; documents with the same ``class_id``
    have the same set. Null and wordless texts have no tokens, no class and no links. A null
    ``doc_id`` takes part but is never a component's id, unless there is no other (then null).
    Repeated rows belong to one class. An empty input gives an empty result.
    """
    rule = Rule(shingle, num, den)
    described, seed = classes(df, id_col, text_col, rule, row_col)
    pairs, dense = candidates(described, rule)
    wide, described = described, shared_table(described.select("doc_id", "row_id", "text_hash", "sid", "n"), "documents")
    drop_table(wide)  # its prefixes and counts are large
    joined = connected_components(links(df, described, pairs, dense, seed, id_col, text_col, rule))
    per_class = (described.filter(F.col("sid").isNotNull()).groupBy("sid").agg(F.min("doc_id").alias("least"))
                 .join(joined.withColumnRenamed("node", "sid"), "sid", "left").withColumn("component", F.coalesce("component", "sid")))
    ids = per_class.groupBy("component").agg(F.min("least").alias("component_id"))
    known = per_class.join(ids, "component").select("sid", "component_id")
    return (described.select("doc_id", "row_id", "sid", "n").join(known, "sid", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("sid").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                    F.col("sid").alias("class_id"), "row_id"))
