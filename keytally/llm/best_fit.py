"""Best-fit packing: largest items first, each into the smallest gap that holds it.

Pieces (a document's token ids, cut at the sequence length only) are packed into sequences of at
most ``capacity`` tokens. Items of one size are alike, so what best fit does with them follows from
their numbers: items are range-sorted by size (ties in hash order, so that a size that a third of
all items have is spread over many tasks), the driver sees how many of each size each range has,
plans by these counts which of a size's items go to which sequences (:func:`plan`), and every item
finds its place in the plan by its number. There are at most ``capacity`` sizes, however many items.

With more sizes than :data:`MOST_SIZES` (a capacity far beyond that of training sequences) packing
goes in bulk-synchronous rounds instead. State is two tables, waiting items ``(id, size)`` and gaps
``(bin, gap)``. A round

1. range-sorts items and gaps together by size, items before gaps of the same size, ties in
   hash order, so that a size that a third of all items have is spread over many tasks;
2. sweeps each range: every gap takes the largest waiting items that fit, its predecessors, so
   each item goes to its successor among the gaps; what a range cannot match is numbered;
3. matches the rest across ranges by rank: the driver sees two counts per range and pairs runs
   of numbers; a join with these runs gives both sides of a pair its number, by which they meet;
4. updates the gaps. No item fits any more: the largest items open new sequences, as many as
   the waiting tokens need at least.
"""

from __future__ import annotations

import bisect
import math
import unicodedata
import zlib
from collections.abc import Iterator
from functools import reduce
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from keytally.llm.common import parts_for, shared_table, tokenizer_from, tokenizer_json

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"
END_ID = 0
#: Most sizes whose counts the driver plans by (at most some ten steps of the plan each, 48 bytes a step).
MOST_SIZES = 1 << 14
#: Items (and gaps) in one range of the sort.
RANGE_ROWS = 200_000
#: Most pairs of a round whose items are broadcast to meet their gaps (24 bytes each).
MOST_BROADCAST = 1 << 18
#: Words of a generation, beside those of one group of texts; a Python worker remembers two
#: generations while it tokenises and one afterwards, at about 200 bytes a word.
CACHE_WORDS = 250_000
LONGEST_CACHED = 48


class WordIds:
    """Token ids of texts, word by word: no token of this vocabulary spans white space.

    Texts are split, in ASCII lower case (which the vocabulary has anyway), into codes of their
    distinct words by Arrow; only distinct words are looked up, and numpy lays out their ids. The
    Python worker remembers words in two generations, so that those in use stay. A word of
    letters with punctuation behind it has the ids of both; unknown words of letters go to the
    tokenizer together, with a mark between them that is a token of its own. Texts with special
    strings go to the tokenizer whole.
    """

    TAIL = b".,;:!?$%&*#|"
    MARK = "|"

    def __init__(self, spec: str):
        import tokenizers

        self.tokenizer = tokenizer_from(spec)
        # [words in use, words of the generation before]
        self.known: list[dict[bytes, bytes]] = vars(tokenizers).setdefault("_keytally_word_ids", {}).setdefault(hash(spec), [{}, {}])
        (self.mark,) = self._encode([self.MARK])[0]

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def ids(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        texts = pc.fill_null(texts, "")
        special = pc.match_substring(texts, "<|")
        words = pc.ascii_split_whitespace(pc.ascii_lower(pc.if_else(special, "", texts)))
        coded = words.flatten().dictionary_encode()
        distinct = self._of(coded.dictionary.cast(pa.binary()).to_pylist())
        raw = np.frombuffer(b"".join(distinct), "<u4")
        size = np.fromiter(map(len, distinct), np.int32, len(distinct)) // 4
        code = coded.indices.to_numpy()
        each = size[code]
        ends = np.concatenate([[0], np.cumsum(each)])  # after each word
        start = ((np.cumsum(size) - size)[code] - ends[:-1]).astype(np.int32)  # from a place in the output to one in raw
        out = raw[np.repeat(start, each) + np.arange(ends[-1], dtype=np.int32)]
        at = ends[np.concatenate([[0], np.cumsum(pc.list_value_length(words).to_numpy())])]
        for k, whole in enumerate(special.to_pylist()):
            if whole:
                yield np.array(self.tokenizer.encode(texts[k].as_py(), add_special_tokens=False).ids, "<u4").tobytes()
            else:
                yield out[at[k]:at[k + 1]].tobytes()

    def rest(self) -> None:
        """Keep less while the worker does other things."""
        self.known[1] = {}

    def _of(self, words: list[bytes]) -> list[bytes]:
        if len(self.known[0]) > CACHE_WORDS:
            self.known[:] = {}, self.known[0]
        used, before = self.known
        out = list(map(used.get, words))
        unknown = [k for k, ids in enumerate(out) if ids is None]
        new = []
        for k in unknown:
            w = words[k]
            if w in before:
                used[w] = before[w]
            else:
                new.append(w)
        long = self.learn(new)
        for k in unknown:
            out[k] = used[words[k]]
        for w in long:
            used.pop(w, None)
        return out

    def learn(self, new: list[bytes]) -> list[bytes]:
        """Remember the ids of words; gives those too long to be kept."""
        cache, split, plain, other = self.known[0], [], set(), set()
        for w in new:
            if w.isalpha():  # ASCII letters
                plain.add(w)
                continue
            stem = w.rstrip(self.TAIL)
            if not self._letters(stem):
                other.add(w)
                continue
            if stem not in cache:
                plain.add(stem)
            if len(stem) < len(w):
                tail = w[len(stem):]
                split.append((w, stem, tail))
                if tail not in cache:
                    other.add(tail)
        if plain:
            names = list(plain)
            stream = np.array(self._encode([f" {self.MARK} ".join(w.decode("utf-8") for w in names)])[0], "<u4")
            ends = np.append(np.flatnonzero(stream == self.mark), len(stream)).tolist()
            raw, at = stream.tobytes(), 0
            for w, end in zip(names, ends):
                cache[w], at = raw[4 * at:4 * end], end + 1
        if other:
            names = list(other)
            cache.update(zip(names, (np.array(ids, "<u4").tobytes() for ids in self._encode([w.decode("utf-8", "surrogatepass") for w in names]))))
        for w, stem, tail in split:
            cache[w] = cache[stem] + cache[tail]
        return [w for w in (*new, *plain) if len(w) > LONGEST_CACHED]

    @staticmethod
    def _letters(stem: bytes) -> bool:
        """Whether the tokenizer sees letters only, normalised and in lower case."""
        if stem.isalpha():  # ASCII
            return True
        try:
            text = stem.decode("utf-8")
        except UnicodeDecodeError:
            return False
        return text.isalpha() and unicodedata.normalize("NFC", text).lower().isalpha()


def grouped(texts: pa.Array, size: int = 1 << 23) -> Iterator[pa.Array]:
    """Neighbouring texts together, about ``size`` bytes at a time."""
    lengths = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        held = lengths[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(lengths, held + size)))
        yield texts.slice(start, end - start)
        start = end


def token_pieces(df: DataFrame, id_col: str, text_col: str, capacity: int, tokenizer: str, keep_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``): a row per piece, in parallel over the texts."""
    spec = tokenizer_json(tokenizer)
    end = np.array([END_ID], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(spec)
        for b in batches:
            rows: list[tuple] = []
            ids_of = (x for group in grouped(b.column("text")) for x in words.ids(group))
            for i, ids in zip(b.column("doc_id").to_pylist(), ids_of):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    rows.append((i, piece, at // 4, len(part) // 4, zlib.crc32(part), part if keep_ids else None))
            columns = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)
        words.rest()

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    frame = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    pieces = frame.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary")
    return pieces if keep_ids else pieces.drop("ids")


MATCHED, FREE_GAP, WAITING, USED_GAP, PAIRED, COUNTED = range(6)
SWEPT = "part int, what int, idx long, id long, size long, bin long, gap long"


def _rows(found: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*found)) or [()] * 7
    types = (pa.int32(), pa.int32(), *[pa.int64()] * 5)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [x.split()[0] for x in SWEPT.split(", ")])


def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Match one range, sorted by size: each gap takes the largest items before it that are left, while they fit.

    Rows are ``(part, what, idx, id, size, bin, gap)``: a match with the gap before it, a gap that
    found no item (numbered by ``idx``), an item that no gap took (numbered), what is left of a gap;
    last, for each of these kinds (``idx``), their number (``id``) and least item (``size``).
    """
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    waiting: list[tuple[int, int]] = []
    free = matched = 0
    for b in batches:
        found: list[tuple] = []
        for size, kind, ident in zip(b.column("size").to_pylist(), b.column("kind").to_pylist(), b.column("id").to_pylist()):
            if kind == 0:
                waiting.append((size, ident))
            elif waiting:
                while waiting and waiting[-1][0] <= size:
                    fits, item = waiting.pop()
                    found.append((part, MATCHED, 0, item, fits, ident, size))
                    size -= fits
                if size:
                    found.append((part, USED_GAP, 0, None, None, ident, size))
            else:
                found.append((part, FREE_GAP, free, None, None, ident, size))
                free += 1
        matched += sum(r[1] == MATCHED for r in found)
        yield _rows(found)
    for at in range(0, len(waiting), 10_000):
        yield _rows([(part, WAITING, at + k, item, size, None, None) for k, (size, item) in enumerate(waiting[at:at + 10_000])])
    counts = ((MATCHED, matched, None), (FREE_GAP, free, None), (WAITING, len(waiting), min(waiting)[0] if waiting else None))
    yield _rows([(part, COUNTED, kind, n, least, None, None) for kind, n, least in counts if n])


def runs_across(free: dict[int, int], waiting: dict[int, int]) -> list[tuple[int, int, int, int, int, int]]:
    """Pair ranges' free gaps with waiting items of lower ranges, largest first.

    Each run is ``(gap_part, gap_idx, item_part, item_idx_end, n, number)``: gap ``gap_idx + r``
    takes item ``item_idx_end - 1 - r`` and the pair has the number ``number + r``.
    """
    stack: list[list[int]] = []  # [part, items left] of lower ranges, nearest last
    runs, number = [], 0
    for part in sorted(free.keys() | waiting.keys()):
        at, left = 0, free.get(part, 0)
        while left and stack:
            n = min(left, stack[-1][1])
            runs.append((part, at, stack[-1][0], stack[-1][1], n, number))
            number, at, left = number + n, at + n, left - n
            stack[-1][1] -= n
            if not stack[-1][1]:
                stack.pop()
        if waiting.get(part):
            stack.append([part, waiting[part]])
    return runs


PAIRS = "part int, what int, low long, high long, base long, step int"


def numbers(runs: list[tuple[int, int, int, int, int, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """For each run and side a row ``PAIRS``: of rows ``low <= idx < high`` the pair's number is ``base + step * idx``."""
    return [row for g_part, g_at, i_part, i_end, n, number in runs for row in (
        (g_part, FREE_GAP, g_at, g_at + n, number - g_at, 1), (i_part, WAITING, i_end - n, i_end, number + i_end - 1, -1))]


def opening(sizes: dict[int, int], least: int) -> tuple[int, int]:
    """``(size, n)``: all items above the size open a sequence each, and ``n`` items of the size itself."""
    for size in sorted(sizes, reverse=True):
        if sizes[size] >= least:
            return size, least
        least -= sizes[size]
    return 0, 0


def plan(sizes: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Sequential best-fit of ``sizes[size]`` items of each size, largest first, all alike ones at a time.

    Steps ``(size, low, bin, each, at)``: of the size's items those from number ``low`` on (to the
    next step's) fill the sequences from ``bin`` on, ``each`` of them in one, from offset ``at``.
    """
    steps, opened = [], 0
    alike: dict[int, list[tuple[int, int]]] = {}  # by gap: sequences (first, number)
    gaps: list[int] = []  # in order

    def keep(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in alike:
                bisect.insort(gaps, gap)
            alike.setdefault(gap, []).append((first, n))

    for size in sorted(sizes, reverse=True):
        low, n = 0, sizes[size]
        while low < n:
            at = bisect.bisect_left(gaps, size)
            if at < len(gaps):
                gap = gaps[at]
                first, bins = alike[gap].pop()
                if not alike[gap]:
                    del alike[gap], gaps[at]
            else:
                gap, first, bins = capacity, opened, -(-(n - low) // (capacity // size))
                opened += bins
            each = gap // size  # what one item leaves of the smallest gap is the smallest again, if another fits
            taken = min(n - low, bins * each)
            full, rest = divmod(taken, each)
            steps.append((size, low, first, each, capacity - gap))
            keep(gap - each * size, first, full)
            keep(gap - rest * size, first + full, 1 if rest else 0)
            keep(gap, first + full + (rest > 0), bins - full - (rest > 0))
            low += taken
    return steps


def pack(items: DataFrame, capacity: int = CAPACITY, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Best-fit of items ``(id, size)``, sizes 1 .. capacity, ids unique: ``id, bin, at``."""
    spark = items.sparkSession
    sized = items.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("size").alias("sizes")).first()
    if not sized["n"]:
        return spark.createDataFrame([], "id long, bin long, at long")
    if sized["sizes"] > MOST_SIZES:
        return pack_in_rounds(items, capacity, range_rows)
    ranged = (items.select("id", "size", F.xxhash64("id", F.lit(7)).alias("h")).repartitionByRange(parts_for(sized["n"], range_rows), "size", "h")
              .sortWithinPartitions("size", "h", "id"))
    # The number of a row: its range in the upper bits, its place in the range in the lower 33.
    numbered = shared_table(ranged.select("id", "size", F.monotonically_increasing_id().alias("number")), "numbered")
    seen = numbered.groupBy("size", F.shiftright("number", 33).alias("part")).agg(F.min("number").alias("first"), F.count(F.lit(1)).alias("n"))
    seen = sorted(tuple(r) for r in seen.collect())  # a row per size, and one more per range
    sizes: dict[int, int] = {}
    firsts, shifts = [], []  # of a range's items of one size: the first number, what makes numbers those among all items
    for total, (size, _, first, n) in zip(accumulate((r[3] for r in seen), initial=0), seen):
        sizes[size] = sizes.get(size, 0) + n
        firsts.append(first)
        shifts.append(total - first)
    steps = np.array(plan(sizes, capacity), np.int64)
    held = np.array(sorted(sizes))
    begins = dict(zip(held.tolist(), accumulate((sizes[x] for x in held.tolist()), initial=0)))
    steps[:, 1] += np.array([begins[x] for x in steps[:, 0].tolist()])
    order, runs = np.argsort(firsts), np.array([firsts, shifts], np.int64)
    shipped = spark.sparkContext.broadcast((runs[:, order], steps[np.argsort(steps[:, 1])]))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (first, shift), planned = shipped.value
        for b in batches:
            number, size = b.column("number").to_numpy(), b.column("size").to_numpy()
            number = number + shift[np.searchsorted(first, number, "right") - 1]
            _, low, bin_, each, at = planned[np.searchsorted(planned[:, 1], number, "right") - 1].T
            row, place = np.divmod(number - low, each)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(bin_ + row), pa.array(at + place * size)], ["id", "bin", "at"])

    return numbered.select("id", F.col("size").cast("long").alias("size"), "number").mapInArrow(placed, "id long, bin long, at long")


def pack_in_rounds(items: DataFrame, capacity: int, range_rows: int = RANGE_ROWS) -> DataFrame:
    """As :func:`pack`, where the sizes are too many to plan by."""
    spark = items.sparkSession
    waiting, gaps, placed, left = items.select("id", "size"), None, [], -1
    while left:
        if gaps is None:  # open sequences: as many as the tokens need, at first also for all that cannot share one
            sizes = {r["size"]: r["n"] for r in waiting.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}
            if not sizes:
                break
            least = math.ceil(sum(s * n for s, n in sizes.items()) / capacity)
            if not placed:
                least = max(least, sum(n for s, n in sizes.items() if 2 * s > capacity))
            size, n = opening(sizes, least)
            # Which items of that one size: the hash classes that hold n of them at most, or one class.
            of_class = F.pmod(F.xxhash64("id", F.lit(len(placed))), F.lit(4096))
            classes, last, held = waiting.filter(F.col("size") == size).groupBy(of_class.alias("c")).count().collect(), -1, 0
            for r in sorted(classes):
                held += r["count"]
                if held > n and last >= 0:
                    break
                last = r["c"]
            opens = (F.col("size") > size) | ((F.col("size") == size) & (of_class <= F.lit(last)))
            state = shared_table(waiting.withColumn("opens", opens), "opened")
            placed.append(state.filter("opens").select("id", F.col("id").alias("bin"), F.lit(0).cast("long").alias("at")))
            gaps = state.filter("opens").select(F.col("id").alias("bin"), (F.lit(capacity) - F.col("size")).alias("gap"))
            waiting = state.filter(~F.col("opens")).select("id", "size")
            left, smallest = sum(sizes.values()), min(sizes)
        events = (waiting.select("size", F.lit(0).alias("kind"), "id")
                  .unionByName(gaps.filter(F.col("gap") >= smallest).select(F.col("gap").alias("size"), F.lit(1).alias("kind"), F.col("bin").alias("id"))))
        ranged = events.withColumn("h", F.xxhash64("id", F.lit(7))).repartitionByRange(parts_for(2 * left, range_rows), "size", "kind", "h") \
            .sortWithinPartitions("size", "kind", "h", "id")
        swept = shared_table(ranged.drop("h").mapInArrow(sweep, SWEPT), "swept")
        seen = swept.filter(F.col("what") == COUNTED).select("part", "idx", "id", "size").collect()  # three rows a range at most
        swept = swept.filter(F.col("what") != COUNTED)
        counts: list[dict[int, int]] = [{}, {}, {}]
        for part, kind, n, _ in seen:
            counts[kind][part] = n
        runs = runs_across(counts[FREE_GAP], counts[WAITING])
        if runs:  # both sides of a pair have its number, rows without a pair have none and stay where they are
            pairs = spark.createDataFrame(numbers(runs), PAIRS)  # two rows a run, of which there are at most two a range
            marked = (swept.join(F.broadcast(pairs.withColumnsRenamed({"part": "p", "what": "w"})),
                                 (F.col("part") == F.col("p")) & (F.col("what") == F.col("w")) & F.col("idx").between(F.col("low"), F.col("high") - 1), "left")
                      .withColumn("pair", F.col("base") + F.col("step") * F.col("idx")))
            gap_side = marked.filter((F.col("what") == FREE_GAP) & F.col("pair").isNotNull()).select("pair", "bin", "gap")
            item_side = marked.filter((F.col("what") == WAITING) & F.col("pair").isNotNull()).select("pair", "id", "size")
            few = sum(r[4] for r in runs) <= MOST_BROADCAST  # pairs, which have been counted
            paired = gap_side.join(F.broadcast(item_side) if few else item_side, "pair").select("id", "size", "bin", "gap")
            alone = marked.filter(F.col("pair").isNull())
            swept = shared_table(
                alone.select("what", "id", "size", "bin", "gap").unionByName(paired.withColumn("what", F.lit(PAIRED))), "matched")
        both = swept.filter(F.col("id").isNotNull() & F.col("bin").isNotNull())
        crossed = sum(r[4] for r in runs)
        left = sum(counts[WAITING].values()) - crossed
        waiting = swept.filter(F.col("bin").isNull()).select("id", "size")
        if sum(counts[MATCHED].values()) + crossed:
            placed.append(both.select("id", "bin", (F.lit(capacity) - F.col("gap")).alias("at")))
            # A gap goes on as it is, as what its matches left of it, or less the item of its pair.
            gaps = swept.filter(F.col("bin").isNotNull() & (F.col("what") != MATCHED)) \
                .select("bin", (F.col("gap") - F.coalesce("size", F.lit(0))).alias("gap"))
            smallest = min([least for _, kind, _, least in seen if kind == WAITING], default=1)
        else:
            gaps = None
    if not placed:
        return spark.createDataFrame([], "id long, bin long, at long")
    return reduce(DataFrame.unionByName, placed)


def best_fit_packing(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                     tokenizer: str = TOKENIZER, keep_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    A document's ids end with id 0; only documents longer than ``capacity`` are cut. Pieces of a
    sequence follow each other without gaps from offset 0. Null text counts as empty and is the
    end id alone. Rows with equal ids are packed each on its own; a null id is handed through.
    ``keep_ids`` adds the ids (little-endian 32-bit). An empty input gives an empty result.
    """
    pieces = shared_table(token_pieces(df, id_col, text_col, capacity, tokenizer, keep_ids)
                          .withColumn("uid", F.monotonically_increasing_id()), "pieces")
    return place(pieces, capacity).drop("uid")


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with a unique ``uid`` and a ``length``."""
    placed = pack(pieces.select(F.col("uid").alias("id"), F.col("length").alias("size")), capacity)
    return pieces.join(placed.toDF("uid", "sequence_id", "offset"), "uid")
