"""Substring dedup by line or paragraph hashing, and by hashed runs of words inside and across lines.

Documents are cut into units (lines, or paragraphs between blank lines). A unit is normalised
(lower case, white space runs to one space) and hashed; digests are grouped over the whole
corpus, the occurrence that ranks first stays, and the rest are cut from their documents.
Occurrences rank by ``doc_id`` (null last), then by place in the document. Units of fewer than
``min_words`` words count in groups of neighbours that have as many (verse, lists, narrow
wrapping); what is short even so is never cut, nor counted. Characters of scripts without spaces
count as half a word each, long words as several.

A passage need not fill whole units: every run of ``passage`` words that occurs twice stays where
it ranks first and is cut elsewhere, wherever in a line it begins and ends. Hashing every run would take a row a word, so runs are found in two steps: the
smallest of each ``passage - GRAM + 1`` neighbouring hashes of ``GRAM`` words are the prints of a
document, and two equal runs have a print in common; only runs that hold a print found in two
places are then hashed as a whole and grouped like units.

One pass over the texts writes them with their units and prints; the later passes read texts again
only to look at documents with repeated prints, and to cut. Digests, prints, ids and offsets
shuffle for the groupings (partially aggregated, so a line that a third of all documents share is
one row a task). What stands twice is written and then joined back: a join of two written tables,
in which a hot digest's side can be split. The texts shuffle to meet their repeated prints and their
cuts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from keytally.llm.common import shared_table

MIN_WORDS = 5
#: Words of a run that is left in one place only.
PASSAGE = 50
#: Words of a hash that prints are chosen from.
GRAM = 25
UNITS = {"line": re.compile(r"[^\n]*(?:\n|\Z)"), "paragraph": re.compile(r"(?s).+?(?:\n[^\S\n]*\n\s*|\Z)")}
#: Characters of scripts written without spaces (Thai, Lao, Burmese, Khmer, kana, Han): a token each, half a word.
SPACELESS = "฀-໿က-႟ក-៿぀-ヿ㐀-䶿一-鿿豈-﫿\U00020000-\U0003ffff"
ANY_SPACELESS = re.compile(f"[{SPACELESS}]")
TOKEN = re.compile(rf"[{SPACELESS}]|[^\s{SPACELESS}]+")
#: Whether a code point is white space; all beyond the last entry are as that one, none.
SPACES = np.array([chr(c).isspace() for c in range(0x3002)])
#: Characters of a token beyond which it counts as several words.
LONG_WORD = 16
FACTOR, MIXER = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9
#: Words whose hash a Python worker remembers.
REMEMBERED = 200_000


Piece = tuple[list[str], bytes | None, int, int]


def words_of(text: str) -> list[str]:
    text = text.lower()
    return text.split() if text.isascii() or not ANY_SPACELESS.search(text) else TOKEN.findall(text)


def measure(words: list[str]) -> float:
    """How many words the tokens count as."""
    return sum(0.5 if ANY_SPACELESS.match(w) else 1 + len(w) // LONG_WORD for w in words)


def digest_of(words: list[str]) -> bytes:
    return hashlib.md5(" ".join(words).encode("utf-8", "surrogatepass")).digest()


def pieces_of(text: str, unit: str, min_words: int) -> Iterator[Piece]:
    """``(words, digest, start, end)`` of each unit, in code points; no digest if it is short."""
    plain = text.isascii() or not ANY_SPACELESS.search(text)
    for m in UNITS[unit].finditer(text):
        words = words_of(m.group())
        counts = plain and len(words) >= min_words or bool(words) and measure(words) >= min_words
        yield words, digest_of(words) if counts else None, m.start(), m.end()


def groups_of(short: list[tuple[list[str], int, int]], min_words: int) -> Iterator[tuple[bytes, int, int]]:
    """``(digest, start, end)`` of the neighbours that count together: the fewest from each on, and up to each."""
    sizes = [measure(words) for words, _, _ in short]
    found, i, total = set(), 0, 0.0
    for j, size in enumerate(sizes):
        total += size
        before = i
        while total - sizes[i] >= min_words:
            total -= sizes[i]
            i += 1
        if total >= min_words:
            found.add((i, j))
            found.update((k, j) for k in range(before, i) if sum(sizes[k:j]) < min_words)
    for i, j in sorted(found):
        yield digest_of([w for words, _, _ in short[i:j + 1] for w in words]), short[i][1], short[j][2]


def units_of(text: str, unit: str, min_words: int) -> Iterator[tuple[bytes, int, int]]:
    """``(digest, start, end)`` of each unit that counts, line break included, in code points."""
    return units_in(pieces_of(text, unit, min_words), min_words)


def units_in(pieces: Iterable[Piece], min_words: int) -> Iterator[tuple[bytes, int, int]]:
    """The units that count among a text's pieces.

    Neighbouring short units (blank ones between them passed over) count in groups, which overlap.
    """
    short: list[tuple[list[str], int, int]] = []
    for words, digest, start, end in pieces:
        if digest is None:
            if words:
                short.append((words, start, end))
            continue
        if len(short) > 1:
            yield from groups_of(short, min_words)
        short = []
        yield digest, start, end
    if len(short) > 1:
        yield from groups_of(short, min_words)


class WordHashes(dict):
    """64-bit hashes of words, the same in every worker."""

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        h = self[word] = int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        return h


def over_runs(values: np.ndarray, n: int, join) -> np.ndarray:
    """``join`` over each run of ``n`` neighbours, by doubling; ``join(a, b, k)`` gets ``k``, the values in ``b``."""
    def both(a: np.ndarray, b: np.ndarray, k: int) -> np.ndarray:
        m = min(len(a), len(b))
        return join(a[:m], b[:m], k)

    out, done, block, size = None, 0, values, 1
    while True:
        if n & size:
            out = block if out is None else both(out, block[done:], size)
            done += size
        if 2 * size > n:
            return out
        block, size = both(block, block[size:], size), 2 * size


def gram_hashes(h: np.ndarray) -> np.ndarray:
    """A hash of each run of ``GRAM`` words, by their hashes."""
    h = over_runs(h, GRAM, lambda a, b, k: a * np.uint64(pow(FACTOR, k, 1 << 64)) + b)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(FACTOR)
    return h ^ (h >> np.uint64(29))


def is_print(h: np.ndarray, passage: int) -> np.ndarray:
    """Whether a hash is the smallest of a run of ``passage - GRAM + 1`` of them (all that tie)."""
    n = passage - GRAM + 1
    least = over_runs(h, n, lambda a, b, _: np.minimum(a, b))
    around = np.zeros(n - 1, np.uint64)
    return over_runs(np.concatenate((around, least, around)), n, lambda a, b, _: np.maximum(a, b)) == h


def prints_in(pieces: list[Piece], passage: int, own: int, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """The prints of a text, and the home of each.

    Runs that hold a print reach ``passage - GRAM`` words before it and as many behind it. Where all
    units they touch count, these units and the place in them are its home: every unit is left in
    one place, so prints with one home alone are no repeat. Other homes are of the document
    (``own``).
    """
    pieces = [p for p in pieces if p[0]]
    lengths = np.array([len(p[0]) for p in pieces], np.int64)
    n = int(lengths.sum())
    if n < passage:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    h = gram_hashes(np.fromiter(map(hashes.__getitem__, chain.from_iterable(p[0] for p in pieces)), np.uint64, n))
    at = np.flatnonzero(is_print(h, passage))
    begins = np.cumsum(lengths) - lengths
    first = np.searchsorted(begins, np.maximum(at - (passage - GRAM), 0), "right") - 1
    last = np.searchsorted(begins, np.minimum(at + passage, n) - 1, "right")
    mask, sums, powers, uncounted = (1 << 64) - 1, [0], [1], [0]
    for _, digest, _, _ in pieces:
        sums.append((sums[-1] * FACTOR + int.from_bytes((digest or b"")[:8], "little")) & mask)
        powers.append(powers[-1] * FACTOR & mask)
        uncounted.append(uncounted[-1] + (digest is None))
    sums, powers, uncounted = np.array(sums, np.uint64), np.array(powers, np.uint64), np.array(uncounted)
    of_units = (sums[last] - sums[first] * powers[last - first]).view(np.int64) + (at - begins[first])
    home = np.where(uncounted[last] == uncounted[first], of_units, np.int64(own) + at)
    return h[at].view(np.int64), home


def spans_of(text: str, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of a text's tokens, in code points (``codes``)."""
    if not text.isascii() and ANY_SPACELESS.search(text):
        return np.array([m.span() for m in TOKEN.finditer(text)], np.int64).reshape(-1, 2).T
    inside = np.concatenate(([False], ~SPACES.take(codes, mode="clip"), [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def run_digests(h: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """128 bits of each run of ``n`` word hashes that begins at ``at``, as rows of 16 bytes: two sums by powers of two factors.

    The second is over the hashes' own hashes, so that it goes its own way.
    """
    def sums(x: np.ndarray, factor: int) -> np.ndarray:
        return over_runs(x, n, lambda a, b, k: a * np.uint64(pow(factor, k, 1 << 64)) + b)[at]

    mixed = (h ^ (h >> np.uint64(29))) * np.uint64(MIXER)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(FACTOR)
    return np.ascontiguousarray(np.column_stack([sums(h, FACTOR), sums(mixed ^ (mixed >> np.uint64(31)), MIXER)])).view(np.uint8).reshape(-1, 16)


def passages_of(text: str, prints: list[int], cuts: list[dict] | None, passage: int,
                hashes: WordHashes) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Digests, starts and ends of the runs of ``passage`` words that hold a print and are not cut as a whole.

    A run ends where its last word's successor begins if that stands in the same line.
    """
    codes = np.frombuffer(text.encode(), np.uint8) if text.isascii() else np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    starts, ends = spans_of(text, codes)
    words = words_of(text)
    if len(words) != len(starts):  # lower case parted a word
        words = [text[s:e].lower() for s, e in zip(starts.tolist(), ends.tolist())]
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    runs = over_runs(np.isin(gram_hashes(h), np.array(prints, np.int64).view(np.uint64)), passage - GRAM + 1, lambda a, b, _: a | b)
    gone = np.zeros(len(starts), bool)
    for cut in cuts or ():
        gone[np.searchsorted(starts, cut["start"]):np.searchsorted(starts, cut["end"])] = True
    at = np.flatnonzero(runs & ~over_runs(gone, passage, lambda a, b, _: a & b))
    if not len(at):
        return None
    end, after = ends[at + passage - 1], np.append(starts, len(text))[at + passage]
    breaks = np.flatnonzero(codes == 10)
    same_line = np.searchsorted(breaks, end) == np.searchsorted(breaks, after)
    return run_digests(h, at, passage), starts[at], np.where(same_line, after, end)


def merged(cuts: list[dict] | None) -> list[dict]:
    """Cuts in order, those that overlap made one."""
    out: list[dict] = []
    for cut in sorted(cuts or (), key=lambda c: (c["start"], c["end"])):
        if out and cut["start"] < out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], cut["end"])
        else:
            out.append({"start": cut["start"], "end": cut["end"]})
    return out


def without(text: str, cuts: list[dict] | None) -> tuple[str, list[dict]]:
    """The text without the cuts, and the offsets in the original text of what is kept."""
    kept, at = [], 0
    for cut in cuts or ():
        if cut["start"] > at:
            kept.append({"start": at, "end": cut["start"]})
        at = cut["end"]
    if at < len(text):
        kept.append({"start": at, "end": len(text)})
    return "".join(text[k["start"]:k["end"]] for k in kept), kept


def repeats(units: DataFrame) -> DataFrame:
    """The places ``(doc_id, text_hash, start, end)`` of ``units`` whose digest stands in an earlier place.

    Where a repeat overlaps the place that stays (runs of words that repeat themselves), only
    what lies behind that is a repeat.
    """
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "start", "end")
    groups = (units.groupBy("digest").agg(F.min(place).alias("first"), F.max(place).alias("last"))
              .filter(F.col("first") != F.col("last")).select("digest", "first"))
    groups = shared_table(groups, "repeated")
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
    return (units.join(groups, "digest").filter(place != F.col("first"))
            .select("doc_id", "text_hash", F.when(same, F.greatest("start", "first.end")).otherwise(F.col("start")).alias("start"), "end")
            .filter(F.col("start") < F.col("end")))


def substring_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "line",
                    min_words: int = MIN_WORDS, passage: int = PASSAGE) -> DataFrame:
    """One row per document: ``doc_id, text, n_units, n_removed, removed, kept``.

    ``text`` is what is left; ``removed`` and ``kept`` are arrays of ``(start, end)`` in the
    original text, in code points; ``n_units`` counts the units that count, ``n_removed`` the
    units and the stretches of repeated words cut. Null text counts as
    empty and stays empty. A unit repeated inside a document is cut like any other. Rows that
    agree in id and text are one document and fare alike; rows with equal ids and different
    texts are documents of their own, ranked by a hash of their text. No run of ``passage`` words
    (at least ``GRAM``) of the originals is left in two places. An empty input gives an empty
    result.
    """
    if passage < GRAM:
        raise ValueError(f"passage must be at least {GRAM}")
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")) \
        .withColumn("text_hash", F.xxhash64("text"))

    names = ["doc_id", "text", "text_hash", "n_units", "digest", "start", "end", "print", "home"]
    types = [pa.list_(pa.binary()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            columns: list[list] = [[] for _ in types]
            for text, own in zip(b.column("text").to_pylist(), b.column("text_hash").to_pylist()):
                pieces = list(pieces_of(text, unit, min_words))
                for c, x in zip(columns, (*(list(zip(*units_in(pieces, min_words))) or ((), (), ())), *prints_in(pieces, passage, own, hashes))):
                    c.append(x)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text"), b.column("text_hash"), pa.array(map(len, columns[0]), pa.int64()),
                 *(pa.array(c, t) for c, t in zip(columns, types))], names)

    parsed = shared_table(docs.mapInArrow(
        parse, "doc_id long, text string, text_hash long, n_units long, digest array<binary>, start array<int>, end array<int>, "
               "print array<long>, home array<long>"), "parsed")
    units = parsed.select("doc_id", "text_hash", F.inline(F.arrays_zip("digest", "start", "end")))

    unit_names = ["doc_id", "text_hash", "digest", "start", "end"]
    unit_types = [pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32()]
    unit_schema = "doc_id long, text_hash long, digest binary, start int, end int"

    # doc_id 0 and no id must not meet: a null id has a key of its own
    key = [F.coalesce("doc_id", F.lit(0)).alias("id_key"), F.col("doc_id").isNull().alias("no_id"), "text_hash"]
    keys = ["id_key", "no_id", "text_hash"]

    def by_document(places: DataFrame, name: str) -> DataFrame:
        return (places.select(*key, "start", "end").groupBy(*keys)
                .agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias(name)))

    unit_cuts = shared_table(by_document(repeats(units), "cuts"), "cuts")

    prints = parsed.select("doc_id", "text_hash", F.inline(F.arrays_zip("print", "home")))
    twice = prints.groupBy("print").agg(F.min("home").alias("a"), F.max("home").alias("b")).filter("a <> b").select("print")
    printed = prints.join(shared_table(twice, "twice"), "print").select(*key, "print").groupBy(*keys).agg(F.collect_set("print").alias("prints"))
    texts = parsed.select("doc_id", "text", "n_units", *key)
    searched = texts.join(printed, keys).join(unit_cuts, keys, "left").select("doc_id", "text_hash", "text", "prints", "cuts")

    def find_passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            for i, h, t, prints, cuts in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text_hash", "text", "prints", "cuts"))):
                found = passages_of(t, prints, cuts, passage, hashes)
                if found is not None:
                    digests, starts, ends = found
                    n = len(starts)
                    binary = pa.Array.from_buffers(pa.binary(16), n, [None, pa.py_buffer(digests.tobytes())]).cast(pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array([i] * n, pa.int64()), pa.array(np.full(n, h)), binary,
                                                      pa.array(starts.astype(np.int32)), pa.array(ends.astype(np.int32))], unit_names)

    passages = shared_table(searched.mapInArrow(find_passages, unit_schema), "passages")
    counted = (texts.join(unit_cuts, keys, "left").join(by_document(repeats(passages), "runs"), keys, "left")
               .select("doc_id", "text", "n_units", "cuts", "runs"))

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, t, n, cuts, runs in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "n_units", "cuts", "runs"))):
                gone = merged((cuts or []) + (runs or []))
                left, kept = without(t, gone)
                rows.append((i, left, n, len(cuts or ()) + len(merged(runs)), gone, kept))
            columns = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out)], schema=out)

    schema = "doc_id long, text string, n_units long, n_removed long, " \
             "removed array<struct<start:int,end:int>>, kept array<struct<start:int,end:int>>"
    out = to_arrow_schema(df.sparkSession.createDataFrame([], schema).schema)
    return counted.mapInArrow(cut_out, schema)
