"""Token counts without token ids.

The pieces of a text are those of its pre-tokens, one after the other, so each distinct
pre-token is given to the tokenizer once. A pre-token here is a run of characters other
than ASCII white space with the space before it, or the white space between such runs; the
pattern of the byte-level BPE never joins across these borders, and splits them further
only inside. Texts in which that does not hold (special strings such as ``<|endoftext|>``,
white space beyond ASCII) are few and go to the tokenizer whole, on the executors.

1. Every task counts its pre-tokens; the sums per pre-token make the vocabulary, and each
   distinct one is counted by the tokenizer once.
2. The ``frequent`` most common pre-tokens with their piece counts are broadcast (a
   bounded table); a document's frequent pre-tokens are summed where the text is read.
3. The rest, ``(document, pre-token, frequency)``, joins the vocabulary by pre-token and is
   summed by document. Only counts move, never ids.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from keytally.llm.common import shared_table, tokenizer_from, tokenizer_json

TOKENIZER = "byte_bpe_50k.json"
#: Most pre-tokens that are broadcast: about 10 MB.
FREQUENT = 1 << 18
#: Longest pre-token (characters) that is broadcast or kept in a task's counter.
LONGEST = 64
#: Distinct pre-tokens a task counts before it hands them on.
COUNTER_SIZE = 1 << 20
#: Characters given to the tokenizer at once.
ENCODE_CHARS = 1 << 20

PRE_TOKEN = re.compile(r" ?[^ \t-\r]+|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]")
#: White space beyond ASCII, and the first characters of special strings.
WHOLE = re.compile(r"[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]|<\|")


def _counted(counter: dict[str, int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(counter.keys(), pa.string()), pa.array(counter.values(), pa.int64())],
                                      ["piece", "n"])


def count_pre_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counter: Counter[str] = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            if text and not WHOLE.search(text):
                counter.update(PRE_TOKEN.findall(text))
                if len(counter) > COUNTER_SIZE:
                    yield _counted(counter)
                    counter = Counter()
    if counter:
        yield _counted(counter)


def lengths(tokenizer, texts: list[str]) -> list[int]:
    """Pieces of each text, a bounded number of characters at a time."""
    out: list[int] = []
    start = chars = 0
    for i, text in enumerate(texts):
        chars += len(text)
        if chars > ENCODE_CHARS or i + 1 == len(texts):
            out += [len(e.ids) for e in tokenizer.encode_batch(texts[start:i + 1], add_special_tokens=False)]
            start, chars = i + 1, 0
    return out


def token_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER,
                 limit: int = 512, frequent: int = FREQUENT) -> DataFrame:
    """Count each row's tokens: ``doc_id, n_bytes, n_tokens, over_limit``.

    ``n_tokens`` is what the tokenizer gives for the whole text without added special
    tokens; ``over_limit`` says whether it exceeds ``limit``. Null text counts as empty
    (0 bytes, 0 tokens). Rows with equal ids are counted each on its own. An empty input
    gives an empty result.
    """
    spec = tokenizer_json(tokenizer)

    def with_pieces(batches):
        tok = tokenizer_from(spec)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("piece"), b.column("n"), pa.array(lengths(tok, b.column("piece").to_pylist()), pa.int64())],
                ["piece", "n", "pieces"])

    text = F.col(text_col).alias("text")
    vocabulary = shared_table(
        df.select(text).mapInArrow(count_pre_tokens, "piece string, n long")
        .groupBy("piece").agg(F.sum("n").alias("n"))
        .mapInArrow(with_pieces, "piece string, n long, pieces long"), "vocabulary")
    common = (vocabulary.filter((F.length("piece") <= LONGEST) & (F.col("n") > 1))
              .orderBy(F.desc("n"), "piece").limit(frequent).select("piece", "pieces").toArrow())
    common = dict(zip(common.column("piece").to_pylist(), common.column("pieces").to_pylist()))
    known = df.sparkSession.sparkContext.broadcast(common)

    def per_document(batches):
        tok, pieces = tokenizer_from(spec), known.value
        get = pieces.get
        for b in batches:
            rows, n_bytes, sums, rest, odd = [], [], [], [], []
            for row, t in zip(b.column("row_id").to_pylist(), b.column("text").to_pylist()):
                t = t or ""
                rows.append(row)
                n_bytes.append(len(t.encode("utf-8", "surrogatepass")))
                if WHOLE.search(t):
                    sums.append(len(tok.encode(t, add_special_tokens=False).ids))
                    rest.append([])
                    odd.append([])
                    continue
                found = PRE_TOKEN.findall(t)
                counts = list(map(get, found))
                if None in counts:
                    unknown = Counter(p for p, n in zip(found, counts) if n is None)
                    rest.append(list(unknown))
                    odd.append(list(unknown.values()))
                    sums.append(sum(n for n in counts if n is not None))
                else:
                    rest.append([])
                    odd.append([])
                    sums.append(sum(counts))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(rows, pa.int64()), pa.array(n_bytes, pa.int64()), pa.array(sums, pa.int64()),
                 pa.array(rest, pa.list_(pa.string())), pa.array(odd, pa.list_(pa.int64()))],
                ["doc_id", "row_id", "n_bytes", "known", "rest", "times"])

    documents = shared_table(
        df.select(F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row_id"), text)
        .mapInArrow(per_document, "doc_id long, row_id long, n_bytes long, known long, rest array<string>, times array<long>"),
        "frequencies")
    rest = (documents.select("row_id", F.explode(F.arrays_zip("rest", "times")).alias("r"))
            .select("row_id", F.col("r.rest").alias("piece"), F.col("r.times").alias("times")))
    summed = (rest.join(vocabulary.select("piece", "pieces"), "piece")
              .groupBy("row_id").agg(F.sum(F.col("times") * F.col("pieces")).alias("more")))
    n_tokens = F.col("known") + F.coalesce("more", F.lit(0))
    return (documents.select("doc_id", "row_id", "n_bytes", "known").join(summed, "row_id", "left")
            .select("doc_id", "n_bytes", n_tokens.alias("n_tokens"), (n_tokens > limit).alias("over_limit")))
