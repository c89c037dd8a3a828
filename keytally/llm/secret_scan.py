"""Secret scan with a random forest that removes false positives.

1. Patterns find candidates in whole texts: values assigned to names such as password or token
   (of any length, with or without digits), passwords in URLs, provider formats, key blocks and
   any long run of key characters, far more than are secrets. Punctuation behind them is not theirs.
2. A candidate is described by its length, the transitions between character classes, the
   share of it that dictionary words cover, its path, and the words around it.
3. A random forest, trained on labelled findings (a bounded number of each label), gives each
   candidate a probability; those below ``report_at`` are false positives.

The dictionary is the most frequent words of the corpus itself, counted over all documents.
Without labels from outside, findings are labelled by rules that only the clearest cases meet
(``rule_label``); all others are judged by the forest alone.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter, deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from keytally.llm.common import shared_table

#: Most labelled findings of either label that the forest is trained on.
PER_LABEL = 10_000
#: Words of the dictionary.
DICTIONARY = 20_000
TREES, DEPTH, SEED = 40, 8, 17
REPORT_AT = 0.5
#: Places for the hashed neighbouring words, and for the hashed path.
AROUND, PATHS = 48, 8

SECRET_NAME = r"(?:pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|auth|bearer|credential|private[_-]?key)"
FORMATS = (r"(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36,}|github_pat_[0-9A-Za-z_]{20,}|xox[abprs]-[0-9A-Za-z-]{10,}"
           r"|sk-[0-9A-Za-z_-]{20,}|AIza[0-9A-Za-z_-]{35}")
KEY_BEGIN = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY(?: BLOCK)?-----")
KEY_END = re.compile(r"-----END [A-Z ]*PRIVATE KEY(?: BLOCK)?-----")
#: A token of three parts: what it begins with, a part, the least length of one (of the first, behind the beginning).
TOKEN_BEGIN, TOKEN_PART, TOKEN_LEAST = "eyJ", re.compile(r"[\w-]*"), 8
_RUN = r"(?<![A-Za-z0-9+/_\-.@])(?=[A-Za-z+/_\-]*[0-9])[A-Za-z0-9+/_\-]{12,}={0,2}(?![\w.@])"
RUN = re.compile(_RUN)
#: Formats and runs of key characters; the group counts only if a digit comes before the next space or quote.
KEYS = re.compile(rf"(?<![A-Za-z0-9])(?:{FORMATS})(?![A-Za-z0-9])|(?<=[\s\"'`=:(<>,])([\w+/\-.~!#$%^&*]{{16,}}={{0,2}})|{_RUN}")
DIGIT, BREAK = re.compile(r"\d"), re.compile(r"[\s\"'`]")
#: What assigns a value, what stands before it, and the value: quoted, or up to a space or the next assignment.
ASSIGNS = re.compile(r"=>|:=|={1,3}|:")
NAME_BEGINS = re.compile(rf"(?i)(?={SECRET_NAME})")
NAMED = re.compile(rf"(?i){SECRET_NAME}[\w-]{{0,24}}[\"'`\]]{{0,2}}\s*\Z")
NAME_HINTS = ("pass", "pwd", "secret", "token", "key", "auth", "bearer", "credential")  # one is in every name
NAME_REACH = 64  # characters before the assignment that a name begins within
VALUE = re.compile(r"[^\S\n]*(?:\"([^\"\n]+)\"|'([^'\n]+)'|`([^`\n]+)`|((?:(?![,;&]\s*(?:\s|\Z|[\w.-]+=))[^\s\"'`<>])+))")
URL_PASSWORD = re.compile(r"://[^\s:/@\"'<>]*:([^\s/@\"'<>]+)@")
BEFORE_URL_PASSWORD = re.compile(r"://[^\s:/@\"'<>]*:\Z")
TRAILING = ".,;:!?)]}"
ASSIGNED = re.compile(rf"(?i){SECRET_NAME}[\"']?\s*(?:=|:|=>|is)?\s*[\"'`]?$")
#: An assignment that leaves no doubt: of a quoted value, or by an equals sign.
CLEAR = re.compile(rf"(?i){SECRET_NAME}[\"']?\s*(?:[=:]\s*[\"'`]|=\s*)\Z")
#: Values that stand for another one.
PLACEHOLDER = re.compile(r"(?i)\A(?:[$%<{]|your|x{3,}|\*{3,}|none\Z|null\Z|true\Z|false\Z|os\.|process\.|example|change)")
PROVIDER = re.compile(
    rf"(?:{FORMATS}|eyJ[\w-]+\.[\w-]+\.[\w-]+|-----BEGIN [\s\S]*)\Z")
ORDINARY = re.compile(r"(?i)(?:https?|www\.|\.(?:com|org|net|html?)\b|@)|^[\W\d_]*$|^[\d.,:/+-]+$")
WORDS = re.compile(r"[a-z]{4,}")


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counter: Counter[str] = Counter()

    def counted() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counter.keys(), pa.string()), pa.array(counter.values(), pa.int64())], ["word", "n"])

    for b in batches:
        for text in b.column(0).to_pylist():
            if text:
                counter.update(WORDS.findall(text.lower()))
                if len(counter) > 500_000:
                    yield counted()
                    counter = Counter()
    if counter:
        yield counted()


def coverage(candidate: str, words: set[str]) -> float:
    """Share of the candidate's characters in dictionary words, longest words first from the left."""
    text, covered, at = candidate.lower(), 0, 0
    while at < len(text):
        for n in range(min(12, len(text) - at), 3, -1):
            if text[at:at + n] in words:
                covered, at = covered + n, at + n
                break
        else:
            at += 1
    return covered / max(1, len(text))


def char_class(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


def features_of(candidate: str, path: str | None, before: str, after: str, words: set[str]) -> list[float]:
    classes = [char_class(c) for c in candidate]
    moves = [0.0] * 16
    for a, b in zip(classes, classes[1:]):
        moves[a * 4 + b] += 1
    n = max(1, len(classes) - 1)
    distinct = len(set(candidate)) / len(candidate)
    hexadecimal = float(all(c in "0123456789abcdefABCDEF" for c in candidate))
    around = [0.0] * AROUND
    for side, near in (("b", re.findall(r"\w+|[^\w\s]", before)[-4:]), ("a", re.findall(r"\w+|[^\w\s]", after)[:2])):
        for w in near:
            around[zlib.crc32(f"{side}{w.lower()}".encode("utf-8", "surrogatepass")) % AROUND] = 1.0
    where = [0.0] * PATHS
    where[zlib.crc32((path or "").encode("utf-8", "surrogatepass")) % PATHS] = 1.0
    return [float(len(candidate)), distinct, hexadecimal, *(m / n for m in moves), coverage(candidate, words), *around, *where]


class NextPlace:
    """Where a pattern is found next; asked for rising places, so that a text is searched once."""

    def __init__(self, pattern: re.Pattern, text: str):
        self.pattern, self.text, self.at = pattern, text, -1

    def __call__(self, start: int) -> int:
        if self.at < start:
            m = self.pattern.search(self.text, start)
            self.at = m.start() if m else len(self.text)
        return self.at


def key_blocks(text: str) -> list[tuple[int, int]]:
    """From each beginning mark to the first ending mark behind it; a mark without one is none."""
    ends = [m.span() for m in KEY_END.finditer(text)] if "-----BEGIN " in text else []
    if not ends:
        return []
    starts = [e[0] for e in ends]
    return [(m.start(), ends[k][1]) for m in KEY_BEGIN.finditer(text) if (k := bisect_left(starts, m.end())) < len(ends)]


def three_part_tokens(text: str) -> list[tuple[int, int]]:
    """Three runs of word characters joined by dots, of which the first begins as tokens do; a run is judged once."""
    found, at = [], text.find(TOKEN_BEGIN)
    while at >= 0:
        ends = [TOKEN_PART.match(text, at).end()]
        long = ends[0] - at - len(TOKEN_BEGIN) >= TOKEN_LEAST
        while long and len(ends) < 3 and text[ends[-1]:ends[-1] + 1] == ".":
            begin = ends[-1] + 1
            ends.append(TOKEN_PART.match(text, begin).end())
            long = ends[-1] - begin >= TOKEN_LEAST
        if long and len(ends) == 3:
            found.append((at, ends[2]))
        at = text.find(TOKEN_BEGIN, ends[0])
    return found


def keys_in(text: str) -> Iterator[tuple[int, int]]:
    """Key blocks, tokens, formats and runs of key characters, from the left, none overlapping another."""
    digit, stop = NextPlace(DIGIT, text), NextPlace(BREAK, text)

    def plain(at: int) -> tuple[int, int] | None:
        while m := KEYS.search(text, at):
            if not m.lastindex or digit(m.start()) < stop(m.start()):
                return m.span()
            if run := RUN.match(text, m.start()):
                return run.span()
            at = m.start() + 1
        return None

    known = [deque(key_blocks(text)), deque(three_part_tokens(text)), deque(x for x in [plain(0)] if x)]
    while any(known):
        start, end = min((k[0] for k in known if k), key=lambda x: x[0])  # of equal starts the first kind
        yield start, end
        for k in known[:2]:
            while k and k[0][0] < end:
                k.popleft()
        if known[2] and known[2][0][0] < end:
            known[2] = deque(x for x in [plain(end)] if x)


def spans(text: str) -> list[tuple[int, int]]:
    """Where the candidates of a text are, in its order; two may overlap. Takes time in proportion to the text."""
    found = {(s, s + len(text[s:e].rstrip(TRAILING))) for s, e in keys_in(text)}
    bare = (0, 0)  # the last value without quotes: what is assigned inside it ends where it does
    lower = text.lower()
    names = [m.start() for m in NAME_BEGINS.finditer(text)] if any(h in lower for h in NAME_HINTS) else []
    for m in ASSIGNS.finditer(text) if names else ():
        near = names[bisect_left(names, m.start() - NAME_REACH):bisect_left(names, m.start())]
        if not any(NAMED.match(text, n, m.start()) for n in reversed(near)):
            continue
        start, k = m.end(), 4
        if not bare[0] < start < bare[1]:
            if not (value := VALUE.match(text, start)):
                continue
            start, k = value.start(value.lastindex), value.lastindex
            end = value.end(k)
            if k == 4:
                bare = (start, end)
        else:
            end = bare[1]
        found.add((start, end if k < 4 else start + len(text[start:end].rstrip(TRAILING))))
    if "://" in text:
        found.update(m.span(1) for m in URL_PASSWORD.finditer(text))
    return sorted((s, e) for s, e in found if s < e)


def rule_label(candidate: str, before: str, after: str) -> int | None:
    """1 for the clearest secrets, 0 for the clearest other things, None for the rest."""
    if PROVIDER.match(candidate):
        return 1
    mixed = any(c.isdigit() for c in candidate) and any(c.isalpha() for c in candidate)
    if after.startswith("@") and BEFORE_URL_PASSWORD.search(before):
        return 1 if mixed and len(candidate) >= 6 else None
    if ASSIGNED.search(before):
        if mixed and len(candidate) >= 16:
            return 1
        if PLACEHOLDER.search(candidate):
            return 0
        plain = candidate.isalpha() or any(c.isspace() for c in candidate)
        return 1 if CLEAR.search(before) and (len(candidate) >= 6 and not plain or len(candidate) >= 12 and candidate.isalpha()) else None
    if ORDINARY.search(candidate) or ORDINARY.search(before[-8:]) or after.startswith("@") or not mixed:
        return 0
    return 0 if sum(c.isdigit() for c in candidate) <= 2 else None


def dictionary(df: DataFrame, text_col: str, size: int = DICTIONARY) -> set[str]:
    """The ``size`` most frequent words of at least four letters, over all texts."""
    counts = df.select(text_col).mapInArrow(count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = counts.filter("n > 2").orderBy(F.desc("n"), "word").limit(size).select("word").toArrow()
    return set(top.column("word").to_pylist())


def candidates(df: DataFrame, words: set[str], id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """Every candidate of every text: ``doc_id, start, end, candidate, features, label`` (label by rule)."""
    known = df.sparkSession.sparkContext.broadcast(words)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, text, path in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "path"))):
                for start, end in spans(text or ""):
                    candidate, before, after = text[start:end], text[max(0, start - 40):start], text[end:end + 24]
                    rows.append((i, start, end, candidate, features_of(candidate, path, before, after, known.value),
                                 rule_label(candidate, before, after)))
            columns = list(zip(*rows)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    names = ["doc_id", "start", "end", "candidate", "features", "label"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.float64()), pa.int32()]
    frame = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(path_col).cast("string").alias("path"))
    return frame.mapInArrow(find, "doc_id long, start long, end long, candidate string, features array<double>, label int")


def train(labelled: DataFrame, per_label: int = PER_LABEL) -> RandomForestClassificationModel | None:
    """A forest on labelled findings ``(features, label)``, at most ``per_label`` of each label.

    None unless both labels occur. Equal findings are one, with their number as its weight;
    distinct ones are taken in order of a hash of what they are.
    """
    distinct = labelled.filter(F.col("label").isin(0, 1)).groupBy("label", "candidate", "features").agg(F.count(F.lit(1)).alias("n"))
    parts = [distinct.filter(F.col("label") == v).orderBy(F.xxhash64("candidate", "features"), "candidate").limit(per_label)
             for v in (0, 1)]
    sample = shared_table(parts[0].unionByName(parts[1]).select("label", "features", "n"), "findings")
    if sample.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featuresCol="v", labelCol="y", weightCol="w",
                                    subsamplingRate=0.8)
    return forest.fit(sample.coalesce(4).select(F.col("label").cast("double").alias("y"), F.col("n").cast("double").alias("w"),
                                                 array_to_vector("features").alias("v")))


def secret_scan(df: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
                path_col: str = "source", report_at: float = REPORT_AT) -> DataFrame:
    """One row per candidate: ``doc_id, start, end, candidate, probability, secret``.

    ``start`` and ``end`` are code points of the original text; ``secret`` is ``probability >=
    report_at``. ``labelled`` are findings with their label, as :func:`candidates` gives them;
    without it the rules' labels serve. If not both labels occur, no forest can be trained:
    probabilities are null and every candidate is reported. Null and empty texts have no
    candidates; a null path is a path of its own; repeated rows give repeated candidates.
    """
    found = shared_table(candidates(df, dictionary(df, text_col), id_col, text_col, path_col), "candidates")
    forest = train(found if labelled is None else labelled)
    columns = ["doc_id", "start", "end", "candidate"]
    if forest is None:
        return found.select(*columns, F.lit(None).cast("double").alias("probability"), F.lit(True).alias("secret"))
    forest.setFeaturesCol("v").setProbabilityCol("p").setPredictionCol("").setRawPredictionCol("")
    scored = forest.transform(found.withColumn("v", array_to_vector("features")))
    return scored.withColumn("probability", vector_to_array("p")[1]).select(
        *columns, "probability", (F.col("probability") >= report_at).alias("secret"))
