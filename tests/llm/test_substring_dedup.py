import random

import numpy as np
import pytest

from keytally.llm import substring_dedup as substring_dedup_module
from keytally.llm.substring_dedup import substring_dedup, units_of
from tests.llm.helpers import awkward_texts, documents


def test_matches_brute_force_with_unique_ids(spark):
    shared, other = "This Line is shared by many of them", "another   line that several documents have"
    rows = [(i, f"own line number {i} of this document\n{shared}\n{other if i % 2 else 'short one'}\nshort one\n{shared.upper()}") for i in range(30)]
    rows += [(40, None), (41, ""), (42, "\n\n"), (43, shared), (44, f"x\n{other}"), (None, f"{shared}\nfresh words that nobody else has")]
    got = {r.doc_id: r for r in substring_dedup(documents(spark, rows).repartition(4)).collect()}
    seen = set()
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        text, want, n_units, n_removed = text or "", [], 0, 0
        parts = text.split("\n")
        for k, x in enumerate(parts):
            key, piece = " ".join(x.lower().split()), x + ("\n" if k + 1 < len(parts) else "")
            if len(key.split()) >= 5:
                n_units += 1
                if key in seen:
                    n_removed += 1
                    continue
                seen.add(key)
            want.append(piece)
        r = got[i]
        assert (r.text, r.n_units, r.n_removed) == ("".join(want), n_units, n_removed)
        assert "".join(text[k.start:k.end] for k in r.kept) == r.text  # original offsets give the text back
        spans = sorted([(k.start, k.end) for k in r.kept] + [(k.start, k.end) for k in r.removed])
        assert [s for s, _ in spans] == [0, *[e for _, e in spans[:-1]]][:len(spans)] and (not spans or spans[-1][1] == len(text))
    assert len(got) == len(rows)


def test_repeated_rows_and_clashing_ids(spark):
    a, b = "the same long line of words here", "a different long line of words here"
    rows = [(1, a), (1, a), (1, b), (2, f"{a}\n{b}")]
    got = sorted((r.doc_id, r.text) for r in substring_dedup(documents(spark, rows)).collect())
    assert got == sorted([(1, a), (1, a), (1, b), (2, "")])


def test_paragraphs(spark):
    p = "first line of a paragraph\nsecond line of it"
    rows = [(1, f"{p}\n\nsomething else entirely in this one"), (2, f"opening words of document two\n\n{p}\n\nand closing words of document two")]
    got = {r.doc_id: r.text for r in substring_dedup(documents(spark, rows), unit="paragraph").collect()}
    assert got[1] == rows[0][1]
    assert got[2] == "opening words of document two\n\nand closing words of document two"


@pytest.mark.parametrize("unit", ["line", "paragraph"])
def test_units_cover_awkward_texts(unit):
    for _, text, *_ in awkward_texts():
        found = list(units_of(text or "", unit, 1))
        assert all(s < e for _, s, e in found) and all(x[2] <= y[1] for x, y in zip(found, found[1:]))


def test_empty_table(spark):
    assert substring_dedup(documents(spark, [])).collect() == []


def test_long_passages_occur_once(spark):
    """No line of over 50 words is left in two documents."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    seen = set()
    for r in substring_dedup(docs).collect():
        for line in r.text.split("\n"):
            words = line.lower().split()
            if len(words) > 50:
                assert " ".join(words) not in seen
                seen.add(" ".join(words))


def runs_in_two_places(rows, n):
    """Runs of ``n`` words of the texts that stand in two places."""
    seen, twice = set(), set()
    for _, text in rows:
        w = (text or "").lower().split()
        for i in range(len(w) - n + 1):
            run = " ".join(w[i:i + n])
            (twice if run in seen else seen).add(run)
    return twice


def test_passages_inside_lines(spark):
    """A passage that begins and ends inside lines is cut whole where it stands again, and nothing else."""
    rng = random.Random(8)
    def prose(n):
        return " ".join(f"v{rng.randrange(10**6)}" for _ in range(n))

    passages = [prose(n) for n in (50, 57, 80, 400)]
    short = prose(30)
    rows, want = [], {}
    for i in range(40):
        a, b, c = prose(rng.randrange(3, 90)), prose(rng.randrange(3, 90)), prose(20)
        p = passages[i % 4]
        laid = p if i % 3 else "\n".join(" ".join(p.split()[k:k + 7]) for k in range(0, len(p.split()), 7))
        rows.append((i, f"{a} {laid.upper() if i % 5 == 0 else laid} {b}\n{c} {short} {a[::-1]}"))
        want[i] = rows[-1][1] if i < 4 else f"{a} {b}\n{c} {short} {a[::-1]}"
    got = {r.doc_id: r for r in substring_dedup(documents(spark, rows).repartition(4)).collect()}
    assert runs_in_two_places(rows, 50) and not runs_in_two_places([(i, r.text) for i, r in got.items()], 50)
    for i, text in rows:
        assert got[i].text.split() == want[i].split()
        assert "".join(text[k.start:k.end] for k in got[i].kept) == got[i].text


def test_runs_that_repeat_themselves(spark):
    rows = [(1, "la " * 300), (2, "so " + "la " * 70), (None, "so it goes"), (0, None)]
    got = {r.doc_id: r.text.split() for r in substring_dedup(documents(spark, rows)).collect()}
    assert got == {1: ["la"] * 50, 2: ["so"], None: ["so", "it", "goes"], 0: []}


def test_long_runs_of_the_given_documents_stand_once(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    before = runs_in_two_places([(r.doc_id, r.text) for r in docs.collect()], 50)
    after = runs_in_two_places([(r.doc_id, r.text) for r in substring_dedup(docs).collect()], 50)
    assert before and not before & after


def test_short_lines_and_text_without_spaces(spark):
    verse = "a rose is\na rose\n\nthat grows\nby night\nalone"
    chinese, thai = "这是一段在许多文件里重复出现的文字没有空格", "ข้อความนี้ซ้ำกันในหลายเอกสาร"
    rows = [(1, f"first title\n{verse}\nThis line is of its own here\n{chinese}\n{thai}"),
            (2, f"{verse.upper()}\nother\n{chinese}\n{thai}"), (3, f"你好\n{verse}"), (4, "a rose\n你好\nx" + "y" * 100), (5, "x" + "y" * 100)]
    got = {r.doc_id: r.text for r in substring_dedup(documents(spark, rows)).collect()}
    assert got == {1: rows[0][1], 2: "other\n", 3: "你好\n", 4: rows[3][1], 5: ""}


def test_groups_cover_repeated_short_lines():
    rng = random.Random(4)
    for _ in range(200):
        lines = [" ".join(f"q{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 5))) for _ in range(12)]
        units = list(units_of("\n".join(lines), "line", 5))
        assert {d for d, _, _ in units} <= {d for d, _, _ in units_of("\n".join(["before", *lines, "after it"]), "line", 5)}
        assert min(s for _, s, _ in units) == 0 and max(e for _, _, e in units) == len("\n".join(lines))


def test_tokens_are_found_without_a_pattern_where_words_have_spaces():
    rng = random.Random(2)
    odd = ["a", "É", "İ", "ß", "word", " ", "\n", "\t", "\x0b", "\x1c", "\x1f", "\x85", "\xa0", "\u1680", "\u2003", "\u2028", "\u3000", "\u200b", "\ufeff", "\U0001f600", "\ud800"]
    texts = [t or "" for _, t, *_ in awkward_texts()] + ["".join(rng.choices(odd, k=rng.randrange(40))) for _ in range(400)]
    texts += [t + "\u4e2d\u6587 ab\u30ab" for t in texts[-50:]]
    for text in texts:
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        starts, ends = substring_dedup_module.spans_of(text, codes)
        assert list(zip(starts, ends)) == [m.span() for m in substring_dedup_module.TOKEN.finditer(text)]


def test_no_pattern_runs_over_plain_texts(monkeypatch):
    """Texts whose words have spaces between them are cut into words by array operations."""
    monkeypatch.setattr(substring_dedup_module, "TOKEN", None)
    words = [f"w{i}" for i in range(120)]
    text = "\n".join(" ".join(words[i:i + 12]) for i in range(0, 120, 12))
    hashes = substring_dedup_module.WordHashes()
    h = substring_dedup_module.gram_hashes(np.array([hashes[w] for w in words], np.uint64))
    digests, starts, ends = substring_dedup_module.passages_of(text, [int(h[40].astype(np.int64))], None, 50, hashes)
    assert starts.tolist() == [text.index(f"w{i}") for i in range(15, 41)] and len(digests) == len(ends) == 26
