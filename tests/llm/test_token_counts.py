import random

import pytest

from keytally.llm.common import tokenizer_from, tokenizer_json
from keytally.llm.token_counts import token_counts
from tests.llm.helpers import awkward_texts, documents

ODD = ["  two  spaces ", "tab\tnew\n\nline \n x", "it's I'll we've", "a <|endoftext|> b  <|endoftext|>", "  x   y", "日本語 テキスト",
       "🙂🙂  🙂", "end ", " ", "\n", "\n \n", "x \n", "\r\n a\r\n", "1234 56,78.9", "\x1c a \x85 b", "é café ", "​ zero", "a\n b", "a \n  b"]


@pytest.mark.parametrize("frequent", [0, 3, 1 << 18])
def test_matches_tokenizer(spark, frequent):
    rng = random.Random(1)
    rows = awkward_texts() + [(1000 + i, t) for i, t in enumerate(ODD)]
    rows += [(2000 + i, "".join(rng.choice(ODD + [" ", "\n", "a", "'", "9", " "]) for _ in range(6))) for i in range(80)]
    tok = tokenizer_from(tokenizer_json("byte_bpe_50k.json"))
    want = sorted((str(r[0]), len((r[1] or "").encode()), n := len(tok.encode(r[1] or "", add_special_tokens=False).ids), n > 512) for r in rows)
    got = token_counts(documents(spark, rows).repartition(4), frequent=frequent).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want


def test_empty_table(spark):
    assert token_counts(documents(spark, [])).collect() == []


def test_real_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    tok = tokenizer_from(tokenizer_json("byte_bpe_50k.json"))
    want = {r.doc_id: len(tok.encode(r.text or "", add_special_tokens=False).ids) for r in docs.collect()}
    assert {r.doc_id: r.n_tokens for r in token_counts(docs).collect()} == want
