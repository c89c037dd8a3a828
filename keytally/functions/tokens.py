"""Tokeniser with JVM ``String.split(" ")`` semantics, as one column expression.

Rules (all eleven golden cases in FIXTURES.md hold):

* the separator is exactly one space (U+0020); tabs and newlines are token characters;
* leading and inner empty tokens are kept (``" a"`` -> ``["", "a"]``, ``"a  b"`` -> ``["a", "", "b"]``);
* trailing empty tokens are dropped (``"a b  "`` -> ``["a", "b"]``);
* the empty string gives one empty token (``""`` -> ``[""]``);
* a string of only spaces gives no token;
* a null value gives a null array, hence no rows after ``explode``.

Plain ``split(v, ' ')`` keeps trailing empties; stripping trailing spaces first and
special-casing all-space strings gives the JVM result with built-ins only, so the
expression stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def split_tokens(text: Column) -> Column:
    """``array<string>`` of the tokens of ``text`` (JVM split-on-space rules)."""
    trimmed = F.rtrim(text)  # rtrim without a trim string removes only U+0020
    no_tokens = F.array().cast("array<string>")
    return F.when((text != F.lit("")) & (trimmed == F.lit("")), no_tokens) \
            .otherwise(F.split(trimmed, " ", -1))


def token_count(text: Column) -> Column:
    """Number of tokens of ``text`` as bigint (null for a null value)."""
    return F.when(text.isNotNull(), F.size(split_tokens(text)).cast("bigint"))
