"""Column expressions: tokeniser, seeded draws, codecs and formats."""

from keytally.functions.tokens import split_tokens, token_count
from keytally.functions.seeded import (
    draw, unit_interval, uniform_int, weighted_choice, distinct_sample, repeat_sample,
    join_ids, uuid_like, geometric_length,
)
from keytally.functions.codecs import (
    ntz_to_millis, millis_to_ntz, current_millis, parse_date, format_date, format_datetime,
    label, message_text, letter, encode_ad_line, decode_ad_line,
)

__all__ = [
    "split_tokens", "token_count",
    "draw", "unit_interval", "uniform_int", "weighted_choice", "distinct_sample",
    "repeat_sample", "join_ids", "uuid_like", "geometric_length",
    "ntz_to_millis", "millis_to_ntz", "current_millis", "parse_date", "format_date",
    "format_datetime", "label", "message_text", "letter", "encode_ad_line", "decode_ad_line",
]
