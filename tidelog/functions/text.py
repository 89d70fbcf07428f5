"""Text expressions: tokenisers, anonymising, JSON and integer parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The token separators of the word-count variants.
SPACE = " "
ASCII_NON_WORD = r"\W+"
UNICODE_NON_WORD = r"[^\p{L}\p{N}\p{M}_]+"

# Fixed value: an IPv4 address; the last octet is replaced.
IPV4 = r"(\d{1,3}\.\d{1,3}\.\d{1,3}\.)\d{1,3}"


def split_keeping_leading(text: Column, separators: str) -> Column:
    """Split at runs of separators, dropping a trailing empty token but no leading one.

    An empty text yields one empty token, a text of separators only yields none. The split is
    put into an array so that it is evaluated once; cutting the end off with an expression
    instead would look at long runs of separators once per character.
    """
    return _without_trailing(text, F.split(text, separators))


def _without_trailing(text: Column, tokens: Column) -> Column:
    cut = F.transform(
        F.array(tokens),
        lambda t: F.when(
            (F.size(t) > 1) & (F.element_at(t, -1) == ""), F.slice(t, F.lit(1), F.size(t) - 1)
        ).otherwise(t),
    )
    return F.flatten(F.filter(cut, lambda t: (text == "") | (F.size(t) > 1) | (t[0] != "")))


def space_tokens(text: Column) -> Column:
    """Split at single spaces: inner runs of spaces give empty tokens, trailing ones do not."""
    lower = F.lower(text)
    return _without_trailing(lower, F.split(F.rtrim(lower), SPACE))


def ascii_words(text: Column) -> Column:
    return split_keeping_leading(F.lower(text), ASCII_NON_WORD)


def unicode_words(text: Column) -> Column:
    return split_keeping_leading(F.lower(text), UNICODE_NON_WORD)


def non_empty_words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), ASCII_NON_WORD), lambda w: w != "")


def characters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def anonymize_ip(text: Column) -> Column:
    """Replace the last octet of every IPv4 address by ``XXX``."""
    return F.regexp_replace(text, IPV4, "$1XXX")


def parse_int(text: Column) -> Column:
    """Whole number in the text, or null when the text is anything else."""
    return F.when(text.rlike(r"^\s*[+-]?\d+\s*$"), F.trim(text).try_cast("bigint"))


def json_fields(text: Column, fields: dict[str, str]) -> Column:
    """Typed record read from JSON text; a missing field is null."""
    schema = T.StructType([T.StructField(n, T._parse_datatype_string(t)) for n, t in fields.items()])
    return F.from_json(text, schema)


def json_text(record: Column) -> Column:
    return F.to_json(record)


def event_time(text: Column, field: str) -> Column:
    """Instant from an epoch-milliseconds JSON field; a payload without it is an error."""
    millis = F.get_json_object(text, f"$.{field}").try_cast("bigint")
    return F.when(millis.isNotNull(), F.timestamp_millis(millis)).otherwise(
        F.raise_error(F.concat(F.lit("payload without event time: "), F.coalesce(text, F.lit("null"))))
    )


def windowed_key(key: Column, start: Column, end: Column) -> Column:
    """``key@startMillis->endMillis``."""
    return F.concat(
        key.cast("string"),
        F.lit("@"),
        F.unix_millis(start).cast("string"),
        F.lit("->"),
        F.unix_millis(end).cast("string"),
    )
