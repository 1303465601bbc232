"""Scalar column functions (F10-F18): all Catalyst built-ins, no Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def duration_seconds(text: Column | str) -> Column:
    """"S", "M:S" or "H:M:S" -> seconds; a bad part counts 0; more than 3 parts -> 0."""
    parts = F.split(_c(text), ":")
    n = F.size(parts)

    def part(i: int) -> Column:
        return F.coalesce(F.get(parts, i).try_cast("int"), F.lit(0))

    return (
        F.when(n == 1, part(0))
        .when(n == 2, part(0) * 60 + part(1))
        .when(n == 3, part(0) * 3600 + part(1) * 60 + part(2))
        .otherwise(F.lit(0))
    ).cast("int")


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column | str) -> Column:
    """lower-case A-Z only; every other character unchanged."""
    return F.translate(_c(text), _UPPER, _LOWER)


# Characters a file name may not contain on Windows.
WINDOWS_BAD_CHARS = '<>:"\\/|?*'


def clean_file_name(text: Column | str, windows: bool = False) -> Column:
    """Windows: drop ``< > : " \\ / | ? *``; elsewhere: ``/`` -> ``\\``."""
    if windows:
        return F.translate(_c(text), WINDOWS_BAD_CHARS, "")
    return F.translate(_c(text), "/", "\\")


def query_encode(text: Column | str) -> Column:
    """form encoding of a query value (space -> ``+``)."""
    return F.url_encode(_c(text))


def epoch_millis_ntz(ts: Column | str) -> Column:
    """TIMESTAMP_NTZ -> ms since 1970 (floor), independent of the session zone."""
    us = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), _c(ts))
    return F.floor(us / 1000).cast("long")


def ntz_from_millis(ms: Column | str) -> Column:
    """ms since 1970 -> TIMESTAMP_NTZ."""
    return F.timestamp_add("MILLISECOND", _c(ms), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def pcm_quantise(sample: Column | str, bits: int) -> Column:
    """F16: amplitude in [-1, 1] -> integer PCM value (truncation, as a cast does)."""
    s = _c(sample)
    if bits == 8:
        return ((s + 1.0) * 127.5).cast("int")
    if bits == 16:
        return (s * 32767.0).cast("int")
    if bits == 24:
        return (s * 8388607.0).cast("int")
    if bits == 32:
        return (s * 2147483647.0).cast("long")
    raise ValueError(f"unsupported bits per sample: {bits}")


# The tags a basic HTML safe list keeps.
SAFE_TAGS = ["a", "b", "blockquote", "br", "cite", "code", "dd", "dl", "dt", "em", "i", "li", "ol",
             "p", "pre", "q", "small", "span", "strike", "strong", "sub", "sup", "u", "ul"]

# Clean-up steps (pattern, replacement with \\1, \\2 for groups), in order. What is kept is put between
# \u0001 and \u0002 first, so the sweep of all other tags leaves it alone. Links keep an absolute href and are marked
# nofollow, quotations keep an absolute cite; these are the attributes of the basic safe list.
SANITIZE_STEPS = (
    (r"(?is)<(script|style)\b[^>]*>.*?</(script|style)\s*>", ""),
    (r"(?s)<!--.*?-->", ""),
    (r'(?i)<a\b[^>]*?\bhref\s*=\s*"((?:https?|ftp|mailto):[^"]*)"[^>]*>', '\u0001a href="\\1" rel="nofollow"\u0002'),
    (r"(?i)<a\b[^>]*>", '\u0001a rel="nofollow"\u0002'),
    (r'(?i)<(blockquote|q)\b[^>]*?\bcite\s*=\s*"(https?:[^"]*)"[^>]*>', '\u0001\\1 cite="\\2"\u0002'),
    (r"(?i)<(/?)(" + "|".join(SAFE_TAGS) + r")\b[^>]*>", "\u0001\\1\\2\u0002"),
    (r"<[^>]*>", ""),
)


def sanitize_html(html: Column | str) -> Column:
    """keep text and safe-list tags with their safe attributes; drop script/style
    bodies, comments, every other tag and attribute."""
    h = _c(html)
    for pattern, kept in SANITIZE_STEPS:
        h = F.regexp_replace(h, pattern, kept.replace("\\1", "$1").replace("\\2", "$2"))
    return F.translate(h, "\u0001\u0002", "<>")


def sanitize_sql(html: str) -> str:
    """The same steps as a SQL expression of engines with ``regexp_replace(text, pattern, replacement, 'g')``."""
    for pattern, kept in SANITIZE_STEPS:
        html = f"regexp_replace({html}, '{pattern}', '{kept}', 'g')"
    return f"translate({html}, '\u0001\u0002', '<>')"
