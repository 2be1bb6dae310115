"""Small pieces for writing Spark SQL expressions as text."""

from __future__ import annotations


def lit(value: str) -> str:
    """A Spark SQL string literal for any text."""
    escaped = (
        value.replace("\\", "\\\\").replace("'", "\\'").replace("\0", "\\0").replace("\n", "\\n").replace("\r", "\\r")
    )
    return f"'{escaped}'"


def replace_all(x: str, rules) -> str:
    """Nested ``regexp_replace`` calls, applied in the order of ``rules``."""
    for pattern, replacement in rules:
        x = f"regexp_replace({x}, {lit(pattern)}, {lit(replacement)})"
    return x


def utf16_length(x: str) -> str:
    """Length in UTF-16 units, the unit the log format counts in."""
    return f"(char_length({x}) + char_length(regexp_replace({x}, {lit('[^\\x{10000}-\\x{10FFFF}]')}, '')))"
