"""Column-name slugs for generated rollup columns (driver-side helper, runs once per spec)."""

from __future__ import annotations

# The slug keeps ASCII digits and every character from 'A' (U+0041) up to and
# including 'ø' (U+00F8); the two declared ranges A-Ø and a-ø overlap into that one span, which also
# keeps '_' and '[', '\\', ']', '^', '{', '}', '~'.  Everything else ('.', ',', space, '-') is dropped.
_DIGITS = ("0", "9")
_LETTERS = ("A", "ø")


def _kept(ch: str) -> bool:
    return _DIGITS[0] <= ch <= _DIGITS[1] or _LETTERS[0] <= ch <= _LETTERS[1]


def slugify(text: str) -> str:
    """``quantiles_0.1_0.5_0.9`` → ``quantiles_01_05_09``."""
    return "".join(ch for ch in text if _kept(ch))
