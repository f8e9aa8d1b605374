"""Text columns: blanks, currency codes, instrument names, path-safe tickers."""

from __future__ import annotations

# Every character that counts as white space at the ends of a text (tabs, line
# ends, no-break and other Unicode blanks), not only the blank ``trim`` removes.
BLANKS = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())


def literal(text: str) -> str:
    """A SQL string literal of any text."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def strip(text: str) -> str:
    """Remove white space of any kind at both ends; plain ``trim`` removes blanks only."""
    return f"btrim({text}, {literal(BLANKS)})"


def has_text(text: str) -> str:
    """Anything but white space; stops at the first such character."""
    return f"{text} rlike {literal(f'[^{BLANKS}]')}"


def currency(code: str) -> str:
    return f"upper({strip(code)})"


def is_currency(code: str) -> str:
    """Three letters of any alphabet, once normalised."""
    pad = f"[{BLANKS}]*"
    return f"upper({code}) rlike {literal(f'^{pad}[\\p{{L}}]{{3}}{pad}$')}"


def pair_name(base: str, quote: str) -> str:
    """``BASE/QUOTE``; null when either side is null."""
    return f"{base} || '/' || {quote}"


def safe_ticker(ticker: str) -> str:
    """Ticker as a path component. It is lossy, so it never serves as a key."""
    return f"translate({ticker}, '^/ ', '___')"
