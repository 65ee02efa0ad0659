"""Terms of a text: maximal runs of ASCII letters, digits where asked for, and all characters beyond ASCII.

Only A-Z are lower-cased.  Every byte of a character beyond ASCII is 0x80 or more in UTF-8, so a text is cut as bytes: one
table turns each separator into a space and each capital into its small letter.
"""

from __future__ import annotations

UPPER, LOWER, DIGITS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789"


def separators(kept: bytes = LOWER) -> bytes:
    """The table of ``terms``: ``kept`` stay, capitals become small letters, the rest of ASCII becomes a space."""
    table = bytearray(b" " * 128 + bytes(range(128, 256)))
    for c in kept:
        table[c] = c
    for a, b in zip(UPPER, LOWER, strict=True):
        table[a] = b
    return bytes(table)


LETTERS = separators()
ALNUM = separators(LOWER + DIGITS)


def terms(text: bytes | None, table: bytes) -> list[bytes]:
    return text.translate(table).split() if text else []


#: The same in SQL, over a column of texts.
def sql_terms(text: str, pattern: str) -> str:
    return f"regexp_extract_all(translate({text}, '{UPPER.decode()}', '{LOWER.decode()}'), '{pattern}')"
