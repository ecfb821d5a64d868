"""Terms of a text, cut from its UTF-8 bytes in two passes that run in C: translate, then split.

Bytes of characters beyond ASCII are 128 and above, so a class of ASCII characters and all others is a class of bytes,
and lower case of A-Z only is part of the same table.  A term is whole characters: UTF-8 never starts or ends one inside a run.
"""

from __future__ import annotations


def _table(kept: str) -> bytes:
    inside = {*kept.encode(), *range(128, 256)}
    return bytes(ord(chr(b).lower()) if 65 <= b <= 90 else b if b in inside else 32 for b in range(256))


#: Letters A-Z and a-z and everything beyond ASCII; the second one digits as well.
LETTERS = _table("abcdefghijklmnopqrstuvwxyz")
LETTERS_AND_DIGITS = _table("abcdefghijklmnopqrstuvwxyz0123456789")


def terms(text: bytes, table: bytes) -> list[bytes]:
    """Maximal runs of the table's characters in order, A-Z in lower case."""
    return text.translate(table).split()
