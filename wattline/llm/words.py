"""Words of ASCII letters, digits and all non-ASCII characters, A-Z lower-cased, in pieces of bounded size.

On UTF-8 bytes the word class is: digits, a-z and every byte from 0x80. ``bytes.lower`` changes A-Z alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

PIECE_BYTES = 1 << 20
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
GAP = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")


def words_of(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode().lower())


def word_pieces(text: str | None, limit: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """The words of a text, in lists made from about ``limit`` bytes each; cut between words only."""
    data = (text or "").encode().lower()
    at = 0
    while at < len(data):
        gap = GAP.search(data, at + limit) if at + limit < len(data) else None
        end = gap.start() if gap else len(data)
        yield WORD.findall(data[at:end])
        at = end
