"""Terms: maximal runs of some ASCII characters and of all characters beyond ASCII, with A-Z lower-cased."""

from __future__ import annotations

import string
from collections.abc import Iterator

from snapstar.llm.common import slices

LETTERS, WORDS = string.ascii_letters, string.ascii_letters + string.digits


def alphabet(kept: str) -> bytes:
    """A translation of UTF-8 bytes: ASCII characters but the ``kept`` ones become spaces, A-Z become a-z."""
    return bytes(b if b > 127 else ord(chr(b).lower()) if chr(b) in kept else 32 for b in range(256))


def terms(data: bytes, table: bytes) -> Iterator[list[bytes]]:
    """The terms of a whole UTF-8 text in order, part by part, so that no long text becomes one list."""
    for part in slices(data):
        yield part.translate(table).split()
