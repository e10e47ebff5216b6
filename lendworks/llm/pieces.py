"""Token ids of text pieces, each distinct piece encoded once by the tokenizers library.

Texts are cut where the tokenizer itself always cuts, so the ids of a text are its pieces' ids in a row.
Prose repeats its words, hence a bounded cache answers most pieces without a call.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Callable

#: Pieces kept by a cache; two generations of this size may live at once.
CACHE_PIECES = 100_000

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks use the cores already


def byte_characters() -> dict[int, str]:
    """The printable character that byte-level vocabularies write for each byte.

    Printable Latin-1 bytes stand for themselves; the others take the characters from U+0100 on, in order.
    """
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return {b: chr(b) if b in shown else chr(next(rest)) for b in range(256)}


BYTE_CHARACTERS = byte_characters()


def as_byte_characters(piece: str) -> str:
    return piece.encode("utf-8").decode("latin-1").translate(BYTE_CHARACTERS)


def packed_ids(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


class PieceCache:
    """Ids of pieces as native unsigned 32-bit integers, oldest pieces dropped by generation."""

    def __init__(self, encode: Callable[[str], bytes], size: int = CACHE_PIECES):
        self.encode, self.size = encode, size
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def ids(self, pieces: list[str]) -> bytes:
        young = self.young
        found = list(map(young.get, pieces))
        if None in found:
            for i, ids in enumerate(found):
                if ids is None:
                    piece = pieces[i]
                    ids = young.get(piece) or self.old.get(piece)
                    if ids is None:
                        ids = self.encode(piece)
                    young[piece] = found[i] = ids
            if len(young) > self.size:
                self.old, self.young = young, {}
        return b"".join(found)
