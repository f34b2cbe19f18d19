"""Token ids of texts by way of their chunks.

A chunk is a run of characters without white space, or white space between such
runs; tokenizers whose pre-tokens never reach from one into the next give a text
the ids of its chunks, one after the other. Most chunks of a corpus occur many
times, so ids are kept by chunk, in a store of bounded size.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

# White space as the tokenizers' regular expressions have it (Python's \s also counts U+001C to U+001F).
SPACE = "\t-\r \x85\xa0  -     　"
# Chunks kept in each of the two generations; some 250 bytes each.
KEPT = 500_000
# Longer texts go through in pieces of about this many characters.
PIECE = 1 << 20

_CUT = re.compile(f"(?<=[^{SPACE}])[{SPACE}]")


def pieces(text: str, chunk: re.Pattern) -> Iterator[list[str]]:
    """The chunks of a text, some at a time; cut before white space that follows a non-space."""
    at = 0
    while at < len(text):
        end = len(text)
        if end - at > PIECE and (cut := _CUT.search(text, at + PIECE)):
            end = cut.start()
        yield chunk.findall(text, at, end)
        at = end


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself, or the next free one from U+0100."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class ChunkIds(dict):
    """Ids of a chunk as bytes, made when a chunk is new; of two generations the older goes when the younger is full."""

    def __init__(self, encode: Callable[[str], bytes], kept: int = KEPT) -> None:
        super().__init__()
        self.encode, self.kept = encode, kept
        self.old: dict[str, bytes] = {}

    def __missing__(self, chunk: str) -> bytes:
        ids = self.old.get(chunk)
        if ids is None:
            ids = self.encode(chunk)
        if len(self) >= self.kept:
            self.old = dict(self)
            self.clear()
        self[chunk] = ids
        return ids

    def of_text(self, text: str, chunk: re.Pattern) -> bytes:
        """The ids of a text, one piece after the other."""
        return b"".join([b"".join(map(self.__getitem__, chunks)) for chunks in pieces(text, chunk)])
