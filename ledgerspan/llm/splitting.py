"""Cutting long texts where the pre-splitting pattern of byte-level vocabularies can't match across."""

from __future__ import annotations

from collections.abc import Iterator

import regex

#: Code points a piece holds before a cut is looked for.
CHUNK = 1 << 16
#: Runs of white space from this length on are pieces of their own: the pattern's look-ahead recurses over them.
RUN = 1000

#: A non-blank before one blank and a letter: one match ends and the next begins there.
_SAFE = regex.compile(r"(?<=[^\s\p{White_Space}]) (?=\p{L})")
_RUN = regex.compile(r"\p{White_Space}{%d,}" % RUN)


def chunks(text: str, size: int = CHUNK) -> Iterator[str]:
    """Pieces of at least ``size`` code points (but the last) whose matches together are those of the text.

    A cut lies before a single blank that follows a non-blank and precedes a letter.  No alternative of the
    pattern runs over it: letters, digits, signs and contractions end before a blank, a run of white space
    can't have begun earlier, and " ?\\p{L}+" begins right there.  A text without such a place stays whole.
    """
    start = 0
    while len(text) - start > size:
        cut = _SAFE.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def pieces(text: str, size: int = CHUNK) -> Iterator[tuple[str, bool]]:
    """The chunks of a text, and whether one is a single match: a long run of white space.

    Before a non-blank the run's last character is left to what follows, as the pattern's look-ahead does.
    """
    at = 0
    for run in _RUN.finditer(text) if len(text) >= RUN else ():
        end = run.end() - (run.end() < len(text))
        if run.start() > at:
            yield from ((piece, False) for piece in chunks(text[at : run.start()], size))
        yield text[run.start() : end], True
        at = end
    if at < len(text):
        yield from ((piece, False) for piece in chunks(text[at:], size))
