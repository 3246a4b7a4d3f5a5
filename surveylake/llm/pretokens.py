"""Where the pattern of byte-level vocabularies cuts a text, found for all positions at once."""

from __future__ import annotations

import unicodedata

import numpy as np

from surveylake.llm.common import worker_state

LETTER, NUMBER, OTHER, SPACE, BLANK, EDGE = range(6)
#: The white space of the pattern's \s.
WHITE = (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
#: What may follow an apostrophe as a piece of its own.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
#: Stands between texts; no text holds it.
BETWEEN = "\ud800"


def classes() -> np.ndarray:
    """The class of every code point, once per worker."""
    state = worker_state("tokens")
    if "classes" not in state:
        kinds = {"L": LETTER, "N": NUMBER}
        found = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8)
        found[list(WHITE)] = BLANK
        found[32] = SPACE
        found[ord(BETWEEN)] = EDGE
        state["classes"] = found
    return state["classes"]


def cut(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts together, a flag per byte where a piece starts, and each text's first byte.

    Every alternative of the pattern depends on a character, the one before and three after, so the flags are
    comparisons of shifted arrays.
    """
    joined = BETWEEN + BETWEEN.join(texts) + BETWEEN * 4
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = classes()[points]
    before, here, after = kind[:-4], kind[1:-3], kind[2:-2]
    here_white, before_white = here >= SPACE, before >= SPACE
    here_white &= here != EDGE
    before_white &= before != EDGE
    after_word = after < SPACE
    starts = np.where(here_white, ~before_white | after_word, (here != before) & (before != SPACE))
    at = np.flatnonzero((points[1:-3] == ord("'")) & (before != OTHER) & (before != SPACE))
    if len(at):
        one, two = points[at + 2], points[at + 3]
        short = np.isin(one, [ord(e) for e in ENDINGS if len(e) == 1])
        long = np.zeros(len(at), bool)
        for end in (e for e in ENDINGS if len(e) == 2):
            long |= (one == ord(end[0])) & (two == ord(end[1]))
        starts[at[short | long] + 1] = False
        ends = np.concatenate([at[short] + 2, at[long & ~short] + 3])
        starts[ends[ends < len(starts)]] = True
    text = here != EDGE
    points = points[1:-3]
    width = 1 + (points >= 0x80).astype(np.int8) + (points >= 0x800) + (points >= 0x10000)
    width[~text] = 0
    offset = np.cumsum(width, dtype=np.int64) - width
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    flags = np.zeros(len(data), bool)
    flags[offset[starts & text]] = True
    firsts = np.concatenate([[0], offset[np.flatnonzero(~text)]])[: len(texts)]
    return data, flags, firsts
