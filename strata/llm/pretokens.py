"""Vectorised pre-tokenisation for byte-level BPE, without regex.

Splits text exactly where this pattern would (fixed value, public):

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

Every code point gets a symbol from a class array plus a look at the next one
or two code points.  Each symbol is a transition function on eight states.
Function composition is associative, so all prefixes of a whole batch come
from a blocked scan over codes of the (small) transition monoid: one table
lookup per code point and level, for all documents of the batch at once.  A
document's first symbol carries a constant function, which resets the state.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np

LETTER, NUMBER, OTHER, SPACE, WHITE = range(5)
#: symbols: the classes, with white space told apart by what follows, and contraction quotes
S_LETTER, S_NUMBER, S_OTHER, S_SPACE_LAST, S_WHITE_LAST, S_WHITE_IN, S_QUOTE1, S_QUOTE2 = range(8)
#: states: a new token must start; in white space; after a space that the next token takes;
#: in letters, numbers, others; one or two letters of a contraction still to come
END, IN_WHITE, JOIN, IN_LETTER, IN_NUMBER, IN_OTHER, LEFT1, LEFT2 = range(8)
#: Unicode White_Space, fixed value
WHITE_SPACE = (*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)


@lru_cache(1)
def class_table() -> np.ndarray:
    """The class of every code point."""
    table = np.full(0x110000, OTHER, np.uint8)
    major = [unicodedata.category(chr(c))[0] for c in range(0x110000)]
    table[[i for i, c in enumerate(major) if c == "L"]] = LETTER
    table[[i for i, c in enumerate(major) if c == "N"]] = NUMBER
    table[list(WHITE_SPACE)] = WHITE
    table[0x20] = SPACE
    return table


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """(next state, does a token start here) of the automaton."""
    run = {S_LETTER: IN_LETTER, S_NUMBER: IN_NUMBER, S_OTHER: IN_OTHER}
    plain = S_OTHER if symbol in (S_QUOTE1, S_QUOTE2) else symbol
    if state in (LEFT1, LEFT2) and symbol == S_LETTER:
        return (END if state == LEFT1 else LEFT1), False
    if state == JOIN and plain in run:
        return run[plain], False
    if plain in run and run[plain] == state:
        return state, False
    if state == IN_WHITE and symbol == S_WHITE_IN:
        return IN_WHITE, False
    fresh = {S_SPACE_LAST: JOIN, S_WHITE_LAST: END, S_WHITE_IN: IN_WHITE, S_QUOTE1: LEFT1, S_QUOTE2: LEFT2}
    return (run | fresh)[symbol], True


@lru_cache(1)
def monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Codes of the 16 symbols' functions (8 plain, 8 at a document's start), the
    composition table, each function's values, the token-start table, the identity."""
    plain = [tuple(_step(s, x)[0] for s in range(8)) for x in range(8)]
    reset = [(_step(END, x)[0],) * 8 for x in range(8)]
    found = {f: i for i, f in enumerate(dict.fromkeys([tuple(range(8)), *plain, *reset]))}
    queue = list(found)
    gens = [*dict.fromkeys([*plain, *reset])]
    while queue:
        f = queue.pop()
        for g in gens:
            h = tuple(g[s] for s in f)
            if h not in found:
                found[h] = len(found)
                queue.append(h)
    functions = list(found)
    size = len(functions)
    assert size <= 65536
    compose = np.array([[found[tuple(g[s] for s in f)] for g in functions] for f in functions], np.uint16)
    starts = np.array([[_step(s, x)[1] for x in range(8)] + [True] * 8 for s in range(8)], bool)
    return (np.array([found[f] for f in plain + reset], np.uint16), compose.ravel(),
            np.array(functions, np.uint8).ravel(), starts.ravel(), size)


def _scan(codes: np.ndarray, compose: np.ndarray, size: int, block: int = 64) -> np.ndarray:
    """Inclusive prefix compositions of function codes (code 0 is the identity)."""
    n = len(codes)
    if n <= block:
        out = codes.copy()
        for i in range(1, n):
            out[i] = compose[int(out[i - 1]) * size + int(out[i])]
        return out
    rows = -(-n // block)
    grid = np.zeros(rows * block, np.uint16)
    grid[:n] = codes
    grid = np.ascontiguousarray(grid.reshape(rows, block).T)
    for i in range(1, block):
        grid[i] = compose.take(grid[i - 1].astype(np.int32) * size + grid[i])
    before = np.zeros(rows, np.uint16)
    before[1:] = _scan(grid[-1], compose, size, block)[:-1]
    grid = compose.take(before.astype(np.int32)[None, :] * size + grid)
    return np.ascontiguousarray(grid.T).ravel()[:n]


def split(texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts; byte offsets of the pre-tokens (one more than tokens);
    the first token number of each text (one more than texts)."""
    joined = "".join(texts)
    data = joined.encode("utf-8")
    lengths = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(lengths)
    n = len(joined)
    if not n:
        return b"", np.zeros(1, np.int64), np.zeros(len(texts) + 1, np.int64)
    cps = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    classes = class_table().take(cps)
    white = classes >= SPACE
    last = np.zeros(n, bool)
    last[ends[lengths > 0] - 1] = True
    goes_on = np.ones(n, bool)  # the next code point of the text is white space, or there is none
    goes_on[:-1] = white[1:]
    goes_on |= last
    symbols = classes.copy()
    np.copyto(symbols, np.where(goes_on, S_WHITE_IN, classes), where=white, casting="unsafe")
    quotes = np.flatnonzero(cps == 0x27)
    if len(quotes):
        one = quotes[(quotes + 1 < n)]
        one = one[~last[one]]
        next1 = cps[one + 1]
        symbols[one[np.isin(next1, [ord(c) for c in "stmd"])]] = S_QUOTE1
        two = one[one + 2 < n]
        two = two[~last[two + 1]]
        a, b = cps[two + 1], cps[two + 2]
        symbols[two[((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))]] = S_QUOTE2
    symbols[(ends - lengths)[lengths > 0]] += 8
    codes, compose, values, starts, size = monoid()
    prefix = _scan(codes.take(symbols), compose, size)
    before = np.empty(n, np.int32)
    before[0] = END
    before[1:] = values.take(prefix[:-1].astype(np.int32) * 8 + END)
    begins = np.flatnonzero(starts.take(before * 16 + symbols))
    firsts = np.searchsorted(begins, np.concatenate([[0], ends]))
    if len(data) == n:
        offsets = np.append(begins, n)
    else:
        width = 1 + (cps >= 0x80).astype(np.int8) + (cps >= 0x800) + (cps >= 0x10000)
        at = np.cumsum(width, dtype=np.int64)
        offsets = np.append(at[begins] - width[begins], len(data))
    return data, offsets, firsts
