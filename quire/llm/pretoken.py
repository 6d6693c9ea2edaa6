"""Pre-tokenizer of the byte-level BPE vocabularies as a finite transducer.

Fixed rule (the published pattern of these vocabularies)::

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

Read character by character, the pattern is a deterministic automaton of
eleven states over eleven character classes. A transition says whether a piece
starts at the character just read, or (where one character of look-ahead was
needed) at the character before it.

A flat text is cut into chunks of equal length. Every chunk is run from all
states at once, which gives its state map (entry state to exit state). The
maps compose associatively, so a parallel prefix scan (``log2`` of the number
of chunks rounds of gathers) gives every chunk its true entry state, and one
more run emits the piece starts. Chunks, not documents, are the unit: a very
long document costs the same per character as many short ones.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

CHUNK = 512

# character classes
OTHER, LETTER, NUMBER, SPACE, BLANK, QUOTE, STMD, R_OR_V, L_, E_, END = range(11)
# states
(START, IN_L, IN_N, IN_O, IN_Q, Q_RV, Q_L, ONE_S, ONE_W, RUN_S, RUN_W) = range(11)
STATES = 11


UNKNOWN = 255


@lru_cache(maxsize=1)
def _table() -> np.ndarray:
    out = np.full(0x110000, UNKNOWN, np.uint8)
    out[ord(" ")], out[ord("'")], out[ord("l")], out[ord("e")] = SPACE, QUOTE, L_, E_
    out[[ord(c) for c in "stmd"]] = STMD
    out[[ord(c) for c in "rv"]] = R_OR_V
    return out


def classes(points: np.ndarray) -> np.ndarray:
    """Class of every code point. A code point seen for the first time is
    classified as the library's pattern sees it (its Unicode version decides):
    by whether it joins a letter, a digit or a mark beside it."""
    table = _table()
    cls = table[points]
    if (cls == UNKNOWN).any():
        from tokenizers.pre_tokenizers import ByteLevel
        split = ByteLevel(add_prefix_space=False, use_regex=True)
        new = np.unique(points[cls == UNKNOWN])
        for i in range(0, len(new), 4096):
            part = new[i:i + 4096]
            probe = "".join("a" + c + "1!" + c + "a" for c in map(chr, part.tolist()))
            starts = np.zeros(len(probe) + 1, bool)
            starts[[a for _, (a, _) in split.pre_tokenize_str(probe)]] = True
            at = np.arange(len(part)) * 6
            table[part] = np.select([~starts[at + 1], ~starts[at + 2], ~starts[at + 4]], [LETTER, NUMBER, OTHER], BLANK)
        cls = table[points]
    return cls


@lru_cache(maxsize=1)
def automaton() -> tuple[np.ndarray, np.ndarray]:
    """``next[state * 11 + class]`` and marks: bit 0 a piece starts at this
    character, bit 1 a piece starts at the character before it."""
    nxt = np.zeros((STATES, 11), np.uint8)
    mark = np.zeros((STATES, 11), np.uint8)
    letters = (LETTER, STMD, R_OR_V, L_, E_)
    blanks = {SPACE: (ONE_S, RUN_S), BLANK: (ONE_W, RUN_W)}

    def kind(c):  # state of a piece that starts with class c
        return IN_L if c in letters else {NUMBER: IN_N, OTHER: IN_O, QUOTE: IN_Q}.get(c) or blanks[c][0]

    def same(state, c):  # the class continues the piece
        return (state == IN_L and c in letters) or (state == IN_N and c == NUMBER) or (
            state == IN_O and c in (OTHER, QUOTE))

    for c in range(END):
        for s in (START, IN_L, IN_N, IN_O):
            nxt[s, c], mark[s, c] = (s, 0) if same(s, c) else (kind(c), 1)
        # after an apostrophe that starts a piece
        if c in (OTHER, QUOTE):
            nxt[IN_Q, c] = IN_O
        elif c == STMD:
            nxt[IN_Q, c] = START
        elif c in (R_OR_V, L_):
            nxt[IN_Q, c] = Q_RV if c == R_OR_V else Q_L
        else:
            nxt[IN_Q, c], mark[IN_Q, c] = kind(c), 1
        for s, final in ((Q_RV, E_), (Q_L, L_)):
            if c == final:
                nxt[s, c] = START
            else:  # no contraction: the letter before this one started a word
                nxt[s, c], mark[s, c] = nxt[IN_L, c], mark[IN_L, c] | 2
        for s in (ONE_S, ONE_W, RUN_S, RUN_W):
            if c in blanks:
                nxt[s, c] = blanks[c][1]
                continue
            # the last blank leaves its run; a space joins the next piece
            joins = s in (ONE_S, RUN_S)
            nxt[s, c] = IN_O if joins and c == QUOTE else kind(c)
            mark[s, c] = (0 if joins else 1) | (2 if s in (RUN_S, RUN_W) else 0)
    for s in (Q_RV, Q_L):
        mark[s, END] = 2
    return nxt.ravel(), mark.ravel()


def scan(maps: np.ndarray) -> np.ndarray:
    """Inclusive parallel prefix scan of state maps (rows: chunks, columns:
    entry states): row i becomes the composition of maps 0 to i."""
    out, step = maps.copy(), 1
    while step < len(out):
        out[step:] = np.take_along_axis(out[step:], out[:-step], 1)
        step *= 2
    return out


def run(symbols: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """Marks of every symbol of one flat sequence, started in ``START``."""
    nxt, mark = automaton()
    n = len(symbols)
    if n == 0:
        return np.zeros(0, np.uint8)
    chunks = -(-n // chunk)
    grid = np.full(chunks * chunk, END, np.uint8)
    grid[:n] = symbols
    grid = np.ascontiguousarray(grid.reshape(chunks, chunk).T)  # step x chunk
    base = np.uint8(11)
    maps = np.tile(np.arange(STATES, dtype=np.uint8), (chunks, 1))
    for row in grid:
        maps = nxt[maps * base + row[:, None]]
    entry = np.zeros(chunks, np.uint8)
    entry[1:] = scan(maps)[:-1, START]
    out = np.empty_like(grid)
    state = entry
    for i, row in enumerate(grid):
        at = state * base + row
        out[i] = mark[at]
        state = nxt[at]
    return out.T.ravel()[:n]


def pieces(data: np.ndarray, offs: np.ndarray, special: bytes | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, ends, is_special)`` byte ranges of the pieces of flat texts.

    ``special`` is a string that is a token of its own wherever it occurs in a
    text; the text on either side is split as if it stood alone.
    """
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, bool)
    text = data.tobytes()
    at = np.frombuffer(text.decode("utf-8").encode("utf-32-le"), np.uint32)
    char_at = np.flatnonzero((data & 0xC0) != 0x80)      # byte of every character
    cls = classes(at)
    marked = np.zeros(0, np.int64)
    if special:
        found, i = [], text.find(special)
        while i >= 0:
            d = int(np.searchsorted(offs, i, "right"))
            if i + len(special) <= offs[d]:
                found.append(i)
                i = text.find(special, i + len(special))
            else:
                i = text.find(special, i + 1)
        marked = np.asarray(found, np.int64)
        for i in np.searchsorted(char_at, marked):
            cls[i:i + len(special)] = END  # special strings are ASCII
    # one END after every document
    ends = np.searchsorted(char_at, offs[1:])
    symbols = np.insert(cls, ends, END)
    got = run(symbols)
    here = (got & 1).astype(bool)
    here[:-1] |= (got[1:] & 2).astype(bool)
    keep = np.ones(len(symbols), bool)
    keep[ends + np.arange(len(ends))] = False
    begins = np.zeros(n + 1, bool)
    begins[char_at[here[keep]]] = True
    stop = begins.copy()
    stop[offs[1:]] = True
    stop[marked] = True
    solid = np.zeros(n + 1, bool)
    if len(marked):
        begins[marked] = True
        solid[marked] = True
    starts = np.flatnonzero(begins[:n])
    stops = np.flatnonzero(stop)
    nxt = stops[np.searchsorted(stops, starts, "right")]
    if len(marked):
        nxt = np.where(solid[starts], starts + len(special), nxt)
    return starts, nxt, solid[starts]
