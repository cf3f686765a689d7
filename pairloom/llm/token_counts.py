"""Token counts by two finite-state transducers compiled from a byte-level BPE vocabulary.

The first cuts texts into pieces as the vocabulary's pattern does. It reads one character class at a time;
a transition says whether a piece begins at the character read or at the one before. A batch of texts is one
stream of classes, with an end mark after each text, cut into chunks of equal length. Each chunk is run from
every state at once, which gives its state map; the maps are composed by a parallel prefix scan, which gives
each chunk's true entry state; a last run from there puts out the piece borders. So a text of any length is
worked on in parallel, in steps over all chunks together.

The second reads the bytes of a piece; a transition is annotated with the number of tokens it adds (which may
be negative: a byte can merge earlier tokens). Its state is what decides the next step: the longest ending of
the bytes read that can still grow into a token, and for each position in it the last token of the encoding up
to there and how many tokens ago that was. States and transitions are compiled when first met and kept up to a
bound.

Special strings inside texts are one token each, as in the library. Null and empty texts have no tokens.
"""

from __future__ import annotations

import json
import sys
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.bpe import Vocabulary
from pairloom.llm.shared import with_workers, worker_table

CHUNK = 256
#: Characters of the stream that are worked on at once; one text may go beyond it.
STREAM = 1 << 20
#: Transitions, and counts of pieces, that a worker keeps; beyond it starts again.
KEPT = 200_000

# Character classes.
LETTER, STMD, ER_R, VE_V, E, LL_L, NUMBER, BLANK, SPACE, OTHER, QUOTE, END = range(12)
# States: what the piece being read looks like.
START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, ONE_BLANK, BLANKS, ONE_SPACE, SPACES, AT_QUOTE, QUOTE_R, QUOTE_V, QUOTE_L = range(12)
HERE, BEFORE = 1, 2  # a piece begins at this character, at the one before


def _transitions() -> tuple[np.ndarray, np.ndarray]:
    """next state and borders, by state * 12 + class.

    The pattern's alternatives in order: the contractions 's 't 're 've 'm 'll 'd; letters, numbers or others,
    each with a blank before; white space up to the last one before a solid character; white space.
    """
    nxt, out = np.zeros((12, 12), np.uint8), np.zeros((12, 12), np.uint8)
    letters = (LETTER, STMD, ER_R, VE_V, E, LL_L)
    runs = {**dict.fromkeys(letters, IN_LETTERS), NUMBER: IN_NUMBERS, OTHER: IN_OTHERS}
    fresh = {**runs, BLANK: ONE_BLANK, SPACE: ONE_SPACE, QUOTE: AT_QUOTE, END: START}
    for state in range(12):
        for c, target in fresh.items():  # a new piece begins with this character
            nxt[state, c], out[state, c] = target, HERE
    for state in (IN_LETTERS, IN_NUMBERS, IN_OTHERS):
        for c, target in runs.items():
            if target == state:
                out[state, c] = 0
    nxt[IN_OTHERS, QUOTE], out[IN_OTHERS, QUOTE] = IN_OTHERS, 0
    for c, target in {**runs, QUOTE: IN_OTHERS}.items():  # a blank joins the run behind it
        nxt[ONE_BLANK, c], out[ONE_BLANK, c] = target, 0
        nxt[BLANKS, c], out[BLANKS, c] = target, BEFORE
        out[SPACES, c] = HERE | BEFORE  # of longer white space, the last one stands alone
    for state in (ONE_BLANK, BLANKS, ONE_SPACE, SPACES):
        nxt[state, BLANK], out[state, BLANK] = BLANKS, 0
        nxt[state, SPACE], out[state, SPACE] = SPACES, 0
    nxt[AT_QUOTE, OTHER] = nxt[AT_QUOTE, QUOTE] = IN_OTHERS
    out[AT_QUOTE, OTHER] = out[AT_QUOTE, QUOTE] = 0
    nxt[AT_QUOTE, STMD], out[AT_QUOTE, STMD] = START, 0
    for c, pending in ((ER_R, QUOTE_R), (VE_V, QUOTE_V), (LL_L, QUOTE_L)):
        nxt[AT_QUOTE, c], out[AT_QUOTE, c] = pending, 0
    for state, done in ((QUOTE_R, E), (QUOTE_V, E), (QUOTE_L, LL_L)):
        nxt[state], out[state] = nxt[IN_LETTERS], out[IN_LETTERS] | BEFORE  # it was a quote, then a letter
        nxt[state, done], out[state, done] = START, 0
    return nxt.ravel(), out.ravel()


NEXT, BORDER = _transitions()


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of every code point."""
    every = "".join(map(chr, [*range(0xD800), *([0x2FFFF] * 0x800), *range(0xE000, sys.maxunicode + 1)]))
    table = np.full(len(every), OTHER, np.uint8)
    for pattern, c in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", SPACE)):
        for run in regex.finditer(pattern, every):
            table[run.start() : run.end()] = c
    for chars, c in (("stmd", STMD), ("r", ER_R), ("v", VE_V), ("e", E), ("l", LL_L), (" ", BLANK), ("'", QUOTE)):
        table[[ord(x) for x in chars]] = c
    return table


def compose(maps: np.ndarray) -> np.ndarray:
    """Running compositions of state maps (one row each, applied in order), in log steps over all rows."""
    maps, step = maps.copy(), 1
    while step < len(maps):
        maps[step:] = np.take_along_axis(maps[step:], maps[:-step], 1)
        step *= 2
    return maps


def borders(classes: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """Whether a piece (or an end mark) begins at each character of a stream that starts with a text."""
    n = len(classes)
    rows = -(-n // chunk)
    lanes = np.full(rows * chunk, END, np.uint8)
    lanes[:n] = classes
    lanes = np.ascontiguousarray(lanes.reshape(rows, chunk).T)
    maps = np.tile(np.arange(12, dtype=np.uint8), (rows, 1)).T.copy()  # states by chunks
    for c in lanes:
        maps = NEXT[maps * np.uint8(12) + c]
    ends = compose(np.ascontiguousarray(maps.T))[:, START]
    state = np.concatenate(([START], ends[:-1])).astype(np.uint8)
    said = np.empty((chunk, rows), np.uint8)
    for i, c in enumerate(lanes):
        key = state * np.uint8(12) + c
        said[i], state = BORDER[key], NEXT[key]
    said = said.T.ravel()[:n]
    begins = (said & HERE) > 0
    begins[:-1] |= (said[1:] & BEFORE) > 0
    return begins


class CountTransducer:
    """Bytes of a piece to its number of tokens."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.heads = {token[:i] for token in vocabulary.ranks for i in range(1, len(token) + 1)}
        self.clear()

    def clear(self) -> None:
        first = (b"", (None,), (0,))
        self.states, self.numbers = [first], {first: 0}
        self.steps: dict[int, tuple[int, int]] = {}

    def _compile(self, state: int, byte: int) -> tuple[int, int]:
        ending, tokens, ago = self.states[state]
        grown = ending + bytes((byte,))
        for size in range(len(grown), 0, -1):
            token = self.vocabulary.ranks.get(grown[-size:])
            if token is not None and self.vocabulary.fits(tokens[len(tokens) - size], token):
                break
        else:
            raise ValueError(f"no token of the vocabulary ends in byte {byte}")
        added = 1 - ago[len(ago) - size]
        keep = next(i for i in range(len(grown) + 1) if i == len(grown) or grown[i:] in self.heads)
        following = (grown[keep:], (*tokens, token)[keep:], (*(a + added for a in ago), 0)[keep:])
        number = self.numbers.setdefault(following, len(self.states))
        if number == len(self.states):
            self.states.append(following)
        self.steps[state << 8 | byte] = number, added
        return number, added

    def count(self, piece: bytes) -> int:
        if len(self.steps) > KEPT:
            self.clear()
        state, total, steps = 0, 0, self.steps
        for byte in piece:
            step = steps.get(state << 8 | byte)
            state, added = step if step is not None else self._compile(state, byte)
            total += added
        return total


class Counter:
    """Counts of whole batches of texts for one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], specials: tuple[str, ...] = ()):
        self.transducer = CountTransducer(Vocabulary(ranks))
        self.special = regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True)))) if specials else None
        self.known: dict[int, int] = {}

    def _stream(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text; no special strings are left in them."""
        codes = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le"), np.uint32)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        ends = np.cumsum(sizes) - 1
        classes = _classes()[codes]
        classes[ends] = END
        begins = borders(classes)
        width = 1 + (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF)
        at = np.cumsum(width) - width  # of each character, in bytes
        data = "\0".join([*texts, ""]).encode()
        first = np.flatnonzero(begins)  # pieces and end marks in turn
        last = np.append(first[1:], len(codes))
        solid = classes[first] != END
        first, last = first[solid], last[solid]
        start, stop = at[first], np.append(at, len(data))[last]
        keys = _hashes(np.frombuffer(data, np.uint8), start, stop)
        unique, where, inverse = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.known) > KEPT:
            self.known.clear()
        counts = np.empty(len(unique), np.int64)
        for i, (key, k) in enumerate(zip(unique.tolist(), where.tolist())):
            found = self.known.get(key)
            if found is None:
                found = self.known[key] = self.transducer.count(data[start[k] : stop[k]])
            counts[i] = found
        total = np.zeros(len(first) + 1, np.int64)
        np.cumsum(counts[inverse], out=total[1:])
        edge = np.searchsorted(first, np.concatenate(([0], ends)))
        return total[edge[1:]] - total[edge[:-1]]

    def counts(self, texts: list[str]) -> np.ndarray:
        out = np.zeros(len(texts), np.int64)
        rows: list[int] = []
        parts: list[str] = []
        held = 0
        for row, text in enumerate(texts):
            if self.special is not None and self.special.search(text):
                pieces = self.special.split(text)
                out[row] += len(pieces) - 1
            else:
                pieces = [text]
            rows += [row] * len(pieces)
            parts += pieces
            held += len(text)
            if held >= STREAM or row == len(texts) - 1:
                np.add.at(out, rows, self._stream(parts))
                rows, parts, held = [], [], 0
        return out


_POWER = np.uint64(0x9E3779B97F4A7C15)


def _hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges, eight bytes a step over all ranges that are still going on."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    out = (stop - start).astype(np.uint64) * _POWER
    going, at = np.arange(len(start)), start.copy()
    while len(going):
        left = np.minimum(stop[going] - at[going], 8)
        block = words[at[going]].view(np.uint64).ravel()
        block &= np.uint64(0xFFFFFFFFFFFFFFFF) >> ((8 - left).astype(np.uint64) * np.uint64(8))
        mixed = (out[going] ^ block) * np.uint64(0xFF51AFD7ED558CCD)
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0xC4CEB9FE1A85EC53)
        out[going] = mixed ^ (mixed >> np.uint64(29))
        at[going] += 8
        going = going[at[going] < stop[going]]
    return out


def _byte_of_char() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {**{chr(b): b for b in own}, **{chr(256 + i): b for i, b in enumerate(rest)}}


def read_json_vocabulary(path: str) -> tuple[dict[bytes, int], tuple[str, ...]]:
    """Ranks (by order of the merges, the 256 bytes first) and special strings of a byte-level BPE file."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    byte = _byte_of_char()
    ranks = {bytes((b,)): b for b in range(256)}
    for pair in spec["model"]["merges"]:
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        ranks.setdefault(bytes(byte[c] for c in left + right), len(ranks))
    return ranks, tuple(t["content"] for t in spec["added_tokens"])


def _counter(path: str) -> Counter:
    return Counter(*read_json_vocabulary(path))


def count_batch(texts: pa.Array, path: str) -> pa.Array:
    return pa.array(worker_table("token_counts", _counter, path).counts([t or "" for t in texts.to_pylist()]), pa.int64())


def token_counts(df: DataFrame, text: Column, path: str) -> Column:
    """Number of tokens of ``text`` by the byte-level vocabulary at ``path``, which every worker reads."""
    with_workers(df)

    @F.arrow_udf("bigint")
    def counts(texts: pa.Array) -> pa.Array:
        return count_batch(texts, path)

    return counts(text)
