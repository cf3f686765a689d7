"""Byte-level BPE by prefix dynamic programming.

For every byte prefix of a piece there is exactly one token that ends its encoding. A token ``u`` ends the
prefix if the prefix before it ends in a token ``t`` and merging the bytes of ``t`` and ``u`` gives back
exactly ``[t, u]``. The table of these last tokens gives the encoding by walking back from the end, grows
by one entry for each appended byte, and after an edit has to be filled anew only until it meets the old
table again.

Texts are cut by the vocabulary's pattern first and each piece is encoded alone. Null counts as empty; an
empty text has no ids. Ids outside the vocabulary cannot be decoded and raise.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterable, Iterator
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.shared import give_back, with_workers, worker_table

#: Pieces whose encodings a worker remembers; beyond it starts again, so memory stays bounded.
REMEMBERED = 250_000
#: Characters of texts whose pieces are held at once; one text may go beyond it.
HELD = 1 << 19
#: Pairs of tokens whose fit is remembered.
FITS_KEPT = 500_000


class Vocabulary:
    """Ranks of byte strings, and which tokens may stand side by side."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.of_id = {i: token for token, i in ranks.items()}
        self.longest = max(map(len, ranks))
        self._fits: dict[int, dict[int | None, bool]] = {}  # by token, then by the token before it
        self._n_fits = 0
        self._halves: dict[int, tuple[int, int] | None] = {}

    @classmethod
    def from_rank_file(cls, path: str) -> Vocabulary:
        with open(path, "rb") as file:
            pairs = (line.split() for line in file if line.strip())
            return cls({base64.b64decode(token): int(rank) for token, rank in pairs})

    def merge(self, data: bytes, below: int = 1 << 40) -> list[int]:
        """Ids by the merge rule itself: always join the adjacent pair of lowest rank, of ranks under ``below``."""
        parts = [data[i : i + 1] for i in range(len(data))]
        ranks = self.ranks
        while len(parts) > 1:
            best, at = min((ranks.get(a + b, below), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if best >= below:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``; None for a single byte and for tokens no merge makes."""
        if token not in self._halves:
            data = self.of_id[token]
            parts = self.merge(data, token) if len(data) > 1 else []
            self._halves[token] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self._halves[token]

    def _stays(self, left: int, right: int) -> bool:
        """Whether merging the bytes of two tokens side by side gives back both.

        Runs the merges backwards: of the two parts at the border, the one made later is undone. If at any
        moment the two parts at the border could merge before one of them is used up, they would have.
        """
        used_left = used_right = 1 << 40
        while True:
            across = self.ranks.get(self.of_id[left] + self.of_id[right])
            if across is not None and across < used_left and across <= used_right:
                return False
            if len(self.of_id[left]) > 1 and (left > right or len(self.of_id[right]) == 1):
                used_left, left = left, self.halves(left)[1]
            elif len(self.of_id[right]) > 1:
                used_right, right = right, self.halves(right)[0]
            else:
                return True

    def fits(self, before: int | None, token: int) -> bool:
        """Whether ``token`` may follow ``before`` (None: the start), which ends a valid encoding."""
        return self.learn(before, token, self.followed(token))

    def followed(self, token: int) -> dict[int | None, bool]:
        """What is known of ``token`` behind other tokens."""
        return self._fits.setdefault(token, {})

    def learn(self, before: int | None, token: int, known: dict[int | None, bool]) -> bool:
        """:meth:`fits`, with the answers known of ``token``; remembers FITS_KEPT answers in all."""
        found = known.get(before)
        if found is None:
            made = len(self.of_id[token]) == 1 or self.halves(token) is not None
            found = made and (before is None or self._stays(before, token))
            if self._n_fits >= FITS_KEPT:
                for answers in self._fits.values():
                    answers.clear()
                self._n_fits = 0
            known[before] = found
            self._n_fits += 1
        return found


class Endings:
    """The tokens that end at each byte of a text, by an automaton whose states are compiled when first met.

    The state is the longest ending of the bytes read that begins a token, so every token that ends here is an
    ending of it.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.heads = {token[:i] for token in vocabulary.ranks for i in range(1, len(token) + 1)}
        self.texts, self.numbers = [b""], {b"": 0}
        #: by state: size, token and what is known of the token, the longest first
        self.tokens: list[list[tuple[int, int, dict[int | None, bool]]]] = [[]]
        #: by state: the state that follows it with each byte met so far
        self.steps: list[dict[int, int]] = [{}]

    def compile(self, state: int, byte: int) -> int:
        text = self.texts[state] + bytes((byte,))
        while text not in self.heads:
            text = text[1:]
            if not text:
                raise ValueError(f"no token of the vocabulary begins with byte {byte}")
        number = self.numbers.get(text)
        if number is None:
            number = self.numbers[text] = len(self.texts)
            self.texts.append(text)
            self.steps.append({})
            ending = [(len(text) - i, self.vocabulary.ranks.get(text[i:])) for i in range(len(text))]
            self.tokens.append([(n, t, self.vocabulary.followed(t)) for n, t in ending if t is not None])
        self.steps[state][byte] = number
        return number


class PrefixTable:
    """The last token of every prefix of one piece."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary = vocabulary
        self.data = b""
        self.last: list[int | None] = [None]
        self.append(data)

    def _entry(self, data: bytes, end: int, last: list[int | None]) -> int:
        voc = self.vocabulary
        for size in range(min(end, voc.longest), 0, -1):
            token = voc.ranks.get(data[end - size : end])
            if token is not None and voc.fits(last[end - size], token):
                return token
        raise ValueError(f"no token of the vocabulary ends prefix {end}")

    def append(self, more: bytes) -> None:
        """Add bytes: one new entry each, the old ones stay."""
        data, last = self.data + more, self.last
        for end in range(len(self.data) + 1, len(data) + 1):
            last.append(self._entry(data, end, last))
        self.data = data

    def edit(self, start: int, stop: int, new: bytes) -> int:
        """Replace ``data[start:stop]``; returns how many entries were computed.

        Behind the edit the old entries hold again once as many of them in a row as the longest token has
        bytes came out the same: every later entry depends on those alone.
        """
        data = self.data[:start] + new + self.data[stop:]
        last, shift, same, done = self.last[: start + 1], len(new) - (stop - start), 0, 0
        need = self.vocabulary.longest + 1  # entries that later ones can look back to
        for end in range(start + 1, len(data) + 1):
            last.append(self._entry(data, end, last))
            done += 1
            behind = end > start + len(new) and last[end] == self.last[end - shift]
            same = same + 1 if behind else 0
            if same >= need:
                last += self.last[end - shift + 1 :]
                break
        self.data, self.last = data, last
        return done

    def ids(self) -> list[int]:
        out, end = [], len(self.data)
        while end:
            out.append(self.last[end])
            end -= len(self.vocabulary.of_id[self.last[end]])
        return out[::-1]


def encode_pieces(endings: Endings, pieces: Iterable[bytes]) -> Iterator[list[int]]:
    """Ids of each piece. Of sorted pieces, each takes over the table of the one before as far as they agree."""
    learn, ranks = endings.vocabulary.learn, endings.vocabulary.ranks
    steps, tokens, compile = endings.steps, endings.tokens, endings.compile
    last: list[int | None] = [None]
    start, states = [0], [0]
    before = b""
    for data in pieces:
        whole = ranks.get(data)
        if whole is not None:  # a token is its own encoding
            yield [whole]
            continue
        same = 0
        for x, y in zip(before, data):
            if x != y:
                break
            same += 1
        del last[same + 1 :], start[same + 1 :], states[same + 1 :]
        state = states[same]
        for end, byte in enumerate(data[same:], same + 1):
            following = steps[state].get(byte)
            state = compile(state, byte) if following is None else following
            for size, token, known in tokens[state]:
                fit = known.get(last[end - size])
                if fit or fit is None and learn(last[end - size], token, known):
                    break
            else:
                raise ValueError(f"no token of the vocabulary ends prefix {end}")
            states.append(state)
            last.append(token)
            start.append(end - size)
        before, out, end = data, [], len(data)
        while end:
            out.append(last[end])
            end = start[end]
        yield out[::-1]


# The pattern that most files are made for, and the same for the standard library, which is faster but has no
# classes of letters: right for texts without the characters of _OTHER (letters beyond U+024F, numbers that are no
# digits, information separators). What is left is few enough to name its letters, digits, spaces and other
# characters as ranges, which are found faster than classes.
_USUAL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_OTHER = re.compile("[^\t-\r -~\x80-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f]")


def _ranges(pattern: str) -> str:
    """The characters that ``pattern`` matches, without those of _OTHER, to be put in brackets."""
    found: list[list[int]] = []
    for code in range(0x250):
        if re.match(pattern, chr(code)) and not _OTHER.match(chr(code)):
            if found and found[-1][1] == code - 1:
                found[-1][1] = code
            else:
                found.append([code, code])
    return "".join(f"\\u{first:04x}-\\u{last:04x}" for first, last in found)


_LETTER, _DIGIT, _SPACE, _SIGN = map(_ranges, (r"[^\W\d_]", r"\d", r"\s", r"[^\s\w]|_"))
_FAST = re.compile(
    f" ?[{_LETTER}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[{_DIGIT}]+| ?[{_SIGN}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)


def matcher(pattern: str) -> Callable[[str], list[str]]:
    """All matches of ``pattern`` in a text."""
    find = regex.compile(pattern).findall
    if pattern != _USUAL:
        return find
    return lambda text: find(text) if _OTHER.search(text) else _FAST.findall(text)


class Encoder:
    """Texts to ids. Remembers two generations of pieces, so that frequent ones stay and memory is bounded."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary, self.find = vocabulary, matcher(pattern)
        self.endings = Endings(vocabulary)
        self.young: dict[str, bytes] = {}  # ids as 32-bit numbers
        self.old: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        cut = [self.find(t) for t in texts]
        if len(self.young) > REMEMBERED:
            self.old, self.young = self.young, {}
        known, old = self.young, self.old
        unseen = set().union(*cut).difference(known)
        known.update((p, old[p]) for p in unseen if p in old)
        new = sorted(p for p in unseen if p not in known)  # in the order of their bytes too
        if len(new) > REMEMBERED or any(len(p) > 64 for p in new):  # not worth remembering
            known = dict(known)
        for piece, ids in zip(new, encode_pieces(self.endings, map(str.encode, new))):
            known[piece] = pack(f"={len(ids)}i", *ids)
        return [np.frombuffer(b"".join(map(known.__getitem__, pieces)), np.int32) for pieces in cut]


def _encoder(path: str, pattern: str) -> Encoder:
    return Encoder(Vocabulary.from_rank_file(path), pattern)


def _token_bytes(path: str) -> pa.Array:
    of_id = Vocabulary.from_rank_file(path).of_id
    return pa.array([of_id.get(i) for i in range(max(of_id) + 1)], pa.large_binary())


def encode_batch(texts: pa.Array, path: str, pattern: str) -> pa.Array:
    encoder, rows, group, held = worker_table("bpe", _encoder, path, pattern), [], [], 0
    for i in range(len(texts)):
        group.append(texts[i].as_py() or "")
        held += len(group[-1])
        if held >= HELD or i == len(texts) - 1:
            rows += encoder.encode(group)
            group, held = [], 0
    give_back()
    borders = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(borders), pa.array(np.concatenate(rows) if rows else [], pa.int32()))


def decode_batch(ids: pa.Array, path: str) -> pa.Array:
    """The bytes of each row of ids: one gather of token bytes, whose buffer is the answer."""
    sizes = np.asarray(ids.value_lengths().fill_null(0), np.int64)
    parts = worker_table("bpe", _token_bytes, path).take(ids.flatten())
    if parts.null_count:
        raise ValueError("an id is not in the vocabulary")
    borders = np.frombuffer(parts.buffers()[1], np.int64)[parts.offset :][: len(parts) + 1] if len(parts) else [0]
    rows = np.asarray(borders)[np.concatenate(([0], np.cumsum(sizes)))].astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(sizes), [None, pa.py_buffer(np.ascontiguousarray(rows)), parts.buffers()[2]]
    ).cast(pa.binary())


def encode(df: DataFrame, text: Column, path: str, pattern: str) -> Column:
    """``text`` as an array of token ids; ``df`` is the table the column is used on."""
    with_workers(df)

    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        return encode_batch(texts, path, pattern)

    return ids(text)


def decode(df: DataFrame, ids: Column, path: str) -> Column:
    """The bytes that an array of token ids stands for; null and empty arrays give no bytes."""
    with_workers(df)

    @F.arrow_udf("binary")
    def data(rows: pa.Array) -> pa.Array:
        return decode_batch(rows, path)

    return data(ids)
