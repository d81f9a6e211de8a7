"""Byte-level BPE token ids of whole texts with the `tokenizers` library, fast.

Calling the tokenizer on every text costs about 4 microseconds a word; most words of a corpus
come again and again. A byte-level BPE without normaliser works on pre-tokens independently,
and a space between two non-space characters always starts a new pre-token, so a text can be
cut at such spaces, each piece encoded once, and the ids joined. `encode_column` cuts a slice of
an Arrow column, numbers its distinct pieces, looks them up among those of earlier slices, sends
the new ones to the tokenizer many at a time, and puts the ids of all its texts together with
numpy; no Python object is made per word. The result equals
`Tokenizer.encode(text, add_special_tokens=False).ids`; `tests/llm` compare the two.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidemark.llm.common import give_back

ID = np.dtype("<u4")
#: pieces that a worker keeps, and for texts that are encoded one by one (in each of two generations)
CACHE = 400_000
CACHE_ONE = 100_000
#: longer pieces (bytes) are not kept
LONG = 64
#: pieces in a string for the tokenizer, and strings in a call
JOIN, CALL = 64, 64
#: bytes of text (at most, a batch has its own bound) whose distinct pieces are numbered at once,
#: and words put together at once
SLICE = 16 << 20
WORDS = 1 << 17
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: ASCII punctuation but the apostrophe, which starts pre-tokens of its own
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: ends in a digit or a letter (of the larger alphabets): a mark behind it starts a pre-token
_LETTER_END = (r"[0-9A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}\x{391}-\x{3A1}\x{3A3}-\x{3C9}"
               r"\x{410}-\x{44F}\x{5D0}-\x{5EA}\x{4E00}-\x{9FA5}\x{AC00}-\x{D7A3}]\z")
#: empty, or white space at an end (but for one line end in front): the cut was not between words
_SPACES = r"\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_BESIDE = rf"\A(?:\n?[\t\x0B-\r{_SPACES}]|\z)|[\t-\r{_SPACES}]\z"


def _byte_chars() -> list[str]:
    """The byte-level alphabet: printable bytes as they are, the others from U+0100 on."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, n = [""] * 256, 0
    for b in range(256):
        if b in keep:
            out[b] = chr(b)
        else:
            out[b], n = chr(256 + n), n + 1
    return out


class _Beside(Exception):
    """A piece that is empty, or has white space at an end: the cut was not between words."""


class _Pieces(dict):
    """Ids of what follows a space, the space's included. Two generations: when the young one
    is full it becomes the old one, so common words stay and memory is bounded."""

    def __init__(self, encode, old=None):
        self.encode, self.old = encode, old

    def __missing__(self, s: str) -> bytes:
        got = self.old.get(s) if self.old is not None else None
        if got is None:
            got = self.encode(s)
        self[s] = got
        return got


class Encoder:
    """Encodes texts with the tokenizer file at `path`; `encode` returns little-endian
    unsigned 32-bit ids as bytes."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")       # a task has one core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.table = {i: c for i, c in enumerate(_byte_chars())}
        self.space = self.table[32]
        self.pieces = _Pieces(self._piece)
        # the kept pieces of encode_column, where their ids are, and how often and lately they came
        self.keys = pa.array([], pa.large_string())
        self.flat, self.at, self.score = np.zeros(0, ID), np.zeros(1, np.int64), np.zeros(0, np.float32)
        vocab = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(vocab.values()) + 1, bool)           # tokens that open a piece
        self.opens[[i for t, i in vocab.items() if t[:1] in (self.space, self.table[10])]] = True

    def _full(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _token(self, s: str) -> bytes:
        """Ids of one pre-token, given in the byte-level alphabet."""
        return array("I", [t.id for t in self.tokenize(s)]).tobytes()

    def _piece(self, s: str) -> bytes:
        """Ids of a space and `s`. Letters are one pre-token with the space before them, ASCII
        punctuation after letters is another one; anything else goes through the tokenizer."""
        if s.isalpha():
            return self._token(self.space + self._mapped(s))
        if not s or s[0].isspace() or s[-1].isspace():
            raise _Beside
        letters = s.rstrip(_MARKS)
        if not letters.isalpha():
            return self._full(" " + s)
        return self.pieces[letters] + self._token(s[len(letters):])

    def _mapped(self, s: str) -> str:
        return s if s.isascii() else s.encode().decode("latin-1").translate(self.table)

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if "<|endoftext|>" in text:
            return self._full(text)
        if len(self.pieces) >= min(CACHE, CACHE_ONE):
            self.pieces = _Pieces(self._piece, dict(self.pieces))
        pieces = text.split(" ")
        try:
            if not pieces[0] or pieces[0][-1].isspace():
                raise _Beside
            return self._full(pieces[0]) + b"".join(map(self.pieces.__getitem__, pieces[1:]))
        except _Beside:                     # cut only between two characters other than white space
            first, *rest = _CUT.split(text)
            return self._full(first) + b"".join([self._spaced(p) for p in rest])

    def _spaced(self, s: str) -> bytes:
        try:
            return self.pieces[s]
        except _Beside:
            return self._full(" " + s)

    def encode_column(self, column: pa.Array, end_id: int):
        """Ids of the texts of an Arrow string column (NULL: empty), `end_id` after each, in slices:
        yields (first row, ids, offsets of the rows' ids)."""
        column = pc.fill_null(column.cast(pa.large_string()), "")
        ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))
        row = 0
        while row < len(column):
            before = ends[row - 1] if row else 0
            stop = max(row + 1, int(np.searchsorted(ends, before + SLICE)))
            for first, ids, at in self._slice(column.slice(row, stop - row), end_id):
                yield row + first, ids, at
            give_back()
            row = stop

    def _encode_pieces(self, pieces: pa.Array):
        """Ids of pieces that are not _BESIDE, each with its space or line end, and where each one's start."""
        texts = pc.if_else(pc.starts_with(pieces, "\n"), pieces, pc.binary_join_element_wise(_text(""), pieces, _text(" ")))
        ends, data = _buffers(texts)
        parts, starts, done = [], [], 0
        for lo in range(0, len(pieces), JOIN * CALL):
            hi = min(len(pieces), lo + JOIN * CALL)
            cuts = [*ends[lo:hi:JOIN].tolist(), int(ends[hi])]
            joined = [data[a:b].tobytes().decode() for a, b in zip(cuts, cuts[1:])]
            ids = np.concatenate([np.array(e.ids, ID) for e in
                                  self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)])
            # a piece has one space or line end, its first character, and that opens its first token
            at = np.flatnonzero(self.opens[ids])
            if len(at) != hi - lo:          # another kind of tokenizer
                each = [np.frombuffer(self._full(t), ID) for t in texts[lo:hi].to_pylist()]
                ids, at = np.concatenate(each), np.cumsum([0, *map(len, each)])[:-1]
            parts.append(ids)
            starts.append(at + done)
            done += len(ids)
        return np.concatenate([np.zeros(0, ID), *parts]), np.concatenate([*starts, [done]]).astype(np.int64)

    def _look_up(self, pieces: pa.Array):
        """Of each piece the place and the number of its ids in an array, that array, and whether the
        piece is _BESIDE. New pieces are kept for the next slices."""
        found = pc.index_in(pieces, value_set=self.keys)
        new = pieces.filter(found.is_null()).unique()
        new = new.filter(pc.invert(pc.match_substring_regex(new, _BESIDE)))
        have = len(self.keys)
        place = pc.coalesce(found, pc.add(pc.index_in(pieces, value_set=new), pa.scalar(have, pa.int32())))
        place = pc.fill_null(place, -1).to_numpy()
        flat, at = self._encode_pieces(new)
        flat, at = np.concatenate([self.flat, flat]), np.concatenate([self.at, at[1:] + self.at[-1]])
        odd = place < 0
        place = np.maximum(place, 0)
        starts, sizes = (at[:-1][place], np.diff(at)[place]) if len(at) > 1 else (np.zeros(len(place), np.int64),) * 2
        sizes = np.where(odd, 0, sizes)

        keys = pa.concat_arrays([self.keys, new])
        score = np.concatenate([self.score / 2, np.zeros(len(new), np.float32)])
        score[place[~odd]] += 1
        keep = np.flatnonzero(pc.less_equal(pc.binary_length(keys), LONG).to_numpy(zero_copy_only=False))
        if len(keep) > CACHE:
            keep = np.sort(keep[np.argpartition(score[keep], len(keep) - CACHE)[len(keep) - CACHE:]])
        if len(keep) < len(keys):
            n = np.diff(at)[keep]
            self.keys, self.score = keys.take(pa.array(keep)), score[keep]
            self.flat, self.at = _ranges(flat, at[:-1][keep], n), np.concatenate([[0], np.cumsum(n)])
        else:
            self.keys, self.score, self.flat, self.at = keys, score, flat, at
        return starts, sizes, flat, odd

    def _slice(self, texts: pa.Array, end_id: int):
        # a line end between two characters other than white space is a pre-token: cut there too
        cut = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        at = cut.offsets.to_numpy() - cut.offsets[0].as_py()
        first, n = at[:-1], len(texts)
        words = cut.flatten().dictionary_encode()
        del cut
        codes = words.indices.to_numpy().copy()
        # a text's head has no space before it: it is encoded behind a line end, whose id goes
        m = len(words.dictionary)
        heads = pc.binary_join_element_wise(_text(""), words.dictionary.take(pa.array(codes[first])), _text("\n"))
        pieces = pa.concat_arrays([words.dictionary, heads])
        codes[first] = m + np.arange(n)
        del words, heads
        # marks at the end are another pre-token, and the same ones come again: encoded like a head
        core = pc.ascii_rtrim(pieces, characters=_MARKS)
        core = pc.if_else(pc.match_substring_regex(core, _LETTER_END), core, pieces)
        ends, data = _buffers(pieces)
        tail = np.diff(ends) - np.diff(_buffers(core)[0])
        marked = np.flatnonzero(tail)
        tail = tail[marked]
        tails = pa.Array.from_buffers(pa.large_string(), len(marked), [
            None, pa.py_buffer(np.concatenate([[0], np.cumsum(tail)]).astype(np.int64)),
            pa.py_buffer(_ranges(data, ends[1:][marked] - tail, tail))])
        tails = pc.binary_join_element_wise(_text(""), tails, _text("\n"))
        del pieces, ends, data
        starts, sizes, flat, odd = self._look_up(pa.concat_arrays([core, tails]))
        del core, tails
        odd = odd[:m + n]
        starts[m:] += 1
        sizes[m:] -= 1
        sizes[:m + n][odd] = 0
        both, count = np.zeros((2, m + n, 2), np.int64)
        both[:, 0], count[:, 0] = starts[:m + n], sizes[:m + n]
        both[marked, 1], count[marked, 1] = starts[m + n:], sizes[m + n:]
        flat = _ranges(flat, both.ravel(), count.ravel())
        sizes = count.sum(axis=1)
        starts = np.cumsum(sizes) - sizes
        # texts where a cut was not between words are encoded one by one, into their head's place
        whole = np.logical_or.reduceat(odd[codes], first)
        whole |= pc.match_substring(texts, "<|endoftext|>").to_numpy(zero_copy_only=False)
        more, done = [], len(flat)
        for i in np.flatnonzero(whole).tolist():
            more.append(np.frombuffer(self.encode(texts[i].as_py()), ID))
            starts[m + i], sizes[m + i] = done, len(more[-1])
            done += len(more[-1])
        flat = np.concatenate([flat, *more, np.array([end_id], ID)])
        starts, sizes, last, lo = np.append(starts, done), np.append(sizes, 1), m + n, 0
        del more
        # per text: its head (or all its ids), the other pieces, the end id
        while lo < n:
            hi = min(n, max(lo + 1, int(np.searchsorted(at, at[lo] + WORDS))))
            own = at[lo:hi + 1] - at[lo]
            part = np.insert(codes[at[lo]:at[hi]], own[1:], last)
            count = sizes[part]
            for i in np.flatnonzero(whole[lo:hi]).tolist():        # only the head, which holds all ids
                count[own[i] + i + 1:own[i + 1] + i] = 0
            total = np.cumsum(count)
            yield lo, _ranges(flat, starts[part], count), np.concatenate([[0], total[own[1:] + np.arange(hi - lo)]])
            lo = hi


def _text(s: str) -> pa.Scalar:
    return pa.scalar(s, pa.large_string())


def _buffers(strings: pa.Array):
    """Offsets and bytes of a large_string array."""
    if not len(strings):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, ends, data = strings.buffers()
    ends = np.frombuffer(ends, np.int64, strings.offset + len(strings) + 1)[strings.offset:]
    return ends, np.frombuffer(data or b"", np.uint8)


def _ranges(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The ranges of `flat` from `starts` on, of `sizes` each, one behind the other."""
    total = np.cumsum(sizes)
    n = int(total[-1]) if len(total) else 0
    return flat[np.repeat(starts - (total - sizes), sizes) + np.arange(n)]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
        give_back()                         # what reading the file took
    return _ENCODERS[path]


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def crc(ids: bytes) -> int:
    return zlib.crc32(ids)
