"""Byte-level BPE ids of a text as the tokenizers library gives them, a word at a time.

The library cuts a text into words before merging. A text of plain characters is cut into the same words here, each
is looked up, and only a word that the worker has not had goes to the library's BPE model. Any other text is cut before
the spaces that follow a character other than white space, where every word ends; its pieces are
treated in the same way if they are plain, and go through the whole library if not.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces that one Python worker remembers at least and twice as many at most, and their most characters.
PIECES, PIECE_CHARS = 300_000, 64
#: A space behind a letter, digit or printable ASCII character. Every other space stays inside a piece, which is always right.
CUT = re.compile(r"(?<=[\w!-~]) ")
#: What a text has that CUT does not cut at every space, or a space after a sign that only CUT knows.
UNCUT = r"(?:^|[^\pL\pN_!-~]) "
#: Plain characters, and the words of byte-level BPE among them (fixed pattern of the vocabulary).
PLAIN = re.compile(r"[ -~\n\tÀ-ÖØ-öø-ſ]*")
WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ſ]+| ?[0-9]+| ?[!-/:-@\[-`{-~]+|\s+(?!\S)|\s+")


def byte_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_level() -> dict[int, str]:
    """Byte -> character of byte-level vocabularies: printable Latin-1 stands for itself, the rest follow from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


#: Classes of the bytes of plain texts: letters (in UTF-8), digits, other printable ones, the space, other white space; what no plain text has.
LETTER, DIGIT, PRINTED, BLANK, BREAK, OTHER = range(6)
KINDS = bytes([BLANK if b == 32 else BREAK if b in b"\n\t" else OTHER if b < 32 or b == 127 or 0xC0 <= b < 0xC3 or b > 0xC5 else DIGIT if 48 <= b < 58
               else LETTER if b > 127 or chr(b).isalpha() else PRINTED for b in range(256)])


def _bytes_of(texts: pa.Array) -> tuple[bytes, np.ndarray]:
    """The UTF-8 of the texts, joined, and where each one ends."""
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64 if pa.types.is_large_string(texts.type) else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    return data[at[0]:at[-1]].to_pybytes() if data is not None and len(texts) else b"", at[1:] - at[:1]


def binaries(parts: list[bytes]) -> pa.Array:
    return split_at(b"".join(parts), np.cumsum([0, *map(len, parts)], dtype=np.int64))


def split_at(data, bounds: np.ndarray) -> pa.Array:
    """The parts of the data between these bounds, of which the first is 0."""
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(data)])


def joined(parts: pa.Array, places: np.ndarray, counts: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """The binaries at these places, joined, and where each run of so many places starts and the last one ends."""
    taken = parts.take(pa.array(places))
    data = memoryview(taken.buffers()[2] or b"")
    return data, np.frombuffer(taken.buffers()[1], np.int64)[:len(places) + 1][np.cumsum(np.r_[0, counts])]


def cut(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(different pieces that CUT makes of the texts, the place of each one in that list, how many each text has); there are no null texts."""
    uncut = pc.match_substring_regex(texts, UNCUT)
    lists = pc.split_pattern(texts, " ")
    if pc.any(uncut).as_py():
        rest = pa.array([CUT.split(t) for t in texts.filter(uncut).to_pylist()], lists.type)
        uncut = uncut.to_numpy(zero_copy_only=False)
        at = np.where(uncut, len(texts) + np.cumsum(uncut) - 1, np.arange(len(texts)))
        lists = pa.concat_arrays([lists, rest]).take(pa.array(at))
    pieces = lists.flatten().dictionary_encode()
    return pieces.dictionary.to_pylist(), pieces.indices.to_numpy(), pc.list_value_length(lists).to_numpy().astype(np.int64)


def _word_starts(data: bytes, kinds: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where the words of plain texts (see WORD) start in their joined bytes."""
    n = len(kinds)
    if not n:
        return np.zeros(0, np.int64)
    full = starts < ends
    starts, ends = starts[full], ends[full]
    printed = kinds < BLANK
    begins = np.empty(n, bool)
    # Behind a space nothing starts but with white space; anything else starts where the class changes.
    np.not_equal(kinds[1:], kinds[:-1], out=begins[1:])
    begins[1:] &= kinds[:-1] != BLANK
    begins[1:] &= printed[1:]
    # White space starts a word behind anything else and, its last character, before anything else; so does a space for the word behind it.
    edge = np.ones(n, bool)
    edge[1:] = printed[:-1]
    edge[:-1] |= printed[1:]
    last = ends - 1
    edge[last] = printed[np.maximum(last - 1, 0)]
    begins |= edge & ~printed
    begins[starts] = True
    # 's, 't, 're, 've, 'm, 'll, 'd where a word would start with the sign; what is left of the letters behind is a word.
    for i in np.flatnonzero((np.frombuffer(data, np.uint8) == 39) & begins).tolist():
        said = data[i + 1:i + 3]
        size = 3 if said in (b"re", b"ve", b"ll") else 2 if said[:1] in (b"s", b"t", b"m", b"d") else 0
        if size:
            end = ends[np.searchsorted(ends, i, "right")]
            if size == 3 and i + 3 > end or i + 2 > end:
                continue
            begins[i + 1] = False
            if i + size < end:
                begins[i + size] = True
    return np.flatnonzero(begins)


class Remembered(dict):
    """A dict that makes missing values. When full it keeps what is asked for again; values of long keys are not kept."""

    def __init__(self, make, most: int = PIECES):
        super().__init__()
        self.make, self.most, self.before = make, most, {}

    def __missing__(self, key):
        value = self.before.get(key)
        if value is None:
            value = self.make(key)
        self.keep(key, value)
        return value

    def keep(self, key, value) -> None:
        if len(key) <= PIECE_CHARS:
            if len(self) >= self.most:
                self.before = dict(self)
                self.clear()
            self[key] = value


class ByteBpe:
    """``special``: whether strings of special tokens in a text are those tokens; ``most``: words remembered (see Remembered)."""

    def __init__(self, path: str, special: bool, most: int = PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = not special
        self.model, self.characters = self.library.model, byte_level()
        self.specials = [t.content for t in self.library.get_added_tokens_decoder().values()] if special else []
        self.words = Remembered(self._word, most)
        self.others = Remembered(lambda piece: array("I", self.library.encode(piece, add_special_tokens=False).ids).tobytes(), most)

    def _word(self, word: str) -> bytes:
        if word.isascii() and word.isprintable():
            said = word.replace(" ", "Ġ")  # the only one of these characters that stands for another
        else:
            said = word.encode().decode("latin-1").translate(self.characters)
        return array("I", [t.id for t in self.model.tokenize(said)]).tobytes()

    def _plain(self, text: str) -> bool:
        return PLAIN.fullmatch(text) is not None and not any(s in text for s in self.specials)

    def encode(self, text: str) -> bytes:
        """The ids as unsigned 32-bit integers in the machine's order (see ids)."""
        if self._plain(text):
            return b"".join(map(self.words.__getitem__, WORD.findall(text)))
        first, *rest = CUT.split(text)
        pieces = [first, *(" " + p for p in rest)]
        return b"".join([b"".join(map(self.words.__getitem__, WORD.findall(p))) if self._plain(p) else self.others[p] for p in pieces])

    def spelled(self, units: list[bytes], words: int) -> list[bytes]:
        """The ids of each of the words and pieces of units(), of which the first so many are known to be words."""
        said = [u.decode() for u in units]
        return [*map(self.words.__getitem__, said[:words]), *(self.words[u] if self._plain(u) else self.others[u] for u in said[words:])]

    def units(self, texts: pa.Array) -> tuple[list[bytes], int, np.ndarray, np.ndarray]:
        """(different words and pieces of the texts in UTF-8, how many of the first are words of plain texts, the place of each one's in that
        list, how many each text has): the same ones, in order, whose ids encode() joins. Plain texts are cut together, by the classes of
        their bytes; there are no null texts."""
        data, ends = _bytes_of(texts)
        kinds = np.frombuffer(data.translate(KINDS), np.uint8)
        starts, others = np.r_[0, ends][:-1], np.zeros(len(ends), bool)
        odd = np.flatnonzero(kinds == OTHER)
        if b"\xc3" in data:
            after = np.flatnonzero(np.frombuffer(data, np.uint8) == 0xC3) + 1
            odd = np.r_[odd, after[np.isin(np.frombuffer(data, np.uint8)[after], (0x97, 0xB7))]]  # × and ÷ are no letters
        others[np.searchsorted(ends, odd, "right")] = True
        for special in self.specials:
            if special.encode() in data:
                others |= np.array([special in t for t in texts.to_pylist()])
        if not others.any():
            places = _word_starts(data, kinds, starts, ends)
            cut = pa.Array.from_buffers(pa.binary(), len(places), [None, pa.py_buffer(np.r_[places, len(data)].astype(np.int32)), pa.py_buffer(data)])
            cut = cut.dictionary_encode()
            said, at = _bytes_of(cut.dictionary)
            at = at.tolist()
            found = [said[a:b] for a, b in zip([0, *at], at)]
            return found, len(found), cut.indices.to_numpy(), np.diff(np.searchsorted(places, np.r_[starts, len(data)]))
        found, words, at, n = self.units(texts.filter(pa.array(~others)))
        known, rest = dict(zip(found, range(len(found)))), []
        for text in texts.filter(pa.array(others)).to_pylist():
            first, *more = CUT.split(text)
            cut = [w for p in [first, *(" " + p for p in more)] for w in (WORD.findall(p) if self._plain(p) else [p])]
            rest.append(np.array([known.setdefault(w.encode(), len(known)) for w in cut], np.int32))
        counts = np.zeros(len(ends), np.int64)
        counts[~others], counts[others] = n, [len(x) for x in rest]
        whole, parts = iter(np.split(at, np.cumsum(n))), iter(rest)
        return list(known), words, np.concatenate([next(parts if odd else whole) for odd in others.tolist()]), counts

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encode(text), np.uint32)


@lru_cache(4)
def byte_bpe(path: str, special: bool) -> ByteBpe:
    return ByteBpe(path, special)
