"""SentencePiece encoding and decoding for merge-type (BPE) models, exactly as the library does it,
by backtracking instead of a merge queue.

A sequence of pieces is what merging gives if every two neighbours are compatible: merging
their joined text gives the two again. The encoder takes the longest piece at a position (an
Aho-Corasick automaton lists the pieces at every position), checks it against its left neighbour by
re-merging the two, takes the next shorter piece if that fails, and steps back when none is left,
noting the position as failed so that no position is explored twice.

No piece crosses the start of a word, so words are encoded one by one and looked up if seen
before; runs of spaces, whose pieces all have one score, are merged directly.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .byte_bpe import Remembered
from .common import load, map_arrow, pick

SPACE = "▁"
#: Words remembered by one Python worker at least (twice as many at most: a full table is kept until the next is full, and what is asked
#: for again moves on), and neighbours remembered; a full table of these is emptied.
WORDS, PAIRS = 300_000, 1_000_000
ROWS_OUT = 512


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Codec:
    """Encoder and decoder of one model file. Only the model's pieces, scores and byte pieces are
    read from the library; its encode and decode are not used."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        self.piece = [model.id_to_piece(i) for i in ids]
        self.byte = {i: int(self.piece[i][1:-1], 16) for i in ids if model.is_byte(i)}
        self.byte_id = {b: i for i, b in self.byte.items()}
        normal = [i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.id = {self.piece[i]: i for i in normal}
        self.score = {self.piece[i]: model.get_score(i) for i in normal}
        if any(SPACE in p[1:] and p.strip(SPACE) for p in self.id):
            raise ValueError("a piece of this model crosses the start of a word")
        words = [p for p in self.id if p[:2] != SPACE * 2]
        if len({self.score[p] for p in words}) < len(words):
            raise ValueError("two pieces of this model share a score")
        # A piece that merging never makes from its own text can't be part of any result.
        self.rank = {p: n for n, p in enumerate(sorted((p for p in words if len(p) > 1), key=lambda p: -self.score[p]))}
        self.parts: dict[str, tuple[str, str]] = {}
        self.automaton = ahocorasick.Automaton()
        for p in words:
            if self.merged(p, self.parts) == [p]:
                self.automaton.add_word(p, len(p))
        self.automaton.make_automaton()
        # For each prefix of a piece the longest piece that it starts with, and below each piece the next shorter one.
        self.longest: dict[str, str] = {}
        self.shorter: dict[str, str] = {}
        for p in sorted(self.automaton, key=len):
            for n in range(1, len(p)):
                self.longest.setdefault(p[:n], "")
        for p in sorted({*self.longest, *self.automaton}, key=len):
            below = self.longest.get(p[:-1], "")
            if p in self.automaton:
                self.longest[p], self.shorter[p] = p, below
            else:
                self.longest[p] = below
        self.reach = max(map(len, self.longest))
        if any(self.rank.get(x, -1) > self.rank[p] for p, both in self.parts.items() for x in both):
            raise ValueError("a piece of this model is merged before its parts")
        self.breaks = "" if "\n" in self.id else "\n"
        self.chunks = re.compile(f" +[^ {self.breaks}]*|{self.breaks or '(?!)'}|[^ {self.breaks}]+")
        self.pairs: dict[tuple[str, str], bool] = {}
        self.words = Remembered(self._chunk, WORDS)
        self.space_run = lru_cache(1024)(lambda n: [self.id[p] for p in self.merged(SPACE * n)])

    def merged(self, text: str, parts: dict | None = None) -> list[str]:
        """Pieces by plain merging: the best score first, the leftmost of equal scores. ``parts``
        gets the two parts of ``text`` if that is one piece."""
        part, end, start = list(text), list(range(1, len(text) + 1)), list(range(-1, len(text) - 1))
        score = self.score
        queue = [(-score[text[i:i + 2]], i, text[i:i + 2]) for i in range(len(text) - 1) if text[i:i + 2] in score]
        heapq.heapify(queue)
        while queue:
            _, i, whole = heapq.heappop(queue)
            j = end[i]
            if not part[i] or j >= len(text) or part[i] + part[j] != whole:
                continue
            if parts is not None and whole == text:
                parts[text] = part[i], part[j]
            part[i], part[j], end[i] = whole, "", end[j]
            if end[i] < len(text):
                start[end[i]] = i
            for left, right in ((start[i], i), (i, end[i])):
                if left >= 0 and right < len(text) and (both := part[left] + part[right]) in score:
                    heapq.heappush(queue, (-score[both], left, both))
        return [p for p in part if p]

    def compatible(self, left: str, right: str) -> bool:
        """Whether merging the two pieces' joined text gives the two again. Their merges are taken
        back, the latest first; if the two at the border would then have merged before the one
        taken back, the pieces would not both have come about."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            rank, x, y, before = self.rank, left, right, len(self.rank)
            known = True
            while known:
                rx, ry = rank.get(x, -1), rank.get(y, -1)
                known = rank.get(x + y, before) >= before
                if rx < 0 and ry < 0:
                    break
                if rx > ry:
                    before, x = rx, self.parts[x][1]
                else:  # of equal merges the left one comes first
                    before, y = ry + 1, self.parts[y][0]
            self.pairs[left, right] = known
        return known

    def _known(self, text: str) -> list[str]:
        """Pieces of a text of known characters, by backtracking."""
        n, reach, prefix = len(text), self.reach, self.automaton.longest_prefix
        longest, shorter, pairs, compatible = self.longest, self.shorter, self.pairs, self.compatible
        failed, out, pos = bytearray(n + 1), [], 0
        piece = longest[text[:prefix(text[:reach])]]
        while pos < n:
            while piece and (failed[pos + len(piece)] or out and not (
                    fits if (fits := pairs.get((out[-1], piece))) is not None else compatible(out[-1], piece))):
                piece = shorter[piece]
            if piece:
                out.append(piece)
                pos += len(piece)
                if pos < n:
                    ahead = text[pos:pos + reach]
                    piece = longest[ahead[:prefix(ahead)]]
            else:
                failed[pos] = 1
                piece = out.pop()
                pos -= len(piece)
                piece = shorter[piece]
        return out

    def _word(self, text: str) -> tuple[list[int], str]:
        """(ids, decoded text) of a text with at most one space, at its start."""
        if self.id.keys() >= {*text}:
            ids = [self.id[p] for p in self._known(text)]
        else:
            ids, start = [], 0
            for i in [*(i for i, c in enumerate(text) if c not in self.id), len(text)]:
                ids += [self.id[p] for p in self._known(text[start:i])] if i > start else []
                ids += [self.byte_id[b] for b in text[i:i + 1].encode()]
                start = i + 1
        return ids, self._plain(ids)

    def _chunk(self, text: str) -> tuple[bytes, str, str]:
        """(ids as 32-bit integers, ids joined by commas, decoded text) of a run of spaces, if any, and what follows up to the next space."""
        rest = text.lstrip(" ")
        n = len(text) - len(rest)
        ids, plain = self._word(SPACE * (n > 0) + rest) if rest else ([], "")
        if rest and n and self.piece[ids[0]] == SPACE:  # the space stays with the run
            ids, plain = ids[1:], plain[1:]
        elif rest and n:
            n -= 1
        ids = self.space_run(n) + ids if n else ids
        plain = " " * n + plain
        return array("i", ids).tobytes(), ",".join(map(str, ids)), text if plain == text else plain  # a remembered text is held once

    def _plain(self, ids: list[int]) -> str:
        """The ids' pieces, spaces as spaces; runs of byte pieces are read as UTF-8."""
        if self.byte.keys().isdisjoint(ids):
            return "".join([self.piece[i] for i in ids]).replace(SPACE, " ")
        out, run = [], bytearray()
        for i in ids:
            if i in self.byte:
                run.append(self.byte[i])
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run.clear()
            out.append(self.piece[i])
        out.append(run.decode("utf-8", "replace"))
        return "".join(out).replace(SPACE, " ")

    def coded(self, text: str) -> tuple[bytes, str, str]:
        """(ids as 32-bit integers, ids joined by commas, decoded text): the model puts a space before the text and decoding takes it away."""
        if not text:
            return b"", "", ""
        ids, said, plain = zip(*map(self.words.__getitem__, self.chunks.findall(" " + text.replace(SPACE, " "))))
        return b"".join(ids), ",".join(said), "".join(plain)[1:]

    def both(self, text: str) -> tuple[list[int], str]:
        """(ids, decoded text)."""
        ids, _, plain = self.coded(text)
        return array("i", ids).tolist(), plain

    def encode(self, text: str) -> list[int]:
        return self.both(text)[0]

    def decode(self, ids: list[int]) -> str:
        text = self._plain(ids)
        return text[1:] if text[:1] == " " and ids and ids[0] not in self.byte else text


@lru_cache(2)
def codec(path: str) -> Codec:
    return Codec(path)


#: What encode_decode() can return of a text beside doc_id.
COLUMNS = {"n_tokens": "bigint", "ids": "array<int>", "decoded": "string", "ids_sha256": "string", "decoded_sha256": "string"}


def _column(name: str, parts: list[tuple[bytes, str, str]]) -> pa.Array:
    if name == "ids":
        ends = np.cumsum([0, *(len(p[0]) // 4 for p in parts)])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join([p[0] for p in parts]), np.int32)))
    if name == "n_tokens":
        return pa.array([len(p[0]) // 4 for p in parts], pa.int64())
    said = [p[2 if name.startswith("decoded") else 1] for p in parts]
    return pa.array([sha256(x.encode()).hexdigest() for x in said] if name.endswith("sha256") else said, pa.string())


def encode_decode(docs: DataFrame, path: str | None = None, columns: tuple[str, ...] = ("ids", "decoded")) -> DataFrame:
    """doc_id and these columns of COLUMNS per row of ``docs``. Digests are of the ids joined by commas and of the decoded text,
    as lowercase hexadecimal.

    Null and empty texts have no ids and decode to an empty text; a text's cost is linear in its
    length; repeated rows each give their own row; ids may be null; only doc_id and text are read; an empty table gives no rows.
    """
    path = path or model_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coded = codec(path).coded
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS_OUT):
                part = batch.slice(i, ROWS_OUT)
                done = [coded(t or "") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), *(_column(c, done) for c in columns)], names=["doc_id", *columns])

    slim = pick(docs, "doc_id", "text").select("doc_id", F.col("text").cast("string"))
    kind = dict(slim.dtypes)["doc_id"]
    return map_arrow(slim, run, ", ".join([f"doc_id {kind}", *(f"{c} {COLUMNS[c]}" for c in columns)]))


def op3_sentencepiece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(load(spark, sf_dir, "documents"), columns=("n_tokens", "ids_sha256", "decoded_sha256"))
