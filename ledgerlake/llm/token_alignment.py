"""Alignment of two tokenizers' ids by the byte offsets at which their tokens end.

Every offset at which a token of A ends goes with the token's index, for B likewise; the offsets in both, sorted, slice both
lists of ids into *groups*; in each slice the tokens that end at its end are *linked*. Both tokenizers
end a token before a space that follows a character other than white space, so a text's groups are those of its
pieces one after the other. The different pieces of a *chunk* of documents are encoded if the worker does not remember
them, and aligned together: their tokens' ends are one ascending row for A and one for B.

Counts of linked id pairs over the corpus say which A id a B id mostly goes with. A worker writes the links of a
chunk as places in its list of different pairs, so only that list, a count for
each, is summed over the corpus, and only its counts come back to the chunk.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .byte_bpe import ByteBpe, Remembered, binaries, byte_bpe_path, byte_level, cut, joined, split_at
from .common import load, map_arrow, materialize, pick, ship
from .sentencepiece_codec import SPACE, model_path

#: A chunk is closed before it has more bytes, of which each ends a link at most; a longer document is a chunk of its own.
CHUNK_LINKS = 1 << 20
#: Pieces and words remembered by a worker at least (twice as many at most).
REMEMBERED = 150_000


def slices(a_sizes: list[int], b_sizes: list[int]) -> list[tuple[int, int, int]]:
    """(offset, A's index after, B's index after) of each offset at which tokens of both end; sizes are in bytes."""
    a_ends, b_ends = np.cumsum(a_sizes), np.cumsum(b_sizes)
    i, j = common(a_ends, b_ends)
    return [*zip(a_ends[i].tolist(), (i + 1).tolist(), (j + 1).tolist())]


def common(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The indices of A's and of B's last token that ends at each offset where tokens of both end; ends are ascending."""
    a_last, b_last = (np.flatnonzero(np.r_[x[1:] != x[:-1], np.ones(min(1, len(x)), bool)]) for x in (a_ends, b_ends))
    a_offsets, b_offsets = a_ends[a_last], b_ends[b_last]
    at = np.searchsorted(b_offsets, a_offsets)
    both = np.r_[b_offsets, -1][at] == a_offsets
    return a_last[both], b_last[at[both]]


def ending(sizes: list[int], lo: int, hi: int) -> range:
    """The tokens of lo..hi that end where the last does: the last, and those before empty tokens."""
    i = hi - 1
    while i > lo and sizes[i] == 0:
        i -= 1
    return range(i, hi)


class Aligner:
    """A: a byte-level model of the tokenizers library, special tokens read as plain text. B: a sentencepiece model that
    puts a space before a text, none of whose pieces crosses the start of a word."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.a, self.b = ByteBpe(a_path, special=False, most=REMEMBERED), sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte, self.a_bytes = {c: b for b, c in byte_level().items()}, {}
        for token, i in self.a.library.get_vocab(with_added_tokens=True).items():
            self.a_bytes[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("a piece of this model crosses the start of a word")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        most = max(self.a_bytes) + 1
        self.a_parts, self.n_b = [self.a_bytes.get(i, b"") for i in range(most)], len(pieces)
        self.a_size, self.b_size = (np.array([*map(len, x)]) for x in (self.a_parts, self.b_bytes))
        # An id and what follows it in the groups' text: even places inside a group, odd ones at the end of its A or B ids.
        self.said = binaries([f"{i}{c}".encode() for n, last in ((most, "|"), (self.n_b, ";")) for i in range(n) for c in ("," + last)])
        self.a_parts, self.b_parts = binaries(self.a_parts), binaries(self.b_bytes)
        self.lossless = all(c in self.a.library.get_vocab() for c in byte)  # A gives back the bytes of any text
        self.some_empty = min(map(len, self.a_bytes.values())) == 0 or min(self.b_size) == 0
        self.b_space = array("I", self.b.encode("x ")[len(self.b.encode("x")):]).tobytes()
        self.known = Remembered(None, REMEMBERED)

    def encoded(self, pieces: list[str]) -> list[tuple[bytes, bytes]]:
        """A's and B's ids of a space and each of these different pieces, as unsigned integers of 32 bits."""
        known = self.known
        rows = [*map(known.get, pieces)]
        missing = [i for i, row in enumerate(rows) if row is None]
        for i in missing:
            rows[i] = known.before.get(pieces[i])
        new = [i for i in missing if rows[i] is None]
        if new:
            texts = [pieces[i] for i in new]
            words, plain, places, counts = self.a.units(pa.array([" " + t for t in texts], pa.large_string()))
            data, ends = joined(binaries(self.a.spelled(words, plain)), places, counts)
            ends = ends.tolist()
            b = self.b.encode(texts, num_threads=1)  # B's library takes many at once
            for i, text, start, end, ids in zip(new, texts, ends, ends[1:], b):
                rows[i] = bytes(data[start:end]), array("I", ids).tobytes() if text else self.b_space  # empty: behind a text's last space
        for i in missing:
            known.keep(pieces[i], rows[i])
        return rows

    def chunk(self, texts: pa.Array) -> tuple:
        """(A's ids, B's ids, groups, links of each text; the groups' texts; the places of its links; pairs, counts); a text without tokens has zeros and
        empty values. pairs: the different pairs linked, sorted, with a count for each; places: where in them each link is (bytes of 32-bit integers)."""
        full = pc.greater(pc.binary_length(texts), 0)
        some = np.flatnonzero(full.to_numpy(zero_copy_only=False))
        pieces, at, n = cut(texts.filter(full))
        rows = self.encoded(pieces)
        whole = [b" " + p.encode() for p in pieces]
        good = np.array(self._given_back(whole, [b for _, b in rows], self.b_parts), bool)
        if not self.lossless:
            good &= self._given_back(whole, [a for a, _ in rows], self.a_parts)
        if not good.all():  # texts with another piece have no tokens
            of = np.repeat(np.arange(len(n)), n)
            fine = np.bincount(of[~good[at]], minlength=len(n)) == 0
            used, at = np.unique(at[fine[of]], return_inverse=True)
            rows, some, n = [rows[i] for i in used.tolist()], some[fine], n[fine]
        # The pieces one after the other, with a byte between.
        a, b = (np.frombuffer(b"".join(x), np.uint32).astype(np.int64) for x in zip(*rows)) if rows else np.zeros((2, 0), np.int64)
        n_a, n_b = (np.array([len(x[i]) // 4 for x in rows], np.int64) for i in (0, 1))
        gap = np.arange(len(rows))
        a_ends, b_ends = np.cumsum(self.a_size[a]) + np.repeat(gap, n_a), np.cumsum(self.b_size[b]) + np.repeat(gap, n_b)
        i, j = common(a_ends, b_ends)
        n_groups = np.bincount(np.repeat(gap, n_a)[i], minlength=len(rows))
        group = np.arange(len(i))
        a_group, b_group = np.repeat(group, np.diff(np.r_[-1, i])), np.repeat(group, np.diff(np.r_[-1, j]))
        said = np.empty(len(a) + len(b), np.int64)
        a_said, b_said = 2 * a, 2 * (b + len(self.a_parts))
        a_said[i] += 1
        b_said[j] += 1
        said[np.arange(len(a)) + (np.r_[-1, j] + 1)[a_group]] = a_said
        said[np.arange(len(b)) + (i + 1)[b_group]] = b_said
        data, ends = joined(self.said, said, n_a + n_b)
        text, text_ends = joined(split_at(data, ends), at, n)
        if self.some_empty:
            a_last, b_last, n_links = self._linked(a, b, i, j, np.repeat(gap, n_a)[i], len(rows))
        else:
            a_last, b_last, n_links = i, j, n_groups
        pairs, places = np.unique(a[a_last] * self.n_b + b[b_last], return_inverse=True)
        counts = np.bincount(places, weights=np.repeat(np.bincount(at, minlength=len(rows)), n_links), minlength=len(pairs)).astype(np.int64)
        links, link_ends = joined(split_at(places.astype("<u4"), 4 * np.cumsum(np.r_[0, n_links])), at, n)
        numbers = np.zeros((4, len(texts)), np.int64)
        bounds = np.cumsum(np.r_[0, n])
        for row, x in zip(numbers, (n_a, n_b, n_groups, n_links)):
            row[some] = np.diff(np.r_[0, np.cumsum(x[at])][bounds])
        groups, found = [""] * len(texts), [b""] * len(texts)
        for k, x, y, v, w in zip(some.tolist(), text_ends.tolist(), text_ends[1:].tolist(), link_ends.tolist(), link_ends[1:].tolist()):
            groups[k], found[k] = str(text[x:y - 1], "ascii"), bytes(links[v:w])
        return *numbers, groups, found, pairs, counts

    @staticmethod
    def _given_back(whole: list[bytes], ids: list[bytes], parts: pa.Array) -> np.ndarray:
        """Whether the joined bytes of the ids are those of the piece."""
        data, ends = joined(parts, np.frombuffer(b"".join(ids), np.uint32), np.array([len(x) // 4 for x in ids], np.int64))
        if data == b"".join(whole) and ends[1:].tolist() == np.cumsum([*map(len, whole)]).tolist():
            return np.ones(len(whole), bool)
        data, ends = bytes(data), ends.tolist()
        return np.array([data[x:y] == w for x, y, w in zip(ends, ends[1:], whole)], bool)

    def _linked(self, a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, piece: np.ndarray, pieces: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """chunk()'s linked tokens of A and of B, and how many links each piece has, where some tokens have no bytes."""
        a_sizes, b_sizes, last, found = self.a_size[a].tolist(), self.b_size[b].tolist(), (-1, -1), []
        for k, m, p in zip(i.tolist(), j.tolist(), piece.tolist()):
            found += [(x, y, p) for x in ending(a_sizes, last[0] + 1, k + 1) for y in ending(b_sizes, last[1] + 1, m + 1)]
            last = k, m
        a_last, b_last, of = np.array(found, np.int64).reshape(-1, 3).T
        return a_last, b_last, np.bincount(of, minlength=pieces)

    def text(self, text: str | None) -> tuple[int, int, int, str, bytes]:
        """(A's ids, B's ids, groups, the groups' text, pairs linked) of a text; zeros if it has no tokens."""
        n_a, n_b, n_groups, _, groups, places, pairs, _ = self.chunk(pa.array([text or ""], pa.string()))
        return int(n_a[0]), int(n_b[0]), int(n_groups[0]), groups[0], pairs[np.frombuffer(places[0], "<u4")].tobytes()


@lru_cache(2)
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def aligned(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """Rows of documents (part, chunk, doc_id, n_a, n_b, n_groups, n_links, groups, places) and of chunks (part, chunk, pairs, counts).

    groups: ``a1,a2|b1;a3|b2,b3``. pairs: a * (size of B's vocabulary) + b of the chunk's different links, sorted;
    places: little-endian integers of 32 bits, the place in ``pairs`` of each of the document's links.
    Texts that are null, empty or not given back by either tokenizer's bytes have no tokens: zeros and empty values.
    Repeated rows are documents of their own; ids may be null or equal; a very long text is a chunk of its own;
    only doc_id and text are read; an empty table gives no rows.
    """
    a_path, b_path = a_path or byte_bpe_path(), b_path or model_path()
    slim = pick(docs, "doc_id", "text").select("doc_id", F.col("text").cast("string"))
    kind = dict(slim.dtypes)["doc_id"]
    schema = (f"part int, chunk int, doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, "
              "places binary, pairs array<bigint>, counts array<bigint>")
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, chunk = aligner(a_path, b_path), TaskContext.get().partitionId(), 0
        held, size = [], 0

        def record() -> pa.RecordBatch:
            keys = pa.concat_arrays([x.column(0) for x in held])
            *numbers, groups, places, pairs, counts = own.chunk(pa.concat_arrays([x.column(1) for x in held]).fill_null(""))
            n = len(keys) + 1
            columns = [pa.array([part] * n, pa.int32()), pa.array([chunk] * n, pa.int32()), pa.concat_arrays([keys, pa.nulls(1, keys.type)])]
            columns += [pa.array([*x.tolist(), None], pa.int64()) for x in numbers]
            columns += [pa.array([*groups, None], pa.string()), pa.array([*places, None], pa.binary())]
            columns += [pa.array([*[None] * len(keys), x], pa.list_(pa.int64())) for x in (pairs, counts)]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            ends = np.cumsum(pc.binary_length(batch.column(1)).fill_null(0).to_numpy(), dtype=np.int64)
            at = 0
            while at < batch.num_rows:
                before = int(ends[at - 1]) if at else 0
                to = int(np.searchsorted(ends, before + CHUNK_LINKS - size, "right"))
                if to <= at and held:  # the next text is over what is left
                    yield record()
                    held, size, chunk = [], 0, chunk + 1
                    continue
                to = max(to, at + 1)
                held.append(batch.slice(at, to - at))
                size += int(ends[to - 1]) - before
                at = to
        if held:
            yield record()

    return map_arrow(slim, run, schema)


def pair_counts(rows: DataFrame, b_size: int) -> DataFrame:
    """(pair, a_id, b_id, n, best) of every linked pair: how many links of the corpus hold it, and whether no other pair of its B id has
    more (ties are all best). The highest counts have a row per B id at most, so they may be broadcast."""
    each = rows.where("pairs is not null").select(F.explode(F.arrays_zip("pairs", "counts")).alias("x")).groupBy(F.col("x.pairs").alias("pair"))
    n = each.agg(F.sum("x.counts").alias("n")).withColumns({"a_id": F.floor(F.col("pair") / b_size).cast("int"), "b_id": (F.col("pair") % b_size).cast("int")})
    n = materialize(n, "pair_counts")
    most = n.groupBy("b_id").agg(F.max("n").alias("most"))
    return n.join(F.broadcast(most), "b_id").select("pair", "a_id", "b_id", "n", (F.col("n") == F.col("most")).alias("best"))


def scored(rows: DataFrame, b_size: int) -> DataFrame:
    """Written rows of aligned(): its documents with ``n_best`` (links whose pair is best) and ``count_sum`` (sum of the links' counts)."""
    counted = pair_counts(rows, b_size).select("pair", "n", "best")
    places = rows.where("pairs is not null").select("part", "chunk", F.posexplode("pairs").alias("place", "pair"))
    known = places.join(counted, "pair").select(F.col("part").alias("of_part"), F.col("chunk").alias("of_chunk"), "place", "n", "best")
    docs = rows.where("pairs is null").drop("pairs", "counts")
    schema = ", ".join(f"{n} {k}" for n, k in docs.dtypes if n not in ("part", "chunk", "places")) + ", n_best bigint, count_sum bigint"

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        n, best = np.zeros(right.num_rows + 1, np.int64), np.zeros(right.num_rows + 1, np.int64)
        place = right.column("place").to_numpy()
        n[place], best[place] = right.column("n").to_numpy(), right.column("best").to_numpy()
        links = [np.frombuffer(x.as_py() or b"", "<u4") for x in left.column("places")]
        out = left.drop_columns(["part", "chunk", "places"])
        out = out.append_column("n_best", pa.array([int(best[x].sum()) for x in links], pa.int64()))
        return out.append_column("count_sum", pa.array([int(n[x].sum()) for x in links], pa.int64()))

    ship(rows.sparkSession)
    return docs.groupBy("part", "chunk").cogroup(known.groupBy("of_part", "of_chunk")).applyInArrow(run, schema)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = aligned(load(spark, sf_dir, "documents"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    rows = materialize(rows.withColumn("groups", digest).withColumnRenamed("groups", "groups_sha256"), "aligned")
    b_size = aligner(byte_bpe_path(), model_path()).b.get_piece_size()
    return scored(rows, b_size).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
