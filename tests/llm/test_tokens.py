"""Token files, against the public libraries and brute force."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerlake.llm import mixing_coder, token_files
from ledgerlake.llm.byte_bpe import ByteBpe, byte_bpe_path
from ledgerlake.session import scratch_path

from .cases import LONG, ROWS, frame, syllables

TEXTS = ["", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "a\n b\t c", "x\x1c y\x85 z", "a<|endoftext|> b", " <|endoftext|>  <|endoftext|>c d", "l'été  d'un 12 34!? ",
         "é🙂 ñ\x00 \x01", "　 a　b c", "“x” y", "日本 語 ", LONG[:999], "a" * 300]


def _library(special: bool):
    library = Tokenizer.from_file(byte_bpe_path())
    library.encode_special_tokens = not special
    return lambda text: library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("special", [True, False])
def test_byte_bpe_by_words(special):
    library, own = _library(special), ByteBpe(byte_bpe_path(), special)

    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.sampled_from([" ", "  ", "\n", "\t", "\x1c", "\x85", " ", "a", "The", "12", "'ll", "é", "🙂", ".", "_", "<|endoftext|>", "語"])).map("".join))
    def check(text):
        assert own.ids(text).tolist() == library(text)

    check()
    for text in TEXTS:
        assert own.ids(text).tolist() == library(text)


@pytest.mark.parametrize("ids, width", [
    (np.zeros((3, 50)), 1), (np.arange(1024)[None, :], 10), (np.full((2, 1024), 65535), 16), (np.zeros((1, 1)), 1), (np.zeros((0, 5)), 3), (np.zeros((4, 0)), 3),
    (np.random.default_rng(1).integers(0, 65536, (5, 700)), 16), (np.random.default_rng(2).zipf(1.3, (40, 1024)) % 50_000, 16),
    (np.tile(np.random.default_rng(3).integers(0, 50_000, 90), 20)[None, :], 16)])
def test_coder_round_trip(ids, width):
    ids = ids.astype(np.int64)
    payloads = mixing_coder.encode(ids, width)
    assert (mixing_coder.decode(payloads, ids.shape[1], width) == ids).all()
    # Blocks are independent: each alone gives the same payload, and decodes alone.
    for row, payload in list(zip(ids, payloads))[:3]:
        assert mixing_coder.encode(row[None, :], width) == [payload]
        assert (mixing_coder.decode([payload], ids.shape[1], width) == row).all()


def test_coder_of_wide_numbers():
    """Numbers of words have over 16 bits; one block may repeat what another has, and a number may be the highest."""
    r = np.random.default_rng(9)
    ids = np.concatenate([r.integers(0, 1 << mixing_coder.WIDEST, (3, 1024)), r.zipf(1.2, (3, 1024)) % (1 << 20), np.full((1, 1024), (1 << mixing_coder.WIDEST) - 1)])
    assert mixing_coder.WIDEST >= 22
    assert (mixing_coder.decode(mixing_coder.encode(ids, mixing_coder.WIDEST), 1024, mixing_coder.WIDEST) == ids).all()


def test_units_are_what_encode_joins():
    own = ByteBpe(byte_bpe_path(), True)
    texts = st.lists(st.sampled_from([" ", "  ", "\n", "\t", "\x1c", "a", "The", "12", "'ll", "'s", "'", "'re", "'r", "d", "é", "×", "ß", "🙂", ".", "_", "<|endoftext|>", "語"])).map("".join)

    @settings(max_examples=300, deadline=None)
    @given(st.lists(texts, max_size=5))
    def check(texts):
        found, words, places, counts = own.units(pa.array(["left out", *texts], pa.string()).slice(1))
        ids = own.spelled(found, words)
        assert len({*found}) == len(found) and len(counts) == len(texts)
        for text, x in zip(texts, np.split(places, np.cumsum(counts))):
            assert b"".join(ids[i] for i in x) == own.encode(text) and b"".join(found[i] for i in x) == text.encode()

    check()
    check.hypothesis.inner_test(TEXTS)


def test_a_word_is_coded_once():
    """A segment holds the ids of each of its words once, and a number for each place, not the ids of each place."""
    now = token_files._Segment(ByteBpe(byte_bpe_path(), True))
    texts = [" unforeseeable circumstances" * 50, "", " circumstances", "“odd” circumstances", None]
    now.add([str(i) for i in range(5)], pa.array(texts, pa.string()).fill_null(""))
    data, total = now.packed(1, 2, 3)
    library = _library(True)
    want = [[*library(t or ""), token_files.END] for t in texts]
    part, segment, before, keys, ids = token_files.unpack(data)
    assert (part, segment, before, keys) == (1, 2, 3, ["0", "1", "2", "3", "4"]) and [x.tolist() for x in ids] == want and total == sum(map(len, want))
    coded = token_files.HEAD.unpack_from(data)[6]
    assert coded < total and coded == sum(len(x) // 4 for x in now.words) + sum(map(len, now.numbers))


def test_coder_adapts():
    r = np.random.default_rng(4)
    repeated = np.tile(r.integers(0, 50_000, 64), 16)[None, :]
    skewed, even = r.zipf(1.5, (1, 1024)) % 50_000, r.integers(0, 50_000, (1, 1024))
    sizes = [len(mixing_coder.encode(x, 16)[0]) * 8 / 1024 for x in (repeated, skewed, even)]
    assert sizes[0] < 4 and sizes[1] < 9 and sizes[2] < 19  # bits of an id: followers are learned, frequencies are, noise costs little more than itself


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 40), max_size=30), max_size=8), st.integers(1, 9))
def test_segments(docs, block):
    before, token_files.BLOCK = token_files.BLOCK, block
    try:
        ids = [np.array(d, "<u4") for d in docs]
        keys = [None if i % 3 == 2 else f'k"{i}\n' for i in range(len(docs))]
        data = token_files.pack(7, 3, 11, keys, ids)
        part, segment, start, got_keys, got = token_files.unpack(data)
        assert (part, segment, start, got_keys) == (7, 3, 11, keys) and [x.tolist() for x in got] == docs
    finally:
        token_files.BLOCK = before


def test_damage_is_found():
    data = token_files.pack(0, 0, 0, ["1"], [np.random.default_rng(5).integers(0, 50_000, 5000)])
    for at in (3, token_files.HEAD.size + 5, len(data) - 700, len(data) - 5000):
        with pytest.raises(token_files.DamagedSegment):
            token_files.unpack(data[:at] + bytes([data[at] ^ 64]) + data[at + 1:])
    with pytest.raises(token_files.DamagedSegment):
        token_files.unpack(data[:20])


def _files(spark, rows):
    path = scratch_path(spark, "test_tokens")
    docs = frame(spark, rows)
    token_files.write_token_files(docs, path)
    return token_files.token_starts(token_files.read_token_files(spark, path))


def test_token_files(spark):
    r = random.Random(6)
    rows = ROWS + [(r.randrange(50), syllables(i, r.randrange(200))) for i in range(60)] + [(70 + i, t) for i, t in enumerate(TEXTS)] + [(200, "same text")] * 30
    library = _library(True)
    got = sorted(_files(spark, rows).collect(), key=lambda x: x["start"])
    assert [x["doc_id"] for x in got] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d))  # nulls first, ascending
    want: dict = {}
    for d, t in rows:
        want.setdefault(d, []).append([*library(t or ""), 0])
    at = 0
    for x in got:
        assert x["start"] == at and x["n_tokens"] == len(x["ids"]) and x["ids"] in want[x["doc_id"]]
        want[x["doc_id"]].remove(x["ids"])
        assert x["ids_crc32"] == zlib.crc32(np.array(x["ids"], "<u4").tobytes())
        at += x["n_tokens"]
    assert not any(want.values())


def test_token_files_of_no_rows(spark):
    assert _files(spark, []).count() == 0
