"""Alignment of two tokenizers against a brute-force version on whole texts."""

from __future__ import annotations

import collections
import hashlib
import random

import numpy as np
import pyarrow as pa
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlake.llm import token_alignment
from ledgerlake.llm.byte_bpe import byte_bpe_path
from ledgerlake.llm.common import materialize
from ledgerlake.llm.sentencepiece_codec import model_path
from ledgerlake.llm.token_alignment import aligned, aligner, ending, pair_counts, scored, slices

from .cases import ROWS, frame, syllables
from .test_tokens import TEXTS

MORE = ["▁ looks like a space", "a▁b", "<s> </s> <unk> <0x41> <|endoftext|>", "ends  ", "ends ", " ", "naïve café 🙂🙂", "x" * 200, "tab\tand\nline\n\nfeeds \n"]


def _bytes():
    a = Tokenizer.from_file(byte_bpe_path())
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=model_path())
    # The byte-level table, from the library: single bytes of Latin-1 text are tokens.
    back = {}
    for n in range(256):
        text = bytes([n]) if n < 128 else bytes([0xC2 + (n >= 192), n if n < 192 else n - 64])
        encoded = "".join(a.id_to_token(i) for i in a.encode(text.decode(), add_special_tokens=False).ids)
        for c, x in zip(encoded, text):
            back[c] = x
    for n in range(16):  # lead bytes of longer characters
        text = chr([0x800, 0x1000, 0x2000, 0x3000, 0x4000, 0x5000, 0x6000, 0x7000, 0x8000, 0x9000, 0xA000, 0xB000, 0xC000, 0xE000, 0xF000, 0x10000][n]).encode()
        for c, x in zip("".join(a.id_to_token(i) for i in a.encode(text.decode(), add_special_tokens=False).ids), text):
            back[c] = x
    return a, b, back


def _brute(texts):
    a, b, back = _bytes()
    out, counts = [], collections.Counter()
    for text in texts:
        x = a.encode(" " + text, add_special_tokens=False).ids if text else []
        y = b.encode(text) if text else []
        xs = [bytes(back[c] for c in a.id_to_token(i)) for i in x]
        ys = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in y]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(xs) != whole or b"".join(ys) != whole:
            out.append((0, 0, "", []))
            continue
        x_end = [sum(map(len, xs[:i + 1])) for i in range(len(xs))]
        y_end = [sum(map(len, ys[:i + 1])) for i in range(len(ys))]
        links = [(x[i], y[j]) for i, e in enumerate(x_end) for j, f in enumerate(y_end) if e == f] if len(x) < 400 else [
            (x[x_end.index(e)], y[y_end.index(e)]) for e in sorted({*x_end} & {*y_end})]
        cuts, groups, i, j = sorted({*x_end} & {*y_end}), [], 0, 0
        for c in cuts:
            k, m = x_end.index(c) + 1, y_end.index(c) + 1
            groups.append(",".join(map(str, x[i:k])) + "|" + ",".join(map(str, y[j:m])))
            i, j = k, m
        counts.update(links)
        out.append((len(x), len(y), ";".join(groups), links))
    most = collections.Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return [(n, m, g.count(";") + 1 if g else 0, len(ls), sum(counts[x] == most[x[1]] for x in ls), sum(counts[x] for x in ls),
             hashlib.sha256(g.encode()).hexdigest() if g else "") for n, m, g, ls in out], counts


def _got(spark, rows):
    b_size = aligner(byte_bpe_path(), model_path()).b.get_piece_size()
    made = materialize(aligned(frame(spark, rows)), "test_aligned")
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    done = scored(made, b_size).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest)
    return made, b_size, sorted(tuple(-1 if v is None else v for v in r) for r in done.collect())


def test_alignment(spark, monkeypatch):
    short = [(d, t) for d, t in ROWS if len(t or "") < 20_000]
    rows = short + [(100 + i, t) for i, t in enumerate([*TEXTS, *MORE])] + [(200 + i, syllables(i % 9, 30)) for i in range(40)] + [(300, "same text here")] * 5
    want, counts = _brute([t for _, t in rows])
    made, b_size, got = _got(spark, rows)
    assert got == sorted((-1 if d is None else d, *w) for (d, _), w in zip(rows, want))
    most = collections.Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    pairs = pair_counts(made, b_size).collect()
    assert {(r["a_id"], r["b_id"]): (r["n"], r["best"]) for r in pairs} == {k: (n, n == most[k[1]]) for k, n in counts.items()}


def test_long_texts_and_no_rows(spark):
    (_, _, got), alone = _got(spark, [r for r in ROWS if len(r[1] or "") > 20_000]), aligner(byte_bpe_path(), model_path())
    for (_, text), row in zip(sorted(r for r in ROWS if len(r[1] or "") > 20_000), got):
        assert row[1:4] == alone.text(text)[:3] and row[1] == len(alone.a.ids(" " + text)) and row[2] == len(alone.b.encode(text))
    assert _got(spark, [])[2] == []


def test_texts_by_pieces():
    own = aligner(byte_bpe_path(), model_path())

    @settings(max_examples=200, deadline=None)
    @given(st.lists(st.sampled_from([" ", "  ", "\n", "a", "The", "12", "é", "🙂", ".", "▁", "語", "<s>", "<|endoftext|>", "\x1c"])).map("".join))
    def check(text):
        if text:
            a, b, groups, said, _ = own.text(text)
            (want, *_), _ = _brute([text])
            assert (a, b, groups, hashlib.sha256(said.encode()).hexdigest() if said else "") == (*want[:3], want[6])

    check()


def test_slices_with_empty_tokens():
    """Tokens without bytes end where the token before them does, and are linked with all that end there."""
    r = random.Random(8)
    for _ in range(300):
        a, b = ([r.choice([0, 1, 1, 2, 3]) for _ in range(r.randint(1, 8))] for _ in range(2))
        a_end, b_end = ([sum(x[:i + 1]) for i in range(len(x))] for x in (a, b))
        want = sorted((i, j) for i, e in enumerate(a_end) for j, f in enumerate(b_end) if e == f)
        got, i, j = [], 0, 0
        for end, k, m in slices(a, b):
            assert a_end[k - 1] == b_end[m - 1] == end
            got += [(x, y) for x in ending(a, i, k) for y in ending(b, j, m)]
            i, j = k, m
        assert sorted(got) == want


def test_a_chunk_is_aligned_at_once():
    """The different pieces of a chunk are encoded and aligned together; texts that are not given back have no tokens and count no links."""
    texts = ["the same words the same", "", "a ▁ sign with other words", "the same words", " ends  twice ", *TEXTS, *MORE]
    want, counts = _brute(texts)
    *numbers, groups, places, pairs, n = aligner(byte_bpe_path(), model_path()).chunk(pa.array(["left out", *texts], pa.string()).slice(1))
    digests = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
    assert [*zip(*(x.tolist() for x in numbers), digests)] == [(*w[:4], w[6]) for w in want]
    b_size = aligner(byte_bpe_path(), model_path()).n_b
    assert {(p // b_size, p % b_size): c for p, c in zip(pairs.tolist(), n.tolist())} == counts
    assert [int(n[np.frombuffer(x, "<u4")].sum()) for x in places] == [w[5] for w in want]


def test_chunks_are_closed(spark, monkeypatch):
    monkeypatch.setattr(token_alignment, "CHUNK_LINKS", 50)
    found = list(token_alignment.slices([1, 2, 3], [3, 3]))
    assert found == [(3, 2, 1), (6, 3, 2)]
