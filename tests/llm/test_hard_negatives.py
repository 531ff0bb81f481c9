"""Hard negatives against brute force and the SQL oracle."""

from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest

from ledgerlake.llm import hard_negatives as H

SCHEMA = "vec_id long, label int, embedding array<float>, point string, leaf string, v string"


def _frame(spark, rows):
    return spark.createDataFrame([(i, c, v, "p", "l", "v") for i, c, v in rows], SCHEMA)


def _brute(rows):
    """Over different (id, label, whole-number vector); shorter vectors end in zeros."""
    kept = set()
    for i, label, v in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        moved = (label + 1) % H.LABELS if i is not None and i % H.RELABEL == 0 else label
        kept.add((i, moved, tuple(math.floor(H.SCALE * float(np.float32(x))) for x in v)))
    kept, out = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1:])), []
    for a in kept:
        if a[0] is None or a[0] % H.ANCHOR:
            continue
        scored = sorted(((sum(x * y for x, y in zip(a[2], b[2])), b) for b in kept if b is not a), key=lambda s: (-s[0], s[1][0] is None, s[1][0] or 0))
        for score, p in [s for s in scored if s[1][1] == a[1]][:H.POSITIVES]:
            window = [s for s in scored if s[1][1] != a[1] and H.LOW * score <= 100 * s[0] <= H.HIGH * score][:H.NEGATIVES]
            out += [(a[0], p[0], k, n[0], score, s) for k, (s, n) in enumerate(window, 1)]
    return out


def _sorted(rows):
    return sorted((tuple(-1 if x is None else x for x in r) for r in rows))


def _random(seed, n, dim, labels=3, spread=0.3):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(6, dim))
    x = centres[r.integers(0, 6, n)] + spread * r.normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return [(i, int(r.integers(0, labels)), [float(c) for c in v]) for i, v in enumerate(x)]


@pytest.mark.parametrize("leaf, block, lots", [(2048, 4096, 2048), (40, 16, 2)])
def test_against_brute_force(spark, monkeypatch, leaf, block, lots):
    monkeypatch.setattr(H, "LEAF_ROWS", leaf)
    monkeypatch.setattr(H, "BLOCK_ROWS", block)
    monkeypatch.setattr(H, "BLOCK_SEARCHES", lots)
    rows = _random(1, 700, 4)
    rows += [(i, None, [0.1] * 4) for i in (1000, 1001)] + [(1050, 1, None), (1051, 2, [0.1, None, 0.2, 0.3]), (1052, 0, [float("nan")] * 4), (1053, 0, [0.1, float("inf"), 0.0, 0.0])]
    rows += [(None, 1, rows[50][2]), (None, 2, rows[51][2]), (1100, 1, [0.5, 0.5]), (1150, 1, []), (1200, 2, [0.0] * 4)]
    rows += [(2000 + i, i % 2, rows[100][2]) for i in range(150)]  # one vector of many rows, anchors among them
    rows += [rows[0]] * 3 + [(50, 2, rows[7][2])]  # repeated rows, and another row with an anchor's id
    got = [tuple(r) for r in H.hard_negatives(_frame(spark, rows)).collect()]
    assert _sorted(got) == _sorted(_brute(rows)) and len(got) > 100


def test_no_rows(spark):
    assert H.hard_negatives(_frame(spark, [])).collect() == []
    assert H.hard_negatives(_frame(spark, [(50, None, [1.0]), (100, 1, None)])).collect() == []
    assert H.hard_negatives(_frame(spark, [(50, 1, [1.0])])).collect() == []


def test_oracle(spark):
    rows = _random(2, 400, 8, labels=10)
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, label INTEGER, embedding FLOAT[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?, ?)", rows + [(1000, None, [0.5] * 8), (1001, 3, None)])
    assert _sorted(con.execute(H.ORACLE).fetchall()) == _sorted(_brute(rows))


def test_tree_eliminates_only_what_cannot_match(monkeypatch):
    monkeypatch.setattr(H, "LEAF_ROWS", 30)
    x = np.floor(256 * np.array([v for _, _, v in _random(3, 2000, 5, spread=0.05)]))
    tree = H.Tree(x[::3], len(x))
    leaf, found = tree.route(x)
    best = {}
    for n, i, j, lo, hi in found:
        a, b = best.get((n, i, j), (np.inf, -np.inf))
        best[n, i, j] = min(a, lo), max(b, hi)
    tree.learn([(*k, *v) for k, v in best.items()])
    anchors, score = x[::50], x[::50] @ x.T
    top = np.sort(score, axis=1)[:, -10]
    windows = [(top, np.full(len(top), np.inf)), (0.5 * top, 0.52 * top)]
    for least, most in windows:
        reached = {(i, n) for at, n in tree.reached(anchors, least[:, None], most[:, None]) for i in at}
        inside = (score >= least[:, None]) & (score <= most[:, None])
        assert {(i, leaf[j]) for i, j in zip(*np.nonzero(inside))} <= reached
        if most[0] == np.inf:
            assert tree.leaves > 40 and len(reached) < 0.5 * len(anchors) * tree.leaves
