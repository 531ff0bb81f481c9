"""Operators that compare texts with each other or with a benchmark, and the pipeline, against brute force."""

from __future__ import annotations

import collections
import hashlib
import random

import numpy as np
import pytest

import corpus_pipeline
from ledgerlake.llm import decontaminate, html_extract, ngram_join, suffix_dedup
from ledgerlake.llm.common import materialize
from ledgerlake.llm.components import components

from .cases import ROWS, frame, syllables


def _passages():
    r = random.Random(3)
    p = "".join(r.choice("abcdefgh ") for _ in range(1200))
    near = [syllables(9, 120).split() for _ in range(12)]
    for k, words in enumerate(near):
        for _ in range(k):
            words[r.randrange(len(words))] = f"w{k}"
    return ["b" * 199, "c" * 200, "c" * 200, "ab" * 400, p[:600], "x" + p[100:320] + "y", p[400:800] + p[410:615], "é" * 150 + p[:250],
            "zz" + p[900:1099], p[899:1105], p[700:1000], *(" ".join(w) for w in near)]


def _brute_spans(texts):
    size = suffix_dedup.LENGTH
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(d[i:i + size] for d in data for i in range(len(d) - size + 1))
    out = []
    for d in data:
        covered = np.zeros(len(d) + 1, int)
        for i in range(len(d) - size + 1):
            if seen[d[i:i + size]] > 1:
                covered[i] += 1
                covered[i + size] -= 1
        covered = np.cumsum(covered)[:-1] > 0
        runs = np.diff(np.concatenate([[0], covered.astype(int), [0]]))
        rest = bytes(x for x, c in zip(d, covered) if not c)
        out.append((len(d), [(int(s), int(e)) for s, e in zip(np.flatnonzero(runs == 1), np.flatnonzero(runs == -1))], hashlib.sha256(rest).hexdigest()))
    return out


def test_repeated_bytes(spark):
    rows = [(d, t) for d, t in ROWS if len(t or "") < 70_000] + [(100 + i, t) for i, t in enumerate(_passages())]
    got = [(r["doc_id"] or -1, r["n_bytes"], [(x["start"], x["end"]) for x in r["spans"]], r["kept_sha256"])
           for r in suffix_dedup.repeated_spans(frame(spark, rows)).collect()]
    assert sorted(got) == sorted((d or -1, *x) for (d, _), x in zip(rows, _brute_spans([t for _, t in rows])))
    assert suffix_dedup.repeated_spans(frame(spark, [])).count() == 0


def test_triggers_of_pieces(monkeypatch):
    data = np.frombuffer("".join(_passages()).encode(), np.uint8)
    whole = suffix_dedup.triggers(data)
    monkeypatch.setattr(suffix_dedup, "PIECE", 500)
    assert all((a == b).all() for a, b in zip(whole, suffix_dedup.triggers(data)))
    # Every string of LENGTH bytes starts in the range of one trigger, which lies inside it.
    at, first, last = whole[:3]
    assert first[0] == 0 and last[-1] == len(data) - suffix_dedup.LENGTH and (first[1:] == last[:-1] + 1).all()
    assert (at >= last).all() and (at + suffix_dedup.WINDOW <= first + suffix_dedup.LENGTH).all()


@pytest.mark.parametrize("block", [ngram_join.BLOCK_NODES, 2])
def test_join(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK_NODES", block)
    rows = ROWS + [(100 + i, t) for i, t in enumerate(_passages())] + [(200, "a b"), (201, "A  b"), (202, "b a")]
    got = {(r["doc_id"] or -1, r["class_id"], r["n_links"], r["n_copies"]) for r in ngram_join.near_duplicates(frame(spark, rows)).collect()}
    shingles = ngram_join.Shingles()
    sets = collections.defaultdict(list)
    for d, t in rows:
        sets[frozenset(shingles(t or "").tolist())].append(d)
    alone = sets.pop(frozenset())
    keys, root = list(sets), list(range(len(sets)))

    def top(i):
        return i if root[i] == i else top(root[i])

    degree = collections.Counter()
    for i, a in enumerate(keys):
        for j in range(i):
            if 5 * len(a & keys[j]) >= 4 * len(a | keys[j]):
                degree[i] += 1
                degree[j] += 1
                root[top(i)] = top(j)
    members = collections.defaultdict(list)
    for i, a in enumerate(keys):
        members[top(i)] += [d for d in sets[a] if d is not None]
    want = {(d or -1, min(members[top(i)]), degree[i], len(sets[a])) for i, a in enumerate(keys) for d in sets[a]}
    assert got == want | {(d or -1, d, 0, 1) for d in alone}
    assert ngram_join.near_duplicates(frame(spark, [])).count() == 0


def test_join_of_few_long_texts(spark, monkeypatch):
    base = syllables(3, 400)
    rows = [(i, f"{base} end{i}") for i in range(12)]
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", 200)  # more blocks than texts, so some are empty
    got = ngram_join.near_duplicates(frame(spark, rows)).collect()
    assert sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in got) == [(i, 0, 11) for i in range(12)]


def test_counts_of_shared_shingles():
    r = np.random.default_rng(5)
    sets = [np.unique(r.integers(0, 60, 40).astype(np.uint64)) for _ in range(30)]
    a, b = np.triu_indices(30, 1)
    assert ngram_join.shared_counts(sets, a, b).tolist() == [len({*sets[i]} & {*sets[j]}) for i, j in zip(a, b)]
    assert ngram_join.shared_counts(sets, a[:3], b[:3]).tolist() == [len({*sets[i]} & {*sets[j]}) for i, j in zip(a[:3], b[:3])]


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (102, 101), (200, 200)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


def _edited(text, edits, seed):
    r, out = random.Random(seed), list(text)
    for _ in range(edits):
        k = r.randrange(len(out))
        what = r.random()
        if what < 0.4:
            out[k] = r.choice("abcdefg ")
        elif what < 0.7:
            del out[k]
        else:
            out.insert(k, r.choice("abcdefg "))
    return "".join(out)


def _distance(probe, text):
    """Fewest edits between the probe and any part of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(probe):
        new = [i + 1]
        for j, e in enumerate(text):
            new.append(min(row[j] + (c != e), row[j + 1] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_benchmark_regions_against_full_alignment():
    for seed in range(40):
        probe = syllables(seed, 30)[:decontaminate.PROBE]
        text = syllables(500 + seed, 20) + _edited(probe, seed % 22, seed) + syllables(900 + seed, 10)
        index = decontaminate.Index([(1, probe)])
        best = _distance(probe, text)
        hits = index.find(text)
        assert bool(hits) == (best <= index.edits[0])
        assert not hits or hits[0][3] == best


def test_copied_parts_and_case():
    item = syllables(8, 60)[:240]
    index = decontaminate.Index([(1, item)])
    for at in range(0, 145, 7):
        assert index.find(f"{syllables(70, 20)} {item[at:at + 95]} {syllables(71, 20)}")
    assert not index.find(f"{syllables(70, 20)} {item[50:90]} {syllables(71, 20)}")
    assert index.find("\u0130 " + item.upper())


def test_contaminated(spark):
    items = [(1, syllables(1, 40)), (2, syllables(2, 12)), (3, syllables(2, 12)), (4, "tiny"), (5, None), (None, syllables(6, 30)), (7, "")]
    bench = frame(spark, items)
    bench = bench.toDF("item_id", *bench.columns[1:])
    rows = ROWS + [(100, syllables(50, 30) + " " + items[0][1].replace(" ", "\n") + " end"), (101, items[1][1].upper()),
                   (102, _edited(items[0][1], 6, 1)), (103, " ".join(items[0][1].split()[:6])), (104, syllables(77, 400)), (105, items[5][1])]
    for block_bytes in (decontaminate.BLOCK_BYTES, 200):
        got = decontaminate.contaminated(frame(spark, rows), bench, block_bytes=block_bytes).collect()
        assert sorted((r["doc_id"], r["item_id"] or -1) for r in got) == [(100, 1), (101, 2), (101, 3), (102, 1), (105, -1)]
        assert {r["edits"] for r in got if r["doc_id"] in (100, 101, 105)} == {0}
    assert decontaminate.contaminated(frame(spark, []), bench).count() == 0
    assert decontaminate.contaminated(frame(spark, rows), bench.limit(0)).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body><header>H</header>
<nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">ok?</div><div class=ad>buy</div>{}<footer>F &copy;</footer>"""


def test_html_blocks():
    def texts(page):
        return [t for t, _ in html_extract.blocks(page)]

    article = '<article><h1>A &amp; B</h1><p>one<br>two <b>x</b>y<p>three<script>no</script> four<!-- c --><ul><li>a<li>b</ul><div id="comments"><p>no</p></div>' \
              '<form><p>no</p></form><aside>no</aside><p>5 &lt; 6&nbsp;&#8364; &am</article>'
    assert texts(PAGE.format(article)) == ["A & B", "one two xy", "three four", "a", "b", "5 < 6 € &am"]
    assert texts(PAGE.format("<main><p>m</main>")) == ["m"]
    assert texts(PAGE.format("<div><p>body text</div>")) == ["body text"]
    assert texts(PAGE.format('<article><p>a</article><article class="comment"><p>no</article>')) == ["a"]
    for odd in ("", "<", "<p", "</p></p>", "<!--", "<a href='", "plain", "<script>", "<p hidden>x", "&#xFFFFFFFF;"):
        texts(odd)
    assert len(texts("<div>" * 3000 + "x" + "<p>y" * 3000)) == 3001


def test_site_templates(spark):
    pages = [(i, f"http://user@a.org:80/{i}", f"<body><div class=x><a>home</a> hot</div><div><p>number {i}</p><div><span>Follow us</span></div></div>") for i in range(30)]
    pages += [(100 + i, "http://b.org/", "<article><p>the same copied article</p></article>") for i in range(30)]  # copies are no template
    pages += [(200 + i, "http://c.org/", f"<body><p>Follow us</p><p>number {i}</p>") for i in range(5)]  # too few pages
    pages += [(300, None, None), (301, "", ""), (None, "x", "<p>y"), (302, "http://a.org/1", None)]
    rows = spark.createDataFrame([(*p, "q", "q") for p in pages], "a long, b string, c string, d string, e string").toDF("page_id", "url", "html", "host", "HTML")
    got = {r["page_id"]: r["text"] for r in html_extract.extract(rows).collect()}
    assert [got[i] for i in range(30)] == [f"number {i}" for i in range(30)]
    assert got[100] == got[129] == "the same copied article"
    assert got[200] == "Follow us\n\nnumber 0"
    assert got[300] == got[301] == got[302] == "" and got[None] == "y"
    assert html_extract.extract(rows.limit(0)).count() == 0


def test_pipeline_stages(spark, tmp_path):
    bench = [(1, syllables(1, 40))]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    clean = [(1000 + i, syllables(100 + i, 80)) for i in range(30)]
    rows = ROWS + clean + [(50, clean[0][1]), (51, clean[1][1] + " plus"), (52, syllables(300, 60) + " " + bench[0][1]),
                           (53, syllables(301, 30) + " mail a@b.co now")]
    docs = frame(spark, rows, case=False)
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
            docs = materialize(out, f"test-{name}")
        seen[name] = {r["doc_id"]: r for r in out.collect()}
    gone = {3, 4, 9, 10}  # no text, no letter
    assert not gone & {*seen["language"]} and {d for d, _ in clean} <= {*seen["language"]}
    kept = {*seen["near_duplicates"]}
    assert 50 in kept and 51 in kept and 1000 not in kept and 1001 not in kept and {d for d, _ in clean[2:]} <= kept
    assert 1 in kept and 2 not in kept and 11 not in kept
    assert {*seen["decontaminated"]} == kept - {52}
    assert seen["private"][53]["text"].endswith(" mail [EMAIL] now") and seen["private"][53]["n_chars"] == len(seen["private"][53]["text"])
    assert {d for d, r in seen["private"].items() if r["text"] != dict(rows)[d]} == {53}
    assert seen["tokens"].keys() == seen["private"].keys() and all(r["n_tokens"] == len(r["ids"]) for r in seen["tokens"].values())


def test_pipeline_of_no_rows(spark, tmp_path):
    frame(spark, [], case=False).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
