"""Language identification by cross-parsing: a text is parsed, once per language, into the longest
phrases that occur in that language's sample; the language that needs the fewest phrases per code
point wins.

A suffix automaton of each sample answers "does this phrase occur" one character at a time. The
automata of all languages are one transition table, and a batch of texts walks it in step:
each text segment and language is a lane of the same array operations.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold_out, load, map_arrow, pick, ship

#: Bounds of the sample the automata are built from: code points per language, taken from
#: texts in order of a hash of their id, at most SAMPLE_CHUNK from one text.
SAMPLE_CHARS, SAMPLE_CHUNK = 40_000, 400
#: Languages sampled at once, and bytes of a transition table; more languages are learned and parsed block by block.
LANGUAGES, TABLE_BYTES = 64, 256 << 20
#: Texts are parsed in segments of this many code points, so that lanes end together.
SEGMENT = 2048
_NO_CODE = 0xFFFFFFFF
LANES = 1 << 15
UNKNOWN = "und"


class SuffixAutomaton:
    """Transitions of the minimal automaton of all substrings of a text over 0..width-1.
    State 0 is the start; -1 is no transition."""

    def __init__(self, symbols: list[int]):
        self.next: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in symbols:
            new = len(self.next)
            self.next.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = new
                p = link[p]
            if p >= 0:
                q = self.next[p][c]
                if length[q] == length[p] + 1:
                    link[new] = q
                else:
                    copy = len(self.next)
                    self.next.append(dict(self.next[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and self.next[p].get(c) == q:
                        self.next[p][c] = copy
                        p = link[p]
                    link[q] = link[new] = copy
            last = new


@dataclass
class Model:
    """``table[state, symbol]`` is the next state or -1; ``roots`` the start state per language;
    ``symbols`` maps the sorted ``codes``, code points of any plane, to symbols; any other is 0."""

    names: list[str]
    roots: np.ndarray
    table: np.ndarray
    codes: np.ndarray
    symbols: np.ndarray

    def read(self, codes: np.ndarray) -> np.ndarray:
        """The symbols of code points; ``codes`` ends with one that is none, so that every search stays inside."""
        at = np.searchsorted(self.codes, codes)
        return np.where(self.codes[at] == codes, self.symbols[at], 0)


def build(samples: dict[str, str]) -> Model:
    """Model of the samples, a text per language. Upper and lower case are one."""
    names = sorted(samples)
    low = {n: samples[n].lower() for n in names}
    alphabet = {c: k + 1 for k, c in enumerate(sorted({c for n in names for c in low[n]}))}
    symbol = {ord(c): k for c, k in alphabet.items()}
    for code in range(0x110000):  # an upper-case letter reads as its lower-case one
        c = chr(code)
        if (small := c.lower()) != c:
            symbol.pop(code, None)
            if small in alphabet:
                symbol[code] = alphabet[small]
    codes = np.array([*sorted(symbol), _NO_CODE], np.uint32)
    symbols = np.array([*(symbol[c] for c in sorted(symbol)), 0], np.uint16 if len(alphabet) < 1 << 16 else np.uint32)
    roots, tables, first = [], [], 0
    for n in names:
        automaton = SuffixAutomaton([alphabet[c] for c in low[n]])
        table = np.full((len(automaton.next), len(alphabet) + 1), -1, np.int32)
        for state, to in enumerate(automaton.next):
            for c, target in to.items():
                table[state, c] = target + first
        table[:, 0] = -1
        roots.append(first)
        tables.append(table)
        first += len(table)
    return Model(names, np.array(roots, np.int32), np.concatenate(tables) if tables else np.full((1, 1), -1, np.int32), codes, symbols)


def blocks(samples: dict[str, str]) -> Iterator[Model]:
    """Models of all samples in the order of their names, each of as many languages as TABLE_BYTES allows, at least one.
    An automaton has at most two states per code point."""
    part: dict[str, str] = {}
    size, letters = 0, set()
    for name in sorted(samples):
        low = samples[name].lower()
        if part and 2 * (size + len(low)) * (len(letters | {*low}) + 1) * 4 > TABLE_BYTES:
            yield build(part)
            part, size, letters = {}, 0, set()
        part[name] = samples[name]
        size, letters = size + len(low), letters | {*low}
    yield build(part)


def phrases(model: Model, texts: list[str]) -> np.ndarray:
    """Phrases per text and language. A phrase ends where the sample has no longer match, and
    at the end of a segment; a character that the sample lacks is a phrase of its own."""
    codes = [np.frombuffer(t.encode("utf-32-le", "replace"), np.uint32) for t in texts]
    owner, segments = [], []
    for k, c in enumerate(codes):
        for i in range(0, len(c), SEGMENT):
            owner.append(k)
            segments.append(c[i:i + SEGMENT])
    out = np.zeros((len(texts), len(model.names)), np.int64)
    by_size = sorted(range(len(segments)), key=lambda s: -len(segments[s]))
    each = max(1, LANES // max(1, len(model.names)))
    for i in range(0, len(by_size), each):
        part = by_size[i:i + each]
        counts = _walk(model, [segments[s] for s in part])
        np.add.at(out, np.array([owner[s] for s in part]), counts)
    return out


def _walk(model: Model, segments: list[np.ndarray]) -> np.ndarray:
    """Phrases per segment and language; segments come longest first."""
    sizes = np.array([len(s) for s in segments])
    grid = np.zeros((sizes[0], len(segments)), model.symbols.dtype)
    for k, s in enumerate(segments):
        grid[:len(s), k] = model.read(s)
    live = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")  # segments longer than each place
    table, width = model.table.ravel(), model.table.shape[1]
    start = (model.roots[:, None] * width).astype(np.int64)
    state = np.repeat(start, len(segments), axis=1)  # as offsets into the table
    counts = np.zeros(state.shape, np.int64)
    for place in range(sizes[0]):
        n = live[place]
        symbol = grid[place, :n]
        to = table[state[:, :n] + symbol]
        ended = to < 0
        if ended.any():
            fresh = np.broadcast_to(start, (len(start), n)) + symbol
            to = np.where(ended, table[fresh], to)
            lost = to < 0
            # The phrase before ends here; a character the sample lacks is one more phrase.
            counts[:, :n] += (ended & (state[:, :n] != start)).astype(np.int64) + lost
            to = np.where(lost, model.roots[:, None], to)
        state[:, :n] = to.astype(np.int64) * width
    return (counts + (state != start)).T


def sample(docs: DataFrame, chars: int = SAMPLE_CHARS) -> dict[str, str]:
    """At most ``chars`` code points of text of every language, from the rows that may be learned from: the
    texts with the smallest hash of their id, some from each. Spark keeps the smallest per task
    and language, so nothing else moves; a pass brings the samples of LANGUAGES languages."""
    keep = -(-chars // SAMPLE_CHUNK) * 2
    rows = (docs.filter(~fold_out()).filter("lang IS NOT NULL AND text IS NOT NULL")
            .select("lang", F.xxhash64("doc_id").alias("order"), F.length("text").alias("n"),
                    F.when(F.length("text") > 2 * SAMPLE_CHUNK, F.substring("text", SAMPLE_CHUNK, SAMPLE_CHUNK))
                    .otherwise(F.substring("text", 1, SAMPLE_CHUNK)).alias("piece")))
    counts = [(r["lang"], r["n"]) for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").collect()]
    found: dict[str, str] = {}
    for i in range(0, len(counts), LANGUAGES):
        part = counts[i:i + LANGUAGES]
        share = F.coalesce(*[F.when(F.col("lang") == name, F.lit(min(1.0, 3 * keep / n))) for name, n in part], F.lit(0.0))
        few = rows.filter((F.pmod("order", F.lit(1 << 30)) / (1 << 30)) < share)
        for r in few.orderBy("order", "piece").limit(len(part) * keep * 6).collect():
            if len(found.get(r["lang"], "")) < chars:
                found[r["lang"]] = f"{found.get(r['lang'], '')}{r['piece']}\n"[:chars]
    return found


def predict(docs: DataFrame, models: Iterable[Model]) -> DataFrame:
    """(doc_id, lang_pred, score, rate) per row of ``docs``: the language with the fewest phrases (the
    first by name of equals), the relative lead over the next one, and its phrases per code point.

    ``und`` with score 0 if the text is null, empty or has no letter, or if no language was learned.
    Ids may be null; repeated rows each give their own row; only doc_id and text are read.
    """
    shared = [docs.sparkSession.sparkContext.broadcast(model) for model in models]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                yield pa.RecordBatch.from_arrays([part.column(0), *_answers(shared, part.column(1).to_pylist())],
                                                 names=["doc_id", "lang_pred", "score", "rate"])

    slim = pick(docs, "doc_id", "text")
    return map_arrow(slim, run, f"doc_id {dict(slim.dtypes)['doc_id']}, lang_pred string, score double, rate double")


def _answers(shared: list[Broadcast], texts: list[str | None]) -> list[pa.Array]:
    known = [t if t and any(map(str.isalpha, t)) else "" for t in texts]
    names, scores, rates = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts))
    languages, parsed = [], []
    for block in shared:
        languages += block.value.names
        parsed.append(phrases(block.value, known))
        if len(shared) > 1:
            block.__dict__.pop("_value", None)  # a worker holds one table at a time
    if languages:
        counts = np.concatenate(parsed, axis=1)
        order = np.sort(counts, axis=1)
        best = counts.argmin(axis=1)
        for k, t in enumerate(known):
            if t:
                names[k] = languages[best[k]]
                rates[k] = order[k, 0] / len(t)
                scores[k] = 1 - order[k, 0] / order[k, 1] if len(languages) > 1 and order[k, 1] else 1.0
    return [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rates, pa.float64())]


def identify(docs: DataFrame, chars: int = SAMPLE_CHARS) -> DataFrame:
    """predict() with models of the rows of ``docs`` that have a language and are not held out."""
    return predict(docs, blocks(sample(pick(docs, "doc_id", "text", "lang"), chars)))


def judged(spark: SparkSession, models: Iterable[Model]) -> Callable:
    """predict() as a function of a text column, a struct of lang_pred, score and rate: for stages
    that keep the other columns, without a join."""
    ship(spark)
    shared = [spark.sparkContext.broadcast(model) for model in models]

    @F.pandas_udf("lang_pred string, score double, rate double")
    def run(texts: pd.Series) -> pd.DataFrame:
        parts = [_answers(shared, texts.iloc[i:i + 1024].tolist()) for i in range(0, len(texts), 1024)]
        return pd.DataFrame({name: [x for p in parts for x in p[k].to_pylist()] for k, name in enumerate(("lang_pred", "score", "rate"))})

    return run


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return identify(docs).select("doc_id", fold_out().alias("held_out"), "lang_pred", "score", "rate")
