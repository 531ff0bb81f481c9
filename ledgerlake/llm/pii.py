"""Personal data by bootstrapped contextual extraction, in SQL expressions, joins and
groupings only.

Seeds are the base findings: e-mail addresses, IP addresses, card and phone numbers. The words
to the left of a seed are a lexical pattern. Patterns and identifier-like instances form a
graph that Spark scores in rounds: a pattern is trusted if most of the distinct instances it
introduces are accepted ones, an instance is accepted if trusted patterns introduce it. The
instances accepted at the end, wherever they stand, are reported beside the seeds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import key_columns, kinds_text, load, materialize, join_key
from .spans import JOINT, digits, found, joined, luhn, marked

KINDS = ["email", "ip", "card", "phone", "context"]
BASE = 4
LABEL = "[A-Za-z0-9-]"
LOCAL = "[A-Za-z0-9._%+" + JOINT + "-]"

# The base patterns on texts in which a dot or separator between two label characters is JOINT;
# a run is tried once, from its start or from the end of the match before.
EMAIL = rf"(?:(?<!{LOCAL})|\G){LOCAL}++@{LABEL}+{JOINT}[A-Za-z0-9{JOINT}-]+"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = rf"[0-9][0-9{JOINT}]{{11,}}"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

#: An identifier-like token of any length, after letters and hyphens of any number and up to punctuation that no label character
#: follows, and how far to its left a pattern reaches.
TOKEN = (r"(?<![A-Za-z0-9._%+@-])(?:[A-Za-z][A-Za-z-]*+)?+[0-9][A-Za-z0-9-]{3,}[A-Za-z0-9]"
         r"(?![A-Za-z0-9_%+@]|[.-]++[A-Za-z0-9_%+@])")
REACH = 48

MIN_SEEDS, MIN_CONF, ACCEPT = 3, 0.5, 0.8


def base_spans(text: Column) -> list[Column]:
    """Base findings of each kind, as found() gives them."""
    email = found(joined(text, LABEL, r"\."), EMAIL, text.contains("@"))
    ip = F.filter(found(text, IP, text.rlike(r"[0-9]\.[0-9]")), lambda x: F.forall(
        F.split(x["hit"], r"\."), lambda p: F.length(F.ltrim(p, F.lit("0"))) <= 3) & F.forall(
        F.split(x["hit"], r"\."), lambda p: F.coalesce(F.right(p, F.lit(3)).try_cast("int"), F.lit(999)) <= 255))
    card = F.filter(found(joined(text, "[0-9]", r"[\x20-]"), CARD, text.rlike(r"[0-9][0-9\x20-]{11}")), lambda x: F.length(
        digits(x["hit"])).between(12, 19) & luhn(digits(x["hit"])))
    phone = F.filter(found(text, PHONE, text.contains("+")), lambda x: F.length(digits(x["hit"])).between(9, 15))
    return [email, ip, card, phone]


def _left(text: Column, at: Column) -> Column:
    """The lexical pattern left of ``at``: the last two words, lower case, digit runs as 0; empty if
    there is no word."""
    before = F.substring(text, F.greatest(at - REACH + 1, F.lit(1)), F.least(at, F.lit(REACH)))
    words = F.regexp_extract(F.lower(before), r"((?:\S+\s+)?\S+)\s*$", 1)
    return F.regexp_replace(F.regexp_replace(words, "[0-9]+", "0"), r"\s+", " ")


def scan(docs: DataFrame, rounds: int | None = None, min_seeds: int = MIN_SEEDS, min_conf: float = MIN_CONF,
         accept: float = ACCEPT) -> DataFrame:
    """(doc_id, rid, email, ip, card, phone, context): arrays of struct(s, k, e) per row.

    Null and empty texts give empty arrays; repeated rows each give their own row and count as one
    instance; ids may be null; only doc_id and text are read.
    """
    keyed = key_columns(docs)
    base = keyed.select("doc_id", "rid", "text", *[marked(x, k).alias(KINDS[k]) for k, x in enumerate(base_spans(F.col("text")))])
    seeds = F.concat(*KINDS[:BASE])
    tokens = F.filter(found(F.col("text"), TOKEN, F.col("text").rlike("[0-9][A-Za-z0-9-]{4}")),
                      lambda x: F.length(digits(x["hit"])) >= 4)
    more = F.filter(marked(tokens, BASE), lambda x: ~F.exists(seeds, lambda y: (y["s"] < x["e"]) & (x["s"] < y["e"])))
    mentions = F.transform(F.concat(seeds, more), lambda x: F.struct(
        x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"), _left(F.col("text"), x["s"]).alias("pattern"),
        F.sha2(F.substring(F.col("text"), x["s"] + 1, x["e"] - x["s"]).cast("binary"), 256).alias("instance")))
    base = materialize(base.select("doc_id", "rid", *KINDS[:BASE], mentions.alias("mentions")), "op10")
    seen = base.select("doc_id", "rid", F.explode("mentions").alias("m")).select("doc_id", "rid", "m.*")
    graph = materialize(seen.filter("pattern != ''").groupBy("pattern", "instance")
                        .agg(F.max(F.col("k") < BASE).alias("seed")), "op10-graph")
    accepted = _bootstrap(graph, rounds, min_seeds, min_conf, accept)
    new = (seen.filter(f"k = {BASE}").join(accepted, "instance", "left_semi")
           .groupBy("doc_id", "rid").agg(F.collect_set(F.struct("s", "k", "e")).alias("context")))
    none = F.array().cast("array<struct<s:int,k:int,e:int>>")
    return (join_key(base, new)
            .select("doc_id", "rid", *KINDS[:BASE], F.coalesce("context", none).alias("context")))


def _bootstrap(graph: DataFrame, rounds: int | None, min_seeds: int, min_conf: float, accept: float) -> DataFrame:
    """Instances accepted when a round accepts no new one, or after ``rounds`` if given: the accepted ones only
    grow, so there is such a round. A pattern needs ``min_seeds`` distinct accepted
    instances and a share of ``min_conf`` of all it introduces; an instance is accepted if the chance
    that all its trusted patterns are wrong is at most 1 - ``accept``. Sums per pattern and per
    instance are combined before the shuffle, so a frequent pattern costs one row per task."""
    known = materialize(graph.filter("seed").select("instance").distinct(), "op10-known")
    size, before, n = known.count(), 0, 0
    while size > before and n != rounds:
        edges = graph.join(known.withColumn("ok", F.lit(1)), "instance", "left")
        trusted = (edges.groupBy("pattern").agg(F.count("ok").alias("pos"), F.count(F.lit(1)).alias("all"))
                   .filter((F.col("pos") >= min_seeds) & (F.col("pos") >= min_conf * F.col("all")))
                   .select("pattern", (F.col("pos") / (F.col("all") + 1)).alias("conf")))
        drawn = (graph.join(trusted, "pattern").groupBy("instance")
                 .agg((1 - F.exp(F.sum(F.log1p(-F.col("conf"))))).alias("score")).filter(F.col("score") >= accept)
                 .select("instance"))
        known = materialize(known.union(drawn).distinct(), f"op10-known{n}")
        before, size, n = size, known.count(), n + 1
    return known


def masked(text: Column, spans: Column) -> Column:
    """``text`` with each run of overlapping spans, struct(s, k, e), replaced by the kind of its first in brackets."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def step(done, x):
        apart = F.concat(done["out"], F.array(F.substring(text, done["at"] + 1, x["s"] - done["at"]), F.element_at(names, x["k"] + 1)))
        return F.struct(F.greatest(done["at"], x["e"]).alias("at"), F.when(x["s"] >= done["at"], apart).otherwise(done["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    whole = F.aggregate(F.array_sort(spans), start, step, lambda done: F.concat(
        F.array_join(done["out"], ""), F.substring(text, done["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = scan(load(spark, sf_dir, "documents"))
    base = F.concat(*KINDS[:BASE])
    return hits.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:BASE]],
        F.sha2(kinds_text(base, KINDS).cast("binary"), 256).alias("base_sha256"),
        kinds_text(F.concat(base, "context"), KINDS).alias("spans"),
        F.size("context").cast("long").alias("n_context"))
