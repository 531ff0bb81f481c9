"""Secret scan with multipart credential linking, in SQL expressions and joins only.

Strong (base) findings stand alone: assignments to a telling name, access key ids and long
hex runs. Weak findings are shapes that are common by chance: an upper-case identifier, a
mixed token, an endpoint. A weak finding is reported only if a complementary part lies in
the same scope: an identifier beside a secret, or an endpoint beside either. The parts of all
texts are joined as intervals: equal key and scope bucket, then the distance in code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import key_columns, kinds_text, load, materialize, join_key
from .spans import found, marked

# The base patterns of the scan.
ASSIGN = r"""(?i:(?:password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?)([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"

# Weak parts. Bounded by look-arounds so that a run is read once; "=" ends a run as padding, and one may start right after it.
WEAK_ID = r"(?<![A-Za-z0-9+/_-])(?=[A-Z]*[0-9])(?=[0-9]*[A-Z])[A-Z0-9]{16,}+(?![A-Za-z0-9+/_=-])"
WEAK_SECRET = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}+={0,2}(?![A-Za-z0-9+/_=-])"
ENDPOINT = r"(?<![A-Za-z])(?:https?|s3|jdbc:[a-z]{2,12}|postgres|mysql|mongodb|redis|amqp)://[A-Za-z0-9][A-Za-z0-9.:/_-]{2,}"

KINDS = ["assign", "access", "hex", "linked_id", "linked_secret", "linked_endpoint"]
BASE = 3
SCOPE = 256


def base_spans(text: Column) -> tuple[Column, Column, Column]:
    assign = F.filter(found(text, ASSIGN, F.lower(text).rlike("passw|secret|token|api"), 1),
                      lambda x: F.length(x["sub"]) >= 8)
    return assign, found(text, ACCESS, text.contains("AKIA")), found(text, HEX, text.rlike(HEX))


def _apart(spans: Column, taken: Column) -> Column:
    """The spans that overlap none of ``taken``."""
    return F.filter(spans, lambda x: ~F.exists(taken, lambda y: (y["s"] < x["e"]) & (x["s"] < y["e"])))


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(doc_id, rid, assign, access, hex, linked): arrays of struct(s, k, e) per row of ``docs``.

    Two parts share a scope if their starts are at most ``scope`` code points apart. Null and
    empty texts give empty arrays; repeated rows each give their own row; ids may be null; only
    doc_id and text are read.
    """
    keyed = key_columns(docs)
    assign, access, hexes = base_spans(F.col("text"))
    base = keyed.select("doc_id", "rid", "text", *[marked(x, k).alias(KINDS[k]) for k, x in enumerate((assign, access, hexes))])
    # Every part of every text: strong ones as partners, weak ones as candidates.
    weak_id = found(F.col("text"), WEAK_ID, F.col("text").rlike("[A-Z0-9]{16}"))
    weak_secret = F.filter(found(F.col("text"), WEAK_SECRET, F.col("text").rlike("[A-Za-z0-9+/_-]{24}")),
                           lambda x: x["hit"].rlike("[0-9]") & x["hit"].rlike("[a-z]") & x["hit"].rlike("[A-Z]"))
    taken = F.concat("assign", "access", "hex")
    weak = [_apart(marked(weak_id, 3), taken), _apart(marked(weak_secret, 4), taken),
            _apart(marked(found(F.col("text"), ENDPOINT, F.col("text").contains("://")), 5), taken)]
    base = materialize(base.select("doc_id", "rid", "assign", "access", "hex", F.concat(*weak).alias("weak")), "op7")
    parts = (base.filter(F.size("weak") > 0)
             .select("doc_id", "rid", F.explode(F.concat("assign", "access", "hex", "weak")).alias("p"))
             .select("doc_id", "rid", "p.*").distinct()
             .withColumn("part", F.when(F.col("k").isin(1, 3), "id").when(F.col("k") == 5, "endpoint").otherwise("secret")))
    linked = _link(parts, scope)
    found_more = linked.groupBy("doc_id", "rid").agg(F.collect_list(F.struct("s", "k", "e")).alias("linked"))
    none = F.array().cast("array<struct<s:int,k:int,e:int>>")
    return (join_key(base, found_more)
            .select("doc_id", "rid", "assign", "access", "hex", F.coalesce("linked", none).alias("linked")))


def _link(parts: DataFrame, scope: int) -> DataFrame:
    """Weak parts with a complementary part in their scope. A semi-join on (key, bucket): a
    part answers in its own bucket and the two beside it, so no pair of a scope is missed
    and no pair is written out. A bucket holds at most scope / 16 parts of a text."""
    weak = parts.filter("k >= 3").withColumn("bucket", F.floor(F.col("s") / scope)).alias("w")
    near = (parts.select("doc_id", "rid", F.col("s").alias("at"), F.col("part").alias("other"),
                         F.explode(F.array(*[F.floor(F.col("s") / scope) + d for d in (-1, 0, 1)])).alias("bucket"))
            .alias("n"))
    together = (F.col("w.doc_id").eqNullSafe(F.col("n.doc_id")) & (F.col("w.rid") == F.col("n.rid"))
                & (F.col("w.bucket") == F.col("n.bucket")) & (F.abs(F.col("w.s") - F.col("n.at")) <= scope)
                & (F.col("w.part") != F.col("n.other"))
                & ((F.col("w.part") == "endpoint") | (F.col("n.other") != "endpoint") | (F.col("w.part") == "secret")))
    return weak.join(near, together, "left_semi").select("doc_id", "rid", "s", "k", "e")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = scan(load(spark, sf_dir, "documents"))
    base = F.concat("assign", "access", "hex")
    return hits.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:BASE]],
        F.sha2(kinds_text(base, KINDS).cast("binary"), 256).alias("base_sha256"),
        kinds_text(F.concat(base, "linked"), KINDS).alias("spans"),
        F.size("linked").cast("long").alias("n_linked"))
