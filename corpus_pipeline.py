"""From raw documents to tokens, in five stages, each written as Parquet and read again as the next one's input.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a frame. All but the last
return the columns of ``docs``. Columns beyond doc_id, text, lang and n_chars are carried along whatever their names. A
null or empty text has no language and goes in the first stage; repeated rows are copies of each other and one stays;
ids may be null; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import decontaminate, language_id, ngram_join, pii, sentencepiece_codec
from ledgerlake.llm.common import load, materialize, pick

#: Phrases per code point above which a text is like none of the learned languages; prose has under 0.5.
MOST_PHRASES = 0.75

#: SQL can't express these stages; tests/llm hold them against brute-force versions.
ORACLE_SQL = None


class _Slots:
    """``docs`` with its columns under place names, so that no name can clash; ``back`` gives them their own again."""

    def __init__(self, docs: DataFrame):
        self.names = docs.columns
        self.slots = [f"_slot{i}" for i in range(len(docs.columns))]
        self.df = docs.toDF(*self.slots)

    def __getitem__(self, name: str):
        return F.col(self.slots[self.names.index(name)])

    def back(self, df: DataFrame) -> DataFrame:
        return df.select(*self.slots).toDF(*self.names)


def _same_row(s: _Slots):
    """Equality of a row and a (_doc, _rid) key, see common.key_columns."""
    return s["doc_id"].eqNullSafe(F.col("_doc")) & (F.xxhash64(F.coalesce(s["text"], F.lit(""))) == F.col("_rid"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter and texts that no learned language explains."""
    s = _Slots(docs)
    models = language_id.blocks(language_id.sample(pick(docs, "doc_id", "text", "lang")))
    said = language_id.judged(spark, models)
    return s.back(s.df.withColumn("_said", said(s["text"])).filter((F.col("_said.lang_pred") != language_id.UNKNOWN)
                                                                    & (F.col("_said.rate") <= MOST_PHRASES)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of linked texts stays, the one with the smallest id; texts without words all stay."""
    found = ngram_join.near_duplicates(docs)
    rank = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "rid")
    first = found.filter("label IS NOT NULL").groupBy("label").agg(F.min(rank).alias("first"))
    keys = first.select(F.col("first.doc_id").alias("_doc"), F.col("first.rid").alias("_rid")).unionAll(
        found.filter("label IS NULL").select("doc_id", "rid").distinct())
    keys = materialize(keys, "pipeline-kept")
    s = _Slots(docs)
    kept = s.df.join(keys, _same_row(s))
    wordless = F.trim(F.regexp_replace(F.coalesce(s["text"], F.lit("")), r"\s+", " ")) == ""
    # Repeated rows share a key; one of them stays.
    alone = kept.filter(~wordless).dropDuplicates(["_doc", "_rid"])
    return s.back(alone.unionByName(kept.filter(wordless)))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that contain a benchmark item."""
    s = _Slots(docs)
    leaks = decontaminate.holds(s["text"], spark, load(spark, sf_dir, "benchmark"))
    return s.back(s.df.filter(~leaks))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind in brackets; ``n_chars`` follows."""
    found = pii.scan(docs)
    found = found.select(F.col("doc_id").alias("_doc"), F.col("rid").alias("_rid"), F.concat(*pii.KINDS).alias("_spans"))
    found = found.filter(F.size("_spans") > 0).dropDuplicates(["_doc", "_rid"])
    s = _Slots(docs)
    text = s.slots[s.names.index("text")]
    out = s.df.join(found, _same_row(s), "left").withColumn(text, F.when(F.col("_spans").isNull(), s["text"]).otherwise(
        pii.masked(s["text"], F.col("_spans"))))
    if "n_chars" in s.names:
        size = s.slots[s.names.index("n_chars")]
        out = out.withColumn(size, F.when(F.col("_spans").isNull(), F.col(size)).otherwise(F.length(text).cast(dict(s.df.dtypes)[size])))
    return s.back(out)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256, decoded_sha256): the encoded texts and a digest of what they decode to."""
    return sentencepiece_codec.encode_decode(docs, columns=("n_tokens", "ids", "ids_sha256", "decoded_sha256"))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontaminated", decontaminated), ("private", private), ("tokens", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = load(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{name}")
    return docs
