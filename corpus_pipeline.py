"""From raw documents to shards: quality rules, near-duplicates, decontamination, mixing, sharding.

Every stage takes and returns documents; columns it does not know travel along in a struct, so their
names cannot clash with those of the operators.
"""

from __future__ import annotations

from collections.abc import Callable

import winnowmill
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winnowmill.llm.common import col, likely_in, stored, without
from winnowmill.llm.decontaminate import decontaminate
from winnowmill.llm.mixing import mix_documents
from winnowmill.llm.near import near_duplicates, set_digests
from winnowmill.llm.quality import quality_cascade
from winnowmill.llm.sharding import shard

# Functions travel to the executors by value, so the package need not be installed there.
cloudpickle.register_pickle_by_value(winnowmill)

#: Random permutations and counts decide what is mixed and where it goes: not for SQL.
ORACLE_SQL = None


def _packed(docs: DataFrame, *beside: str) -> DataFrame:
    return docs.select(F.struct(*[col(c) for c in docs.columns]).alias("row"), *[col(c) for c in beside])


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that pass all quality rules. A null text has no words and fails."""
    return quality_cascade(_packed(docs, "text"), "text").where("kept").select("row.*")


def near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity 0.8 or more.

    Null and empty texts, and texts of white space, are like nothing and stay, as do rows without id, which the
    decisions cannot name. Rows that repeat an id are told apart by their texts: unlike ones all stay, of
    alike ones one does. Texts are compared whole, of any length.
    """
    found = stored(near_duplicates(docs, "doc_id", "text", words=5, percent=80, detail=True), "pipeline-near")
    named = found.where(F.col("doc_id").isNotNull())
    copies = stored(named.where(~F.col("kept")).select("doc_id").distinct(), "pipeline-copies")
    repeated = named.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    repeated = stored(repeated, "pipeline-repeated")
    once = without(without(docs, "doc_id", repeated), "doc_id", copies)
    # Rows of repeated ids are decided by id and set.
    wanted = repeated.toDF("wanted")
    again = likely_in(docs, col("doc_id"), repeated)
    again = _packed(again, "doc_id", "text").join(wanted, F.col("doc_id") == F.col("wanted"), "left_semi")
    again = set_digests(again, "text", words=5)
    verdicts = named.where("digest IS NOT NULL").groupBy("doc_id", "digest").agg(
        F.first("component").alias("component"), F.first("kept").alias("kept")
    )
    verdicts = verdicts.select(F.col("doc_id").alias("of_id"), F.col("digest").alias("of_digest"), "component", "kept")
    same = (F.col("doc_id") == F.col("of_id")) & (F.col("digest") == F.col("of_digest"))
    again = again.join(verdicts, same, "left").where(F.coalesce("kept", F.lit(True)))
    empty = again.where("digest IS NULL").select("row.*")
    one = again.where("digest IS NOT NULL").dropDuplicates(["doc_id", "component"]).select("row.*")
    return once.unionByName(empty).unionByName(one)


def decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs.

    Null and empty texts have no words and stay; rows that repeat stay all or go all. Texts are read whole.
    """
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    return decontaminate(_packed(docs, "text"), items, keep=["row"]).where("n_hit = 0").select("row.*")


def mixing(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The mix as documents: a row per document and epoch in which it is taken, with the text taken then.

    ``n_chars`` is that of the new text. Documents without words are in no block and go.
    """
    others = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*[col(c) for c in others]).alias("row"), "text", "source")
    taken = mix_documents(rows, "source", "text", keep=["row"])
    out = {c: F.col("row").getField(c) for c in others} | {"text": F.col("text")}
    if "n_chars" in out:
        out["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return taken.select(*[out[c].alias(c) for c in docs.columns])


def sharding(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents with ``shard`` and ``slot``, repeated rows each with its own slot; null and empty texts too.

    A column ``shard`` or ``slot`` of the documents is replaced.
    """
    return shard(docs, "doc_id", "text", shards=8)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("near duplicates", near_copies),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents; each result is written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{number}")
    return docs
