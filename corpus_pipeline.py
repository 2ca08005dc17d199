"""From raw documents to packed training sequences, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage
before it kept. All but the last return the columns of ``documents``.

  quality        drops documents that the quality classifier rejects
  near_copies    keeps one document, the one with the least id, of each group
                 of documents with similar shingles
  decontaminate  drops documents that hold benchmark windows (contract rule:
                 a hit, and hit words at least a twentieth of the words)
  pii            replaces personal data by pseudonyms; ``n_chars`` follows
  packing        cuts and packs the token ids of what is left

Defined results, for every stage: further columns are not read and cannot clash;
an empty table gives an empty one; texts are read whole, however long; rows of
one id are separate documents, and so are repeated rows (``near_copies`` keeps
one of those that have words). A NULL text counts as empty: quality scores it
as such, the next three stages keep it as it is, packing gives it a separator.
A NULL id changes nothing. Equal ids or scores need no order.

Memory: a Python worker gets ``BATCH_ROWS`` whole texts at a time, where Spark's
own setting is 10,000. Both sides hold a batch several times over and keep most
of that memory from stage to stage. Each stage lowers the session's setting, as
what it returns runs later; a lower one stays.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkcivic.llm import decontaminate as dec
from sparkcivic.llm import jaccard, packing, pii, q_packing, q_pii, q_quality
from sparkcivic.llm.common import maybe_broadcast, table
from sparkcivic.session import bound_arrow_batches, materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
BROADCAST_ROWS = 200_000
BATCH_ROWS = 500


def stage(f):
    @functools.wraps(f)
    def bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bound_arrow_batches(spark, BATCH_ROWS)
        return f(spark, docs, sf_dir)
    return bounded


@stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return q_quality.scored(spark, docs, sf_dir, COLUMNS).where("_score >= 0.5").select(*COLUMNS)


@stage
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows are compared one by one, whatever their ids. A row goes only if its
    own text is in a group of similar texts and another row of the group stays:
    the one with the least id, NULL ids last."""
    docs = materialize(docs.select(*COLUMNS).withColumn("_row", F.monotonically_increasing_id()), "rows")
    groups = jaccard.jaccard_components(docs, doc="_row").select(F.col("id").alias("_row"), F.col("component").alias("_group"))
    groups = materialize(groups.join(docs.select("_row", "doc_id"), "_row"), "groups")
    stays = groups.groupBy("_group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row"))["_row"].alias("_stays"))
    gone, n = materialize(groups.join(stays, "_group").where("_row <> _stays").select("_row"), "gone", {"rows": F.count(F.lit(1))})
    return docs.join(maybe_broadcast(gone, n["rows"], BROADCAST_ROWS), "_row", "left_anti").select(*COLUMNS)


@stage
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = dec.contamination(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"), keep=COLUMNS)
    return rows.where(~dec.is_contaminated(F.col("_n_words"), dec.n_hit(F.col("_hits")))).select(*COLUMNS)


@stage
def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = pii.pseudonymise(docs.select(*COLUMNS), q_pii.KEY)
    return rows.withColumn("n_chars", F.when(F.size("_pii") > 0, F.char_length("text").cast("bigint")).otherwise(F.col("n_chars"))).select(*COLUMNS)


@stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.tokenize_and_pack(docs, q_packing.tokenizer_path())


STAGES = [("quality", quality), ("near_copies", near_copies), ("decontaminate", decontaminate), ("pii", private_data),
          ("packing", pack)]
ORACLE_SQL = None  # the stages learn, permute by key and tokenise


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = materialize(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
