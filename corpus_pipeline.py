"""From raw documents to shards: quality rules, near-duplicates, benchmark passages, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the next one's docs.
All but the last return the columns of documents, whichever there are. Mixing repeats rows of small sources, so after it a
doc_id may stand more than once; sharding shuffles a source pass by pass, so that a repeat comes after the whole source,
and ``slot`` within ``shard`` tells them apart.

Null and empty texts fail the base rules of the first stage; null languages and sources are groups of their own; of rows
without an id none is taken for another's copy unless their texts are; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarrystone.llm.decontam import decontam_sql, drop_contaminated
from quarrystone.llm.mixing import mix_sources, mixing_sql
from quarrystone.llm.neardup import drop_near_duplicates, neardup_sql
from quarrystone.llm.quality import quality_filter, quality_sql
from quarrystone.llm.sharding import interleave_shards, sharding_sql
from quarrystone.session import materialize, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_sources(docs, epochs=False)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return interleave_shards(docs, keep=["doc_id", "source"], repeats=True)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("shard", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; what each returns is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


_OF = "doc_id, text, lang, source, n_chars"
ORACLE_SQL = f"""WITH RECURSIVE {quality_sql("documents")},
  after_quality AS MATERIALIZED (SELECT {_OF} FROM judged WHERE kept),
  {neardup_sql("after_quality")},
  after_near AS MATERIALIZED (SELECT {_OF} FROM after_quality JOIN verdict USING (doc_id) WHERE kept),
  {decontam_sql("after_near")},
  after_decontam AS MATERIALIZED (SELECT {_OF} FROM after_near WHERE doc_id NOT IN (SELECT doc_id FROM dc_matches)),
  {mixing_sql("after_decontam")},
  after_mix AS MATERIALIZED (SELECT {_OF} FROM after_decontam JOIN mx_copies USING (doc_id)),
  {sharding_sql("after_mix", repeats=True)}
SELECT * FROM sharded"""
