"""A corpus from raw documents to a mix, in five stages.

1. language ID: documents in no language that was learned go (null texts, texts without a
   letter);
2. exact dedup: of equal texts, the row with the smallest doc_id stays;
3. n-gram Jaccard join: of each group of near copies, the document with the smallest doc_id
   stays;
4. benchmark decontamination: documents that hold at least half of a benchmark item go;
5. mixing sources to target weights: the result has the columns of documents, then mix_epoch,
   mix_shard, mix_place and mix_words, with a row for each time a document is drawn.

Each stage sees all that the one before it kept. Its result is written as Parquet in the
shared folder and read again, so a lost executor costs a stage's tasks at most; what a stage
wrote besides is removed when it ends.

Defined results: null, empty and letterless texts go in the first stage. A null identifier is
smaller than none for the second stage, no member of a group for the third, and judged by its
text in the fourth. Of rows that repeat an identifier and a text one stays; of rows that repeat
an identifier with different texts those stay that each stage keeps by their text, or by their
identifier where it decides by group. Ties go to the smallest identifier. Texts of any length
are read whole. Extra columns, whatever their names, come out as they went in. Of an empty
table an empty one is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from monthtide.llm.decontamination import drop_contaminated
from monthtide.llm.exact_dedup import drop_copies
from monthtide.llm.frames import table
from monthtide.llm.jaccard_join import drop_near_copies
from monthtide.llm.language_id import keep_identified
from monthtide.llm.mixing import mixed_shards
from monthtide.shared import scratch


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_identified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_copies(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"), any_case=True)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_shards(docs)


STAGES = [
    ("language ID", language_id),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", jaccard_join),
    ("benchmark decontamination", decontamination),
    ("mixing sources", mixing),
]

#: SQL expresses neither the machines of the first stage nor the draws of the last.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        with scratch(spark) as work:
            docs = work.keep(stage(spark, docs, sf_dir))
    return docs
