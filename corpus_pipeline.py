"""From raw documents to training sequences in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; all but the last
return the columns of documents.  ``run`` applies them to the documents table, with a table
in the shared folder between stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortlens.llm.mixing import mix_sources, mixed_documents
from cohortlens.llm.near_duplicates import without_copies
from cohortlens.llm.packing import pack_documents
from cohortlens.llm.queries import table, vocabulary
from cohortlens.llm.secrets import find_secrets, redacted
from cohortlens.llm.staging import staged
from cohortlens.llm.toxicity import reject_toxic, train


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more for toxicity go.

    Null and empty texts are scored as one empty window.  Repeated rows score alike and stay or go
    together; null ids are scored like others but not learnt from.  Without labels of both kinds
    all stay.  An empty table stays empty."""
    return reject_toxic(docs, train(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five-word shingles, similarity 0.8).

    The smallest doc_id of a group stays.  Null and empty texts are in no group and stay.  Rows
    of null or shared ids are documents by id and text, of which equal ones are copies.  An empty
    table stays empty."""
    return without_copies(docs, shingle_words=5, percent=80)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by a mark; all documents stay.

    Overlapping secrets get one mark.  Null and empty texts stay as they are, repeated rows stay
    each, and all rows without a source count as one owner.  An empty table stays empty."""
    return redacted(docs, find_secrets(docs))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are cut and repeated to their target weights.

    A document gives a row for each pass that took words of it, at most three.  Null and empty
    texts give none; a null source is a source of its own; repeated rows are documents of their
    own.  Reruns agree.  An empty table stays empty."""
    return mixed_documents(docs, mix_sources(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences with power-of-two lengths, one row for each piece.

    A null or empty text is the end id alone; rows of one id are packed each on their own.  An
    empty table gives no rows."""
    return pack_documents(docs, vocabulary())


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("secret_scan", secret_scan),
          ("mixing", mixing), ("packing", packing)]

#: No stage but the secret scan can be stated in SQL; tests compare ``run`` with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
