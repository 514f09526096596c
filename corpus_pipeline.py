"""Documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``; a lost
executor repeats one stage's tasks at most.  All but the last keep the
columns of ``docs``, whichever they are.

1. toxicity: documents that score 0.5 or more go, if a clause of theirs
   weighs at all.  The model learns from the labels of rows whose
   crc32(doc_id) mod 5 is not 0.
2. near_dedup: one document of each group of near copies stays.
3. decontamination: documents in which a benchmark window occurs go.
4. secrets: values that look secret are replaced; documents stay.
5. packing: the pieces of the documents that are left, by sequence.

Edge cases are those of the operators: null or empty texts pass all stages
and are packed as an end id alone; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spindle.llm import decontaminate, near_dup, packing, secrets, toxicity
from spindle.llm.common import cut, documents
from spindle.session import read_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    train_docs, train_labels, _ = toxicity.train_part(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.remove_toxic(docs, toxicity.fit(train_docs, train_labels))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_documents(docs, read_table(spark, sf_dir, "benchmark"))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("secrets", hide_secrets),
    ("packing", pack_sequences),
]

#: No stage but the third has a SQL form; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
