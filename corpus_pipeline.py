"""From raw documents to packed training sequences.

Each stage is one operator of ``tablelearn.llm``; its result is written as
Parquet under the shared checkpoint directory and read again as the next
stage's documents, so a lost executor costs at most a stage.
"""

from __future__ import annotations

from tablelearn.llm import jaccard_join, line_dedup, mixing, packing, toxicity
from tablelearn.llm.common import table
from tablelearn.plans.shaping import cut_lineage


def drop_toxic(spark, docs, sf_dir):
    """Documents scored toxic (0.7 or more) go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark, docs, sf_dir):
    """Runs of lines that repeat an earlier run leave the texts."""
    return line_dedup.dedup_lines(docs)


def keep_one_of_near_copies(spark, docs, sf_dir):
    """One document of each component of 5-word shingle sets at 0.8 stays."""
    return jaccard_join.keep_one(docs, size=5, num=80, den=100)


def mix_sources(spark, docs, sf_dir):
    """Rows are left out or repeated until sources have their target weights."""
    return mixing.mix(docs)


def pack(spark, docs, sf_dir):
    """Pieces of token ids in sequences of at most 1,024."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", keep_one_of_near_copies),
    ("mixing sources", mix_sources),
    ("packing", pack),
]

# SQL can express neither the language models nor the tokenizer
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = cut_lineage(stage(spark, docs, sf_dir), f"stage-{k + 1}-{name.split()[0]}")
    return docs
