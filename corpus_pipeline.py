"""The corpus pipeline: quality rules, exact dedup, near dedup, source mix,
packing.  Every stage is ``(spark, docs, sf_dir) -> DataFrame``; ``run``
applies them to ``documents``, each result being written as Parquet in the
shared folder and read again as the next stage's input.

All but the last return the columns of their input (extra columns pass
through), the last a row per packed piece.  Null or empty texts fail the
quality rules and leave there; repeated rows are copies and leave in exact
dedup; an empty table passes through as an empty table.
"""

from __future__ import annotations

from demandlake.llm import exact_dedup, mixing, ngram_join, packing, quality_rules
from demandlake.llm.tables import keep, read, ship


def quality(spark, docs, sf_dir):
    ship(spark)
    return quality_rules.keep_good(docs, read(spark, sf_dir, "labels"))


def exact(spark, docs, sf_dir):
    ship(spark)
    return exact_dedup.keep_winners(docs)


def near(spark, docs, sf_dir):
    ship(spark)
    return ngram_join.keep_one(docs)


def mix(spark, docs, sf_dir):
    ship(spark)
    return mixing.mixed_documents(docs)


def pack(spark, docs, sf_dir):
    ship(spark)
    return packing.pack(docs)


STAGES = [("quality_rules", quality), ("exact_dedup", exact), ("near_dedup", near), ("mix", mix), ("pack", pack)]

#: The forest's verdict, the knapsack fit and the packing have no SQL form;
#: tests/llm holds the stages against brute-force versions instead.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = keep(docs, f"pipeline-{name}")
    return docs
