"""The training-data pipeline: documents in, token ids out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on all that the stage before
kept, is written as Parquet and read again as the next one's ``docs``. All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from storelake.llm import bpe, decontaminate, line_dedup, near_dup, quality
from storelake.llm.common import stored, table


def quality_stage(spark, docs, sf_dir):
    """Documents that the classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_stage(spark, docs, sf_dir):
    """Lines that an earlier document holds go."""
    return line_dedup.dedup_lines(docs)


def near_dup_stage(spark, docs, sf_dir):
    """One document of each group of near copies stays."""
    return near_dup.keep_one(docs)


def benchmark_stage(spark, docs, sf_dir):
    """Documents that hold a benchmark item go."""
    return decontaminate.remove_leaks(docs, table(spark, sf_dir, "benchmark"))


def encode_stage(spark, docs, sf_dir):
    """Ids of every remaining text: count, digests of the ids and of the decoded bytes."""
    return bpe.encode_report(docs)


STAGES = [("quality", quality_stage), ("lines", line_stage), ("near_duplicates", near_dup_stage),
          ("benchmark", benchmark_stage), ("encode", encode_stage)]

# SQL can't express the language model, the signatures, the tiling and the encoder; tests/llm holds
# every stage against a brute-force version
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs
