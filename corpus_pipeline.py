"""The corpus pipeline: documents through five operators, each stage written and read again.

Rejected, duplicate and contaminated documents go; the mix repeats or leaves out documents to meet
its sources' targets; the last stage writes what remains as token records and reads them back.
"""

from __future__ import annotations

from clickweave.llm import common, decontaminate, minhash, mix, quality, records


def keep_good(spark, docs, sf_dir):
    """Documents that the ordinal classifier, fitted on the labelled ones, grades good."""
    common.ship_code(spark)
    return quality.selected(docs, quality.fit(docs, common.table(spark, sf_dir, "labels")))


def drop_near_copies(spark, docs, sf_dir):
    """One document of each group of near-duplicates (five words, similarity 0.8)."""
    common.ship_code(spark)
    return minhash.deduplicated(docs)


def drop_benchmark_copies(spark, docs, sf_dir):
    """Documents that benchmark windows do not contaminate."""
    return decontaminate.decontaminated(docs, common.table(spark, sf_dir, "benchmark"))


def mix_sources(spark, docs, sf_dir):
    """The rows that the mix of sources takes, once for each copy."""
    return mix.mixed_documents(docs)


def write_tokens(spark, docs, sf_dir):
    """doc_id, start, n_tokens, ids_crc32 of every record of the token files."""
    common.ship_code(spark)
    return records.encoded(docs)


STAGES = [
    ("quality", keep_good),
    ("near-duplicates", drop_near_copies),
    ("decontamination", drop_benchmark_copies),
    ("mixing", mix_sources),
    ("records", write_tokens),
]

#: The classifier and the tokenizer are beyond SQL; tests/llm/test_pipeline.py holds the rows
#: against a plain version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Apply all stages to ``documents``; the rows of the last one."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
