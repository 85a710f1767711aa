"""The corpus pipeline: stages that filter, clean and encode documents, each written and read again by the next.

Every stage but the last returns the columns of `documents`. Where a stage changes a text, n_chars follows it; a document
of which line dedup leaves nothing goes.

Defined results: a null or empty text, as any without a letter, is rejected by language ID; a text of any length is worked
on whole; rows that repeat a document are one document for near-dedup by doc_id, so a repeated doc_id keeps or loses all of
its rows, and rows of a null doc_id link with nothing and leak nothing; of similar lines and documents the one of the smallest
doc_id stays; extra columns pass through the first four stages unchanged, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrazzo.llm import bpe, decontaminate, langid, linededup, neardup
from terrazzo.llm.common import stash, table

#: A text that costs more bits a byte than this under its best language is in none of them.
MOST_BITS = 7.0
USED = ("doc_id", "text")


def apart(docs: DataFrame, *used: str) -> DataFrame:
    """The columns that an operator uses, and all others as one; so none of them can clash with the operator's own columns."""
    return docs.select(*used, F.struct(*(F.col(f"`{c}`") for c in docs.columns if c not in used)).alias("others"))


def together(found: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """The columns of docs again, from found or as changed."""
    return found.select(*((changed[c] if c in changed else F.col("others").getField(c) if c not in USED else F.col(c)).alias(c) for c in docs.columns))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter, and those that no language explains better than nearly random bytes."""
    found = langid.identify(apart(docs, *USED), langid.fit(docs, ~langid.held_out()))
    return together(found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("bits_per_byte") <= MOST_BITS)), docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    done = linededup.dedup_lines(apart(docs, *USED)).where("n_removed = 0 or n_removed < n_lines")
    return together(done, docs, n_chars=F.length("text").cast(docs.schema["n_chars"].dataType))


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five words a shingle, similarity 0.8; the smallest doc_id of each group stays."""
    gone = neardup.near_duplicates(docs, k=5, percent=80).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", identify_language),
    ("line dedup", dedup_lines),
    ("MinHash near-dedup", dedup_documents),
    ("benchmark decontamination", drop_leaks),
    ("byte-level BPE", encode),
]

#: Model scores and byte pairs of whole texts have no SQL form; the tests hold run() against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stash(docs, f"stage{k}")
    return docs
