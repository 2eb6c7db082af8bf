"""The corpus pipeline: quality rules, near-duplicates, repeated passages, benchmark passages, token ids.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and read again
as the next stage's ``docs``.  All stages but the last return the columns of ``documents``.

Defined cases: rows with NULL or empty text are rejected by the first stage; repeated rows, ties and NULL ids
follow the operators; an empty table gives an empty result; other columns keep their values, whatever their names
(in the last stage, columns named like its results give way to them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanmart.llm.bpe import encode, public_ranks
from loanmart.llm.common import store, table
from loanmart.llm.decontaminate import decontaminate
from loanmart.llm.quality import judge
from loanmart.llm.simhash import keep_one
from loanmart.llm.suffix_dedup import remove_repeats


def apart(docs: DataFrame) -> DataFrame:
    """id and text as ``doc_id`` and ``text``, all other columns in one, so that no result replaces them."""
    return docs.select("doc_id", "text", F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in docs.columns
                                                                        if c not in ("doc_id", "text")]).alias("__rest"))


def together(done: DataFrame, docs: DataFrame, **new) -> DataFrame:
    """The columns of ``docs`` again, with ``new`` ones in place of the old."""
    old = {c: F.col(c) if c in ("doc_id", "text") else F.col(f"__rest.`{c}`") for c in docs.columns}
    return done.select(*[new.get(c, x).alias(c) for c, x in old.items()])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised rules reject go."""
    return together(judge(apart(docs)).filter("kept"), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: the one with the smallest id."""
    return together(keep_one(apart(docs)), docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of over 50 words, or of 400 bytes, that repeat go from every text (whole characters only);
    ``n_chars`` follows the text.  Runs are found from 200 bytes on, as 50 words have four bytes each or more."""
    done = remove_repeats(apart(docs), whole_characters=True, length=200, gram=32, least_bytes=400, least_words=51)
    text = F.when(F.col("text").isNotNull(), F.col("kept").cast("string"))
    new = {"text": text}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.size("removed") > 0, F.length(text).cast("bigint")).otherwise(F.col("__rest.n_chars"))
    return together(done, docs, **new)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a ten-word window of a benchmark item go."""
    return together(decontaminate(apart(docs), table(spark, sf_dir, "benchmark")).filter("n_hit = 0"), docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids (packed, four bytes each, little-endian) and whether they decode to the text."""
    ranks = public_ranks()
    done = encode(apart(docs), *ranks, decoded="decoded")
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    made = {"n_tokens": (F.octet_length("ids") / 4).cast("long"), "ids": F.col("ids"), "round_trip": same}
    rest = [c for c in docs.columns if c not in ("doc_id", "text", *made)]
    return done.select("doc_id", *[F.col(f"__rest.`{c}`").alias(c) for c in rest], *[x.alias(c) for c, x in made.items()])


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("repeats", repeats), ("benchmark_free", benchmark_free),
          ("token_ids", token_ids)]

#: Induced sorting, trained posteriors and merges have no SQL form; tests hold the rows against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
