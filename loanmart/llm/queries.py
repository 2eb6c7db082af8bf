"""Registered queries of this subpackage and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpus_pipeline import run as pipeline
from loanmart.llm.bpe import op1_byte_bpe
from loanmart.llm.decontaminate import OP9_SQL, op9_decontaminate
from loanmart.llm.html_text import op7_html_text
from loanmart.llm.lexical_search import OP11_SQL, op11_lexical_search
from loanmart.llm.merkle import OP13_SQL, op13_merkle
from loanmart.llm.pitman_yor import op2_pitman_yor
from loanmart.llm.quality import op5_quality
from loanmart.llm.simhash import op6_simhash
from loanmart.llm.suffix_dedup import OP4_SQL, op4_suffix_dedup
from loanmart.llm.token_counts import op10_token_counts
from loanmart.llm.token_files import op8_token_files
from loanmart.llm.url_filter import OP3_SQL, op3_url_filter
from loanmart.llm.vector_search import OP12_SQL, op12_vector_search

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "pipeline": pipeline,
    "op1_byte_bpe": op1_byte_bpe,
    "op2_pitman_yor": op2_pitman_yor,
    "op3_url_filter": op3_url_filter,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_quality": op5_quality,
    "op6_simhash": op6_simhash,
    "op7_html_text": op7_html_text,
    "op8_token_files": op8_token_files,
    "op9_decontaminate": op9_decontaminate,
    "op10_token_counts": op10_token_counts,
    "op11_lexical_search": op11_lexical_search,
    "op12_vector_search": op12_vector_search,
    "op13_merkle": op13_merkle,
}

SQL: dict[str, str] = {
    "op3_url_filter": OP3_SQL,
    "op4_suffix_dedup": OP4_SQL,
    "op9_decontaminate": OP9_SQL,
    "op11_lexical_search": OP11_SQL,
    "op12_vector_search": OP12_SQL,
    "op13_merkle": OP13_SQL,
}
