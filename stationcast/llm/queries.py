"""The queries of the operators, and the SQL that some must equal."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from .base import findable
from .decontamination import OP8_SQL, op8_benchmark_decontamination
from .embedding_dedup import OP12_SQL, op12_embedding_near_dedup
from .filter_audit import OP11_SQL, op11_filter_interaction_audit
from .html_extraction import op2_html_extraction
from .language import op6_language_id
from .licenses import OP4_SQL, op4_license_scan
from .line_dedup import OP5_SQL, op5_line_dedup
from .ngram_join import OP3_SQL, op3_ngram_jaccard_join
from .packing import op1_best_fit_packing
from .repeats import op10_suffix_array_dedup
from .search import OP7_SQL, op7_exact_top_k
from .sharding import op9_sharding
from .vector_codes import OP13_SQL, op13_vector_code_compression

Query = Callable[[SparkSession, str], DataFrame]


def with_package(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        findable(spark)
        return query(spark, folder)

    return run


QUERIES: dict[str, Query] = {
    q.__name__: with_package(q)
    for q in (
        op1_best_fit_packing,
        op2_html_extraction,
        op3_ngram_jaccard_join,
        op4_license_scan,
        op5_line_dedup,
        op6_language_id,
        op7_exact_top_k,
        op8_benchmark_decontamination,
        op9_sharding,
        op10_suffix_array_dedup,
        op11_filter_interaction_audit,
        op12_embedding_near_dedup,
        op13_vector_code_compression,
    )
}

ORACLES = {
    "op3_ngram_jaccard_join": OP3_SQL,
    "op4_license_scan": OP4_SQL,
    "op5_line_dedup": OP5_SQL,
    "op7_exact_top_k": OP7_SQL,
    "op8_benchmark_decontamination": OP8_SQL,
    "op11_filter_interaction_audit": OP11_SQL,
    "op12_embedding_near_dedup": OP12_SQL,
    "op13_vector_code_compression": OP13_SQL,
}
