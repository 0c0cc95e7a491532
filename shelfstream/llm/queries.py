"""The operators of this subpackage as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfstream.llm.byte_bpe import op3_byte_bpe
from shelfstream.llm.divergence import OP13_SQL, op13_divergence
from shelfstream.llm.hard_negatives import OP12_SQL, op12_hard_negatives
from shelfstream.llm.language import op8_language
from shelfstream.llm.packing import op10_packing
from shelfstream.llm.privacy import op7_pii
from shelfstream.llm.quality import op5_quality
from shelfstream.llm.simhash import op2_simhash
from shelfstream.llm.token_store import op1_token_output
from shelfstream.llm.url_filter import OP11_SQL, op11_url_filter
from shelfstream.llm.vector_dedup import op6_embedding_dedup
from shelfstream.llm.vector_search import op9_vector_search
from shelfstream.llm.warc import OP4_SQL, op4_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_output": op1_token_output,
    "op2_simhash": op2_simhash,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_warc": op4_warc,
    "op5_quality": op5_quality,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_pii": op7_pii,
    "op8_language": op8_language,
    "op9_vector_search": op9_vector_search,
    "op10_packing": op10_packing,
    "op11_url_filter": op11_url_filter,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_divergence": op13_divergence,
}

ORACLE_SQL: dict[str, str] = {
    "op4_warc": OP4_SQL,
    "op11_url_filter": OP11_SQL,
    "op12_hard_negatives": OP12_SQL,
    "op13_divergence": OP13_SQL,
}
