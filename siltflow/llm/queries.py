"""The queries of this package, by name, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siltflow.llm.chat import OP3_SQL, op3_chat_formatting
from siltflow.llm.decontam import op10_benchmark_decontamination
from siltflow.llm.filter_audit import OP12_SQL, op12_filter_audit
from siltflow.llm.html_text import op1_html_extraction
from siltflow.llm.langid import op9_language_id
from siltflow.llm.line_templates import OP4_SQL, op4_line_dedup
from siltflow.llm.packing import op5_best_fit_packing
from siltflow.llm.pii import op2_pii
from siltflow.llm.quality import op6_quality_rules
from siltflow.llm.repair import OP11_SQL, op11_conversation_repair
from siltflow.llm.simhash import op7_simhash_near_dedup
from siltflow.llm.token_counts import op8_token_counts
from siltflow.llm.url_filter import OP13_SQL, op13_url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extraction": op1_html_extraction,
    "op2_pii": op2_pii,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_line_dedup": op4_line_dedup,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_quality_rules": op6_quality_rules,
    "op7_simhash_near_dedup": op7_simhash_near_dedup,
    "op8_token_counts": op8_token_counts,
    "op9_language_id": op9_language_id,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_filter_audit": op12_filter_audit,
    "op13_url_filter": op13_url_filter,
}

SQL: dict[str, str] = {"op3_chat_formatting": OP3_SQL, "op4_line_dedup": OP4_SQL, "op11_conversation_repair": OP11_SQL, "op12_filter_audit": OP12_SQL, "op13_url_filter": OP13_SQL}
