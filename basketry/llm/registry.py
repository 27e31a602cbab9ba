"""The registered queries of this package and, where SQL can express them, their checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from basketry.llm.ann import op1_adaptive_scan
from basketry.llm.bbit import OP12_SQL, op12_bbit_minhash
from basketry.llm.bpe import op10_byte_bpe
from basketry.llm.context_tree import op5_context_tree
from basketry.llm.licenses import op9_license_join, scan_sql
from basketry.llm.lines import op8_fuzzy_lines
from basketry.llm.merkle import OP11_SQL, op11_merkle_manifest
from basketry.llm.packing import op3_grouped_packing
from basketry.llm.paragraphs import op4_paragraph_minhash
from basketry.llm.parity import OP7_SQL, op7_parity_join
from basketry.llm.repair import op13_conversation_repair
from basketry.llm.topk import OP2_SQL, op2_nra_top_k
from basketry.llm.toxicity import op6_nnpu_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_adaptive_scan": op1_adaptive_scan,
    "op2_nra_top_k": op2_nra_top_k,
    "op3_grouped_packing": op3_grouped_packing,
    "op4_paragraph_minhash": op4_paragraph_minhash,
    "op5_context_tree": op5_context_tree,
    "op6_nnpu_toxicity": op6_nnpu_toxicity,
    "op7_parity_join": op7_parity_join,
    "op8_fuzzy_lines": op8_fuzzy_lines,
    "op9_license_join": op9_license_join,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_bbit_minhash": op12_bbit_minhash,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLES: dict[str, str] = {
    "op2_nra_top_k": OP2_SQL,
    "op7_parity_join": OP7_SQL,
    "op9_license_join": scan_sql(),
    "op11_merkle_manifest": OP11_SQL,
    "op12_bbit_minhash": OP12_SQL,
}
