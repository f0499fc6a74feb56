"""The queries of this package and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tagweave.llm.chunks import OP6_SQL, op6_chunk_recipes
from tagweave.llm.ledger import op10_blob_ledger
from tagweave.llm.lexical import OP13_SQL, op13_best_positions
from tagweave.llm.licences import op7_licence_rules
from tagweave.llm.lines import op2_line_labels
from tagweave.llm.mixing import OP1_SQL, op1_mixing
from tagweave.llm.packing import op9_bounded_packing
from tagweave.llm.pair_counts import op12_spill_counted_pairs
from tagweave.llm.personal import op3_deobfuscated_pii
from tagweave.llm.repeats import op8_induced_suffixes
from tagweave.llm.sketches import OP4_SQL, op4_parity_sketches
from tagweave.llm.tokenfiles import op5_orc_tokens
from tagweave.llm.vectors import OP11_SQL, op11_cross_polytope

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_line_labels": op2_line_labels,
    "op3_deobfuscated_pii": op3_deobfuscated_pii,
    "op4_parity_sketches": op4_parity_sketches,
    "op5_orc_tokens": op5_orc_tokens,
    "op6_chunk_recipes": op6_chunk_recipes,
    "op7_licence_rules": op7_licence_rules,
    "op8_induced_suffixes": op8_induced_suffixes,
    "op9_bounded_packing": op9_bounded_packing,
    "op10_blob_ledger": op10_blob_ledger,
    "op11_cross_polytope": op11_cross_polytope,
    "op12_spill_counted_pairs": op12_spill_counted_pairs,
    "op13_best_positions": op13_best_positions,
}

ORACLES: dict[str, str] = {
    "op1_mixing": OP1_SQL,
    "op4_parity_sketches": OP4_SQL,
    "op6_chunk_recipes": OP6_SQL,
    "op11_cross_polytope": OP11_SQL,
    "op13_best_positions": OP13_SQL,
}
