"""Queries of the training-data operators, by name, and their DuckDB twins where SQL can express them."""

from __future__ import annotations

from . import op1_graph, op4_suffixes, op7_parity, op9_licences, op10_lines
from .op1_graph import op1_robust_graph
from .op2_sharding import op2_vector_bin_packing
from .op3_pii import op3_feistel_pseudonyms
from .op4_suffixes import op4_suffix_dedup
from .op5_packing import op5_hilbert_packing
from .op6_mixing import op6_raked_mixture
from .op7_parity import op7_parity_sketch_join
from .op8_quality import op8_additive_quality
from .op9_licences import op9_licence_dice
from .op10_lines import op10_line_frequency

QUERIES = {
    f.__name__: f
    for f in (
        op1_robust_graph,
        op2_vector_bin_packing,
        op3_feistel_pseudonyms,
        op4_suffix_dedup,
        op5_hilbert_packing,
        op6_raked_mixture,
        op7_parity_sketch_join,
        op8_additive_quality,
        op9_licence_dice,
        op10_line_frequency,
    )
}

ORACLES: dict[str, str] = {
    "op1_robust_graph": op1_graph.ORACLE,
    "op4_suffix_dedup": op4_suffixes.ORACLE,
    "op7_parity_sketch_join": op7_parity.ORACLE,
    "op9_licence_dice": op9_licences.ORACLE,
    "op10_line_frequency": op10_lines.ORACLE,
}
