"""Queries of the subpackage, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from .decontamination import op2_qgram_decontamination
from .divergence import OP12_SQL, op12_source_divergence
from .extraction import op6_site_style_tree
from .language_id import op1_hyperdimensional_language
from .near_dedup import op3_probminhash_dedup
from .packing import op4_best_two_fit
from .periodic_runs import op13_periodic_runs
from .quality import op10_factorisation_quality
from .revisits import OP8_SQL, op8_revisit_resolution
from .shuffling import op11_hypergeometric_shuffle
from .substring_dedup import op9_substring_dedup
from .topk import OP5_SQL, op5_exact_top_k
from .toxicity import op7_toxicity

QUERIES = {
    "op1_hyperdimensional_language": op1_hyperdimensional_language,
    "op2_qgram_decontamination": op2_qgram_decontamination,
    "op3_probminhash_dedup": op3_probminhash_dedup,
    "op4_best_two_fit": op4_best_two_fit,
    "op5_exact_top_k": op5_exact_top_k,
    "op6_site_style_tree": op6_site_style_tree,
    "op7_toxicity": op7_toxicity,
    "op8_revisit_resolution": op8_revisit_resolution,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_factorisation_quality": op10_factorisation_quality,
    "op11_hypergeometric_shuffle": op11_hypergeometric_shuffle,
    "op12_source_divergence": op12_source_divergence,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLES: dict[str, str] = {
    "op5_exact_top_k": OP5_SQL,
    "op8_revisit_resolution": OP8_SQL,
    "op12_source_divergence": OP12_SQL,
}
