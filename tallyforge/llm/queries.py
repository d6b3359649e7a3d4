"""The registered queries of this package, and SQL for those that SQL can express."""

from __future__ import annotations

from tallyforge.llm.alignment import op11_galloping_token_alignment
from tallyforge.llm.decontamination import op3_prefix_filtered_decontamination
from tallyforge.llm.embeddings import op8_sorted_projection_near_dedup
from tallyforge.llm.language import op1_hyperdimensional_language_id
from tallyforge.llm.licenses import op9_prefix_filtered_license_scan
from tallyforge.llm.mixing import op7_context_mixing_scores
from tallyforge.llm.packing import op5_vector_bin_packing
from tallyforge.llm.quality import op10_kneser_ney_quality
from tallyforge.llm.ranking import OP12_SQL, op12_dense_ranked_search
from tallyforge.llm.secrets import op4_guess_cost_secret_scan
from tallyforge.llm.simhash import op6_simhash_near_dedup
from tallyforge.llm.substrings import op2_difference_cover_substring_dedup
from tallyforge.llm.toxicity import op13_multiple_instance_toxicity

QUERIES = {
    f.__name__: f
    for f in (
        op1_hyperdimensional_language_id,
        op2_difference_cover_substring_dedup,
        op3_prefix_filtered_decontamination,
        op4_guess_cost_secret_scan,
        op5_vector_bin_packing,
        op6_simhash_near_dedup,
        op7_context_mixing_scores,
        op8_sorted_projection_near_dedup,
        op9_prefix_filtered_license_scan,
        op10_kneser_ney_quality,
        op11_galloping_token_alignment,
        op12_dense_ranked_search,
        op13_multiple_instance_toxicity,
    )
}

SQL: dict[str, str] = {"op12_dense_ranked_search": OP12_SQL}
