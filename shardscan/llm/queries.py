"""The registered queries of this subpackage and, where SQL can say the same, their DuckDB form."""

from shardscan.llm.decontaminate import OVERLAP_SQL, op8_suffix_automaton_decontamination
from shardscan.llm.hard_negatives import NEGATIVES_SQL, op13_four_russians_hard_negatives
from shardscan.llm.langid import op3_byte_cnn_language_id
from shardscan.llm.mixing import MIX_SQL, op9_poisson_mixing
from shardscan.llm.permutation_index import op6_permutation_index_search
from shardscan.llm.repeats import REPEATS_SQL, op5_interval_tree_dedup
from shardscan.llm.secrets import op7_entropy_secret_scan
from shardscan.llm.sharding import op4_vector_bin_packing
from shardscan.llm.simhash import op10_simhash_near_dedup
from shardscan.llm.toxicity import op1_weak_supervision_toxicity
from shardscan.llm.url_rules import URL_SQL, op11_url_wildcard_filter
from shardscan.llm.warc import WARC_SQL, op2_content_addressed_warc
from shardscan.llm.whitening import op12_pivoted_cholesky_whitening

QUERIES = {f.__name__: f for f in (
    op1_weak_supervision_toxicity, op2_content_addressed_warc, op3_byte_cnn_language_id, op4_vector_bin_packing,
    op5_interval_tree_dedup, op6_permutation_index_search, op7_entropy_secret_scan, op8_suffix_automaton_decontamination,
    op9_poisson_mixing, op10_simhash_near_dedup, op11_url_wildcard_filter, op12_pivoted_cholesky_whitening,
    op13_four_russians_hard_negatives)}

ORACLE_SQL: dict[str, str] = {
    "op2_content_addressed_warc": WARC_SQL, "op5_interval_tree_dedup": REPEATS_SQL,
    "op8_suffix_automaton_decontamination": OVERLAP_SQL, "op9_poisson_mixing": MIX_SQL,
    "op11_url_wildcard_filter": URL_SQL, "op13_four_russians_hard_negatives": NEGATIVES_SQL}
