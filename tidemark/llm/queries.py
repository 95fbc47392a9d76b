"""The queries of this subpackage by name, and the SQL of those that SQL can express."""

from tidemark.llm import oracles
from tidemark.llm.audit import op13_filter_audit
from tidemark.llm.codes import op12_vector_codes
from tidemark.llm.decontaminate import op6_benchmark_decontamination
from tidemark.llm.html import op8_html_extraction
from tidemark.llm.licenses import op4_license_scan
from tidemark.llm.minhash import op1_minhash_near_dedup
from tidemark.llm.packing import op5_best_fit_packing
from tidemark.llm.personal import op10_personal_data
from tidemark.llm.quality import op9_quality_rules
from tidemark.llm.repeats import op2_suffix_array_dedup
from tidemark.llm.substrings import op3_substring_dedup
from tidemark.llm.toxicity import op7_toxicity
from tidemark.llm.urls import op11_url_filters

QUERIES = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_suffix_array_dedup": op2_suffix_array_dedup,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_license_scan": op4_license_scan,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_toxicity": op7_toxicity,
    "op8_html_extraction": op8_html_extraction,
    "op9_quality_rules": op9_quality_rules,
    "op10_personal_data": op10_personal_data,
    "op11_url_filters": op11_url_filters,
    "op12_vector_codes": op12_vector_codes,
    "op13_filter_audit": op13_filter_audit,
}
ORACLES: dict[str, str] = {
    "op1_minhash_near_dedup": oracles.NEAR_DUPLICATES,
    "op3_substring_dedup": oracles.REPEATED_WORDS,
    "op6_benchmark_decontamination": oracles.CONTAMINATION,
    "op11_url_filters": oracles.URL_VERDICTS,
    "op12_vector_codes": oracles.VECTOR_CODES,
    "op13_filter_audit": oracles.FILTER_AUDIT,
}
