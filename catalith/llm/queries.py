"""The registered queries of this folder and their SQL."""

from catalith.llm import (
    alignment, counting, jaccard, licences, lines, mixing, neardup, packing, quality, sharding, topk, urls,
    whitening,
)

QUERIES = {
    "op1_packing": packing.op1_packing,
    "op2_exact_topk": topk.op2_exact_topk,
    "op3_near_dedup": neardup.op3_near_dedup,
    "op4_licence_scan": licences.op4_licence_scan,
    "op5_mixing": mixing.op5_mixing,
    "op6_token_counts": counting.op6_token_counts,
    "op7_line_dedup": lines.op7_line_dedup,
    "op8_url_filters": urls.op8_url_filters,
    "op9_sharding": sharding.op9_sharding,
    "op10_quality_rules": quality.op10_quality_rules,
    "op11_jaccard_join": jaccard.op11_jaccard_join,
    "op12_whitening": whitening.op12_whitening,
    "op13_alignment": alignment.op13_alignment,
}
ORACLES: dict[str, str] = {
    "op2_exact_topk": topk.SQL,
    "op4_licence_scan": licences.SQL,
    "op5_mixing": mixing.SQL,
    "op7_line_dedup": lines.SQL,
}
