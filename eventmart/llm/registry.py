"""The text operators' queries and their SQL, for the driver contract."""

from __future__ import annotations

from eventmart.llm import decontaminate, hard_negatives, jaccard_join, language_id, licenses, line_dedup, merkle, packing, plane_files, quality, sharding, surrogates, toxicity
from eventmart.llm.common import ship_code

def _shipped(query):
    def run(spark, sf_dir):
        ship_code(spark)
        return query(spark, sf_dir)
    return run


QUERIES = {
    "op1_surrogates": surrogates.op1_surrogates,
    "op2_quality_rules": quality.op2_quality_rules,
    "op3_best_fit_packing": packing.op3_best_fit_packing,
    "op4_license_scan": licenses.op4_license_scan,
    "op5_benchmark_decontamination": decontaminate.op5_benchmark_decontamination,
    "op6_token_planes": plane_files.op6_token_planes,
    "op7_histogram_shards": sharding.op7_histogram_shards,
    "op8_jaccard_join": jaccard_join.op8_jaccard_join,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_line_dedup": line_dedup.op10_line_dedup,
    "op11_language_id": language_id.op11_language_id,
    "op12_merkle_manifest": merkle.op12_merkle_manifest,
    "op13_hard_negatives": hard_negatives.op13_hard_negatives,
}
QUERIES = {name: _shipped(query) for name, query in QUERIES.items()}
SQL = {
    "op5_benchmark_decontamination": decontaminate.OP5_SQL,
    "op8_jaccard_join": jaccard_join.OP8_SQL,
    "op10_line_dedup": line_dedup.OP10_SQL,
    "op12_merkle_manifest": merkle.OP12_SQL,
    "op13_hard_negatives": hard_negatives.OP13_SQL,
}
