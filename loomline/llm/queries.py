"""The registered queries of this package and their DuckDB statements."""

from __future__ import annotations

import corpus_pipeline

from . import context_mixing, cross_parse, filter_audit, line_quality, lines, minhash, mixing, packing, rule_ensemble, simhash_tree, token_align, toxicity, voronoi_topk
from .common import table

QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_context_mixing": lambda spark, sf_dir: context_mixing.digest(table(spark, sf_dir, "documents")),
    "op6_voronoi_topk": lambda spark, sf_dir: voronoi_topk.digest(table(spark, sf_dir, "embeddings")),
    "op5_rule_ensemble": lambda spark, sf_dir: rule_ensemble.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
    "op7_kneser_ney_toxicity": lambda spark, sf_dir: toxicity.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
    "op8_cross_parsing": lambda spark, sf_dir: cross_parse.digest(table(spark, sf_dir, "documents")),
    "op4_best_two_fit": lambda spark, sf_dir: packing.digest(table(spark, sf_dir, "documents")),
    "op2_source_mix": lambda spark, sf_dir: mixing.digest(table(spark, sf_dir, "documents")),
    "op3_simhash_tree": lambda spark, sf_dir: simhash_tree.digest(table(spark, sf_dir, "documents")),
    "op9_line_frequency": lambda spark, sf_dir: line_quality.digest(table(spark, sf_dir, "documents")),
    "op11_minhash": lambda spark, sf_dir: minhash.digest(table(spark, sf_dir, "documents")),
    "op12_pair_bitmaps": lambda spark, sf_dir: token_align.digest(table(spark, sf_dir, "documents")),
    "op13_filter_audit": lambda spark, sf_dir: filter_audit.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
    "op10_line_dedup": lambda spark, sf_dir: lines.digest(table(spark, sf_dir, "documents")),
}

SQL = {
    "op6_voronoi_topk": voronoi_topk.SQL,
    "op9_line_frequency": line_quality.SQL,
    "op10_line_dedup": lines.SQL,
    "op13_filter_audit": filter_audit.SQL,
}
