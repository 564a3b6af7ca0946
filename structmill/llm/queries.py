"""The numbered queries over the whole tables of a folder, and their SQL where there is any."""

from __future__ import annotations

from structmill.llm import decontaminate, divergence, interactions, jaccard, mixing, packing, pii, pitman_yor, quality, substrings, topk, toxicity, url_filter


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _over(function, *tables):
    return lambda spark, sf_dir: function(*(_table(spark, sf_dir, t) for t in tables))


QUERIES = {
    "op8_pii": _over(pii.op8_pii, "documents"),
    "op1_pitman_yor": _over(pitman_yor.op1_pitman_yor, "documents"),
    "op2_jaccard": _over(jaccard.op2_jaccard, "documents"),
    "op9_substrings": _over(substrings.op9_substrings, "documents"),
    "op4_topk": _over(topk.op4_topk, "embeddings"),
    "op10_decontaminate": _over(decontaminate.op10_decontaminate, "documents", "benchmark"),
    "op3_mix": _over(mixing.op3_mix, "documents"),
    "op5_url_filter": _over(url_filter.op5_url_filter, "pages"),
    "op6_toxicity": _over(toxicity.op6_toxicity, "documents", "labels"),
    "op7_quality": _over(quality.op7_quality, "documents", "labels"),
    "op11_divergence": _over(divergence.op11_divergence, "documents"),
    "op12_packing": _over(packing.op12_packing, "documents"),
    "op13_interactions": _over(interactions.op13_interactions, "documents", "labels"),
}
ORACLES = {"op2_jaccard": jaccard.ORACLE, "op9_substrings": substrings.ORACLE, "op4_topk": topk.ORACLE, "op10_decontaminate": decontaminate.ORACLE, "op5_url_filter": url_filter.ORACLE, "op11_divergence": divergence.ORACLE, "op13_interactions": interactions.ORACLE}
