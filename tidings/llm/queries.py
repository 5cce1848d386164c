"""The registered queries of this package; their SQL is in ``oracles``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidings.llm import alignment, kdtree, langid, minhash, mixing, nearest, packing, pii, resampling, secrets, sketchjoin, toxicity, warc


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_warc": warc.op1_warc,
        "op2_language_id": langid.op2_language_id,
        "op3_mixing": mixing.op3_mixing,
        "op4_toxicity": toxicity.op4_toxicity,
        "op5_secrets": secrets.op5_secrets,
        "op6_pii": pii.op6_pii,
        "op7_kdtree": kdtree.op7_kdtree,
        "op8_packing": packing.op8_packing,
        "op9_similarity": sketchjoin.op9_similarity,
        "op10_nearest": nearest.op10_nearest,
        "op11_resampling": resampling.op11_resampling,
        "op12_alignment": alignment.op12_alignment,
        "op13_minhash": minhash.op13_minhash,
    }
