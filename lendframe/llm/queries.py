"""Registered queries of this subpackage and their SQL, where SQL can express them."""

import corpus_pipeline
from lendframe.llm import ann, exact, interpolation, langid, minhash, mixing, negatives, packing, quality, sharding, substrings, whitening, windows

QUERIES = {
    "op1_packing": packing.op1_packing,
    "op2_quality": quality.op2_quality,
    "op3_substrings": substrings.op3_substrings,
    "op4_mixing": mixing.op4_mixing,
    "op5_interpolation": interpolation.op5_interpolation,
    "op6_langid": langid.op6_langid,
    "op7_minhash": minhash.op7_minhash,
    "op8_exact": exact.op8_exact,
    "op9_ann": ann.op9_ann,
    "op10_sharding": sharding.op10_sharding,
    "op11_windows": windows.op11_windows,
    "op12_negatives": negatives.op12_negatives,
    "op13_whitening": whitening.op13_whitening,
    "pipeline": corpus_pipeline.run,
}

ORACLE = {"op4_mixing": mixing.OP4_SQL, "op8_exact": exact.OP8_SQL, "op11_windows": windows.OP11_SQL, "op12_negatives": negatives.OP12_SQL}
