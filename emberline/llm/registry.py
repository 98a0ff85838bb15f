"""Queries of the training-data operators, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from emberline.llm import bpe, brown, collocations, exact_dedup, fuzzy_lines, minhash, packing, page_text, quality_lines, repeats, token_counts, warc, whitening

QUERIES = {
    "op1_fuzzy_lines": fuzzy_lines.op1_fuzzy_lines,
    "op2_quality_rules": quality_lines.op2_quality_rules,
    "op3_minhash": minhash.op3_minhash,
    "op4_bpe": bpe.op4_bpe,
    "op5_brown_lm": brown.op5_brown_lm,
    "op6_best_fit_packing": packing.op6_best_fit_packing,
    "op7_exact_dedup": exact_dedup.op7_exact_dedup,
    "op8_warc": warc.op8_warc,
    "op9_suffix_array": repeats.op9_suffix_array,
    "op10_edit_counts": token_counts.op10_edit_counts,
    "op11_page_text": page_text.op11_page_text,
    "op12_whitening": whitening.op12_whitening,
    "op13_collocations": collocations.op13_collocations,
}

ORACLES = {
    "op7_exact_dedup": exact_dedup.ORACLE,
    "op8_warc": warc.ORACLE,
    "op13_collocations": collocations.ORACLE,
}
