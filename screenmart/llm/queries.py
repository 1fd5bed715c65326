"""The queries of this package and the check SQL of those that SQL can express."""

from __future__ import annotations

from screenmart.llm import bpe, decontaminate, embedding, exact, langid, lines, lm, orc_tokens, phrases, simhash, toxicity, warc_zip, whitening

QUERIES = {
    "op1_langid": langid.op1_langid,
    "op2_warc_zip": warc_zip.op2_warc_zip,
    "op3_lm": lm.op3_lm,
    "op4_simhash": simhash.op4_simhash,
    "op5_orc_tokens": orc_tokens.op5_orc_tokens,
    "op6_decontamination": decontaminate.op6_decontamination,
    "op7_bpe": bpe.op7_bpe,
    "op8_embedding": embedding.op8_embedding,
    "op9_line_dedup": lines.op9_line_dedup,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_collocations": phrases.op11_collocations,
    "op12_exact_dedup": exact.op12_exact_dedup,
    "op13_whitening": whitening.op13_whitening,
}

ORACLE_SQL = {
    "op2_warc_zip": warc_zip.OP2_SQL,
    "op6_decontamination": decontaminate.OP6_SQL,
    "op8_embedding": embedding.OP8_SQL,
    "op9_line_dedup": lines.OP9_SQL,
    "op11_collocations": phrases.OP11_SQL,
    "op12_exact_dedup": exact.OP12_SQL,
}
