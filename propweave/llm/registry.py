"""The corpus queries, and DuckDB SQL for those that SQL can express."""

from propweave.llm import bpe, decontamination, language, licenses, line_dedup, mixing, ngram_join, quality, toxicity, warc


def queries() -> dict:
    return {
        "op1_context_mixing": mixing.op1_context_mixing,
        "op2_warc": warc.op2_warc,
        "op3_byte_bpe": bpe.op3_byte_bpe,
        "op4_language": language.op4_language,
        "op5_toxicity": toxicity.op5_toxicity,
        "op6_line_dedup": line_dedup.op6_line_dedup,
        "op7_decontamination": decontamination.op7_decontamination,
        "op8_ngram_join": ngram_join.op8_ngram_join,
        "op9_host_rules": quality.op9_host_rules,
        "op10_licenses": licenses.op10_licenses,
    }


def oracle_sql() -> dict:
    return {"op2_warc": warc.SQL, "op8_ngram_join": ngram_join.SQL, "op9_host_rules": quality.SQL}
