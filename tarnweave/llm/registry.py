"""Queries of this subpackage and the SQL that they are checked with."""

from __future__ import annotations

import corpus_pipeline

from . import alignment, chatformat, collocations, decontaminate, langid, lmscore, neighbours, ngramjoin, pieces, pii, qualityrules, resample, suffixdedup


def queries() -> dict:
    return {
        "op1_ngram_jaccard_join": ngramjoin.op1_ngram_jaccard_join,
        "op2_sentencepiece": pieces.op2_sentencepiece,
        "op3_pii": pii.op3_pii,
        "op4_lm_scoring": lmscore.op4_lm_scoring,
        "op5_language_id": langid.op5_language_id,
        "op6_chat_formatting": chatformat.op6_chat_formatting,
        "op7_suffix_array_dedup": suffixdedup.op7_suffix_array_dedup,
        "op8_decontamination": decontaminate.op8_decontamination,
        "op9_quality_classifier": resample.op9_quality_classifier,
        "op10_quality_rules": qualityrules.op10_quality_rules,
        "op11_phrase_collocations": collocations.op11_phrase_collocations,
        "op12_tokenizer_alignment": alignment.op12_tokenizer_alignment,
        "op13_nearest_neighbours": neighbours.op13_nearest_neighbours,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op6_chat_formatting": chatformat.OP6_SQL,
        "op10_quality_rules": qualityrules.OP10_SQL,
        "op11_phrase_collocations": collocations.OP11_SQL,
    }
