"""The queries of this subpackage and, where SQL can express one, its DuckDB text."""
from __future__ import annotations

import corpus_pipeline
from stride.llm.bpe import op7_bpe
from stride.llm.chat import op8_chat_format
from stride.llm.decontaminate import op2_decontaminate
from stride.llm.fingerprint import op6_fingerprint
from stride.llm.language import op10_language
from stride.llm import lexical, line_dedup, near_dedup, orchard
from stride.llm.lexical import op13_lexical_search
from stride.llm.line_dedup import op4_line_dedup
from stride.llm.mixing import op12_mix_sources
from stride.llm.near_dedup import op5_near_dedup
from stride.llm.orchard import op11_orchard_codes
from stride.llm.pii import op3_pii
from stride.llm.secrets import op9_secrets
from stride.llm.toxicity import op1_toxicity

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_decontaminate": op2_decontaminate,
    "op3_pii": op3_pii,
    "op4_line_dedup": op4_line_dedup,
    "op5_near_dedup": op5_near_dedup,
    "op6_fingerprint": op6_fingerprint,
    "op7_bpe": op7_bpe,
    "op8_chat_format": op8_chat_format,
    "op9_secrets": op9_secrets,
    "op10_language": op10_language,
    "op11_orchard_codes": op11_orchard_codes,
    "op12_mix_sources": op12_mix_sources,
    "op13_lexical_search": op13_lexical_search,
    "pipeline": corpus_pipeline.run,
}

ORACLE: dict[str, str] = {
    "op4_line_dedup": line_dedup.ORACLE_SQL,
    "op5_near_dedup": near_dedup.ORACLE_SQL,
    "op11_orchard_codes": orchard.ORACLE_SQL,
    "op13_lexical_search": lexical.ORACLE_SQL,
}
