"""The registered queries of this subpackage, with SQL counterparts where SQL can express them."""

from __future__ import annotations

from siltline.llm.bpe import op11_bpe_codec
from siltline.llm.chat import OP6_SQL, op6_chat_formatting
from siltline.llm.collocations import OP12_SQL, op12_collocations
from siltline.llm.contamination import OP8_SQL, op8_decontamination
from siltline.llm.infill import OP13_SQL, op13_fill_in_middle
from siltline.llm.mixing import OP2_SQL, op2_mixing
from siltline.llm.neardup import op9_minhash_neardup
from siltline.llm.quality import OP4_SQL, op4_quality_rules
from siltline.llm.sharding import op7_sharding
from siltline.llm.substrings import op5_substring_dedup
from siltline.llm.surrogates import op10_pii_surrogates
from siltline.llm.toxicity import op3_toxicity
from siltline.llm.tokens import op1_token_ids

QUERIES = {
    "op1_token_ids": op1_token_ids,
    "op2_mixing": op2_mixing,
    "op3_toxicity": op3_toxicity,
    "op4_quality_rules": op4_quality_rules,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_sharding": op7_sharding,
    "op8_decontamination": op8_decontamination,
    "op9_minhash_neardup": op9_minhash_neardup,
    "op10_pii_surrogates": op10_pii_surrogates,
    "op11_bpe_codec": op11_bpe_codec,
    "op12_collocations": op12_collocations,
    "op13_fill_in_middle": op13_fill_in_middle,
}

SQL = {
    "op2_mixing": OP2_SQL,
    "op4_quality_rules": OP4_SQL,
    "op6_chat_formatting": OP6_SQL,
    "op8_decontamination": OP8_SQL,
    "op12_collocations": OP12_SQL,
    "op13_fill_in_middle": OP13_SQL,
}
