"""The registered queries of this package and their SQL twins."""

from __future__ import annotations

from tabwise.llm import (ann, chat, collocations, decontaminate, infill, licenses, mixing, neardup, packing, quality,
                         repeats, secrets, toxicity)

QUERIES = {
    "op1_toxicity": toxicity.query,
    "op2_quality": quality.query,
    "op3_secret_scan": secrets.query,
    "op4_repeat_removal": repeats.query,
    "op5_license_scan": licenses.query,
    "op6_near_duplicates": neardup.query,
    "op7_chat_format": chat.query,
    "op8_nearest": ann.query,
    "op9_source_mix": mixing.query,
    "op10_decontaminate": decontaminate.query,
    "op11_fill_in_middle": infill.query,
    "op12_pack": packing.query,
    "op13_collocations": collocations.query,
}

#: Where SQL can express the result, and is fast enough on whole tables.
ORACLES = {
    "op4_repeat_removal": repeats.ORACLE,
    "op6_near_duplicates": neardup.ORACLE,
    "op7_chat_format": chat.ORACLE,
    "op9_source_mix": mixing.ORACLE,
    "op10_decontaminate": decontaminate.ORACLE,
    "op11_fill_in_middle": infill.ORACLE,
    "op13_collocations": collocations.ORACLE,
}
