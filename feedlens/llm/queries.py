"""Registered queries of this package and their SQL, where SQL can express them."""

from __future__ import annotations

from feedlens.llm.conversations import SQL as CONVERSATION_SQL
from feedlens.llm.conversations import op13_conversation_repair
from feedlens.llm.decontaminate import op2_decontamination
from feedlens.llm.fingerprint import op1_fingerprints
from feedlens.llm.html_text import op6_html_text
from feedlens.llm.licenses import SQL as LICENSE_SQL
from feedlens.llm.licenses import op12_license_scan
from feedlens.llm.lm_scoring import op7_lm_scores
from feedlens.llm.near_dedup import op10_near_duplicates
from feedlens.llm.packing import op3_packing
from feedlens.llm.quality import op5_quality
from feedlens.llm.resample import SQL as RESAMPLE_SQL
from feedlens.llm.resample import op11_resample
from feedlens.llm.secrets import op8_secret_scan
from feedlens.llm.sharding import op9_sharding
from feedlens.llm.subwords import op4_token_counts

QUERIES = {f.__name__: f for f in (
    op1_fingerprints, op2_decontamination, op3_packing, op4_token_counts, op5_quality,
    op6_html_text, op7_lm_scores, op8_secret_scan, op9_sharding, op10_near_duplicates, op11_resample,
    op12_license_scan, op13_conversation_repair)}
ORACLE: dict[str, str] = {"op11_resample": RESAMPLE_SQL, "op12_license_scan": LICENSE_SQL,
                          "op13_conversation_repair": CONVERSATION_SQL}
