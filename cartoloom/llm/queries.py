"""The queries of this package for the entry module, and their SQL where SQL can express them."""

from __future__ import annotations

from . import decontaminate, near_dedup, substring_dedup, topk
from .decontaminate import op9_decontaminate
from .html import op10_main_text
from .katz import op4_katz_scores
from .langid import op8_language_id
from .near_dedup import op1_near_dedup
from .pii import op3_personal_data
from .secrets import op5_secret_scan
from .sentencepiece import op2_sentencepiece
from .substring_dedup import op7_substring_dedup
from .topk import op6_exact_top_k

QUERIES = {
    f.__name__: f
    for f in (
        op1_near_dedup,
        op2_sentencepiece,
        op3_personal_data,
        op4_katz_scores,
        op5_secret_scan,
        op6_exact_top_k,
        op7_substring_dedup,
        op8_language_id,
        op9_decontaminate,
        op10_main_text,
    )
}
ORACLE_SQL: dict[str, str] = {
    "op1_near_dedup": near_dedup.SQL,
    "op6_exact_top_k": topk.SQL,
    "op7_substring_dedup": substring_dedup.SQL,
    "op9_decontaminate": decontaminate.SQL,
}
