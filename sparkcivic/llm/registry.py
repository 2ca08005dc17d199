"""Registry of the queries of this subpackage: name -> (callable, SQL or None)."""

from __future__ import annotations

from . import q_chat, q_decontaminate, q_html, q_jaccard, q_langid, q_negatives, q_packing, q_pii, q_quality, q_repeats, q_secrets, \
    q_spelling, q_topk

_MODULES = [q_jaccard, q_html, q_secrets, q_topk, q_chat, q_decontaminate, q_quality, q_pii, q_langid, q_packing, q_spelling,
            q_negatives, q_repeats]


def queries() -> dict:
    return {m.NAME: m.query for m in _MODULES}


def oracle_sql() -> dict[str, str]:
    return {m.NAME: m.SQL for m in _MODULES if m.SQL is not None}
