"""The registered queries of this subpackage and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from .chat import OP3_SQL, op3_chat_format
from .ctw import op8_ctw_score
from .decontaminate import op6_decontaminate
from .divergence import OP12_SQL, op12_divergence
from .embedding_dedup import op2_embedding_dedup
from .minhash_dedup import op10_minhash_dedup
from .mixing import OP5_SQL, op5_mix_sources
from .nearest import op13_nearest
from .pii import op4_pii_spans
from .repair import OP11_SQL, op11_repair
from .substring_dedup import op9_substring_dedup
from .toxicity import op7_toxicity
from .warc import OP1_SQL, op1_warc_normalise


def queries() -> dict[str, Callable]:
    return {
        "op1_warc_normalise": op1_warc_normalise,
        "op2_embedding_dedup": op2_embedding_dedup,
        "op3_chat_format": op3_chat_format,
        "op4_pii_spans": op4_pii_spans,
        "op5_mix_sources": op5_mix_sources,
        "op6_decontaminate": op6_decontaminate,
        "op7_toxicity": op7_toxicity,
        "op8_ctw_score": op8_ctw_score,
        "op9_substring_dedup": op9_substring_dedup,
        "op10_minhash_dedup": op10_minhash_dedup,
        "op11_repair": op11_repair,
        "op12_divergence": op12_divergence,
        "op13_nearest": op13_nearest,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_warc_normalise": OP1_SQL, "op3_chat_format": OP3_SQL, "op5_mix_sources": OP5_SQL, "op11_repair": OP11_SQL, "op12_divergence": OP12_SQL}
