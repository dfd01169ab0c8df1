"""The queries of this package and their SQL, by name."""

from __future__ import annotations

from . import chat, decontaminate, fingerprints, licenses, media, neardup, packing, periodic, prefixtrie, secrets, sharding, toxicity, urlfilter
from .oracles import ORACLES

QUERIES = {
    "op1_url_filters": urlfilter.op1_url_filters,
    "op2_secret_scans": secrets.op2_secret_scans,
    "op3_benchmark_decontamination": decontaminate.op3_benchmark_decontamination,
    "op4_sharding": sharding.op4_sharding,
    "op5_license_scans": licenses.op5_license_scans,
    "op6_best_fit_packing": packing.op6_best_fit_packing,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_minhash_near_dedup": neardup.op8_minhash_near_dedup,
    "op9_media_columns": media.op9_media_columns,
    "op10_chat_formatting": chat.op10_chat_formatting,
    "op11_conversation_prefix_trie": prefixtrie.op11_conversation_prefix_trie,
    "op12_periodic_run_detection": periodic.op12_periodic_run_detection,
    "op13_document_fingerprints": fingerprints.op13_document_fingerprints,
}

__all__ = ["ORACLES", "QUERIES"]
