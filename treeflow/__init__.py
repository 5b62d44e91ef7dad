"""Analytics over very large tree-shaped documents, as Spark DataFrame operators."""

from __future__ import annotations

import importlib

__version__ = "0.1.0"

#: public name -> module; loaded when first asked for, so that workers import only what they run
_PUBLIC = {
    **dict.fromkeys(("flatten", "envelopes", "assets", "serialise"), "operators.flatten"),
    **dict.fromkeys(("skeleton", "find_node", "count_nodes", "subtree_sizes", "rolled_up", "signals"), "operators.measure"),
    **dict.fromkeys(("collect_frontier", "batches", "with_answers", "returned", "numbered"), "operators.frontier"),
    **dict.fromkeys(("split_plan", "oversized_leaves", "shallow_parts"), "operators.budget"),
    **dict.fromkeys(("graft", "graft_tree", "index_parts", "merge_assets", "missing_ids", "missing_preview", "part_entries", "reconstruct"), "operators.graft"),
    **dict.fromkeys(("complete_groups", "content_key", "split_by_resume"), "operators.resume"),
    **dict.fromkeys(("PRESETS", "TIERS", "Strategy", "classify", "strategy_for", "with_strategy"), "plans.sizing"),
    **dict.fromkeys(("counters", "differing", "faults"), "plans.manifest"),
    **dict.fromkeys(("Folder", "SharedStore", "Store", "frontier_of", "join_parts", "run_document", "run_documents"), "plans.job"),
    **dict.fromkeys(("Client", "TokenBucket", "fixture_transport", "http_transport", "register"), "sources.remote"),
    **dict.fromkeys(("read_json_document", "read_manifest", "read_parts", "write_documents", "write_parts"), "sources.workdir"),
    **dict.fromkeys(("resolve_network",), "config"),
    **dict.fromkeys(("AuthError", "NetworkError", "NotFoundError", "RateLimitError", "RemoteError", "RequestTimeout", "ServerError"), "errors"),
    "key_in": "cli",
}
__all__ = sorted(_PUBLIC)


def __getattr__(name: str):
    if name not in _PUBLIC:
        raise AttributeError(f"module {__name__!r} has no attribute {name!r}")
    return getattr(importlib.import_module(f"{__name__}.{_PUBLIC[name]}"), name)
