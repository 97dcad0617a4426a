from .inference import (
    ChatRequest,
    Outage,
    attach_responses,
    call_report,
    chat_requests,
    dedup_prompts,
    infer_batch,
    prompt_hash,
    request_id,
)
from .packing import pack_captions
from .pairs import (
    attach_video,
    complete_pairs,
    context_dependent_only,
    flatten_pairs,
    generate_qa,
    min_confidence,
    validate_qa,
    with_confidence,
    with_source_document,
)
from .quality import flag_errors, quarantine, require_rows, validate_rows
from .responses import ResponseLog
from .splits import (
    DEFAULT_SPLITS,
    SplitConfig,
    assign_split,
    expand_splits,
    known_split,
    nest_splits,
    ratio_threshold,
    split_config,
    union_splits,
)
from .stats import analyze_dataset, analyze_documents, dataset_totals, pair_counts, split_stats, stats_report
from .timeline import (
    consecutive_segments,
    implausible_videos,
    plausible_duration,
    segments_with_fallback,
    usable_videos,
)

__all__ = [
    "ChatRequest",
    "DEFAULT_SPLITS",
    "Outage",
    "ResponseLog",
    "SplitConfig",
    "analyze_dataset",
    "analyze_documents",
    "assign_split",
    "attach_responses",
    "attach_video",
    "call_report",
    "chat_requests",
    "complete_pairs",
    "consecutive_segments",
    "context_dependent_only",
    "dataset_totals",
    "dedup_prompts",
    "expand_splits",
    "flag_errors",
    "flatten_pairs",
    "generate_qa",
    "implausible_videos",
    "infer_batch",
    "known_split",
    "min_confidence",
    "nest_splits",
    "pack_captions",
    "pair_counts",
    "plausible_duration",
    "prompt_hash",
    "quarantine",
    "ratio_threshold",
    "request_id",
    "require_rows",
    "segments_with_fallback",
    "split_config",
    "split_stats",
    "stats_report",
    "union_splits",
    "usable_videos",
    "validate_qa",
    "validate_rows",
    "with_confidence",
    "with_source_document",
]
