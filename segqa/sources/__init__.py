from .captions import (
    adapt_external_segments,
    caption_segments,
    explode_captions,
    unmatched_urls,
)
from .documents import (
    dataset_pairs,
    read_dataset,
    read_document_frames,
    read_document_pairs,
    read_flat,
    read_splits_json,
)
from .videos import (
    filter_video_paths,
    parse_probe,
    process_videos,
    scan_videos,
    video_manifest,
)

__all__ = [
    "adapt_external_segments",
    "caption_segments",
    "dataset_pairs",
    "explode_captions",
    "filter_video_paths",
    "parse_probe",
    "process_videos",
    "read_dataset",
    "read_document_frames",
    "read_document_pairs",
    "read_flat",
    "read_splits_json",
    "scan_videos",
    "unmatched_urls",
    "video_manifest",
]
