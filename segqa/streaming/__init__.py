from .streams import (
    STATE_STORE,
    late_captions,
    latest_segments,
    latest_state,
    replace_each_batch,
    state_store,
    stream_pairs,
    stream_segments,
    stream_split_stats,
    write_pairs_stream,
)

__all__ = [
    "STATE_STORE",
    "late_captions",
    "latest_segments",
    "latest_state",
    "replace_each_batch",
    "state_store",
    "stream_pairs",
    "stream_segments",
    "stream_split_stats",
    "write_pairs_stream",
]
