from .writers import (
    dataset_info,
    write_dataset_info,
    write_document,
    write_flat,
    write_splits_json,
)

__all__ = [
    "dataset_info",
    "write_dataset_info",
    "write_document",
    "write_flat",
    "write_splits_json",
]
