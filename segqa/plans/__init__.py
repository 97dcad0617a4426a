from .build import Dataset, build_dataset, extract_all
from .versions import build_version, current_version, versions

__all__ = ["Dataset", "build_dataset", "build_version", "current_version", "extract_all", "versions"]
