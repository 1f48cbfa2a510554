from .changes import append_delta, apply_corrections
from .publish import (
    PublicationClash,
    clear_claims,
    compact,
    publish,
    publish_delta,
    publish_parts,
    published_contents,
    read_newest,
    read_published,
    version_of,
)
from .tables import load_sources, register_views, row_counts, source_rejects
from .tpch import source_model

__all__ = [
    "PublicationClash",
    "append_delta",
    "apply_corrections",
    "clear_claims",
    "compact",
    "load_sources",
    "publish",
    "publish_delta",
    "publish_parts",
    "published_contents",
    "read_newest",
    "read_published",
    "register_views",
    "row_counts",
    "source_model",
    "source_rejects",
    "version_of",
]
