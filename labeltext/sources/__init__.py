"""Readers, writers and stores."""

from labeltext.sources.models import (
    load_classes,
    load_encoders,
    load_model,
    save_encoders,
    save_model,
)
from labeltext.sources.store import ArtifactStore
from labeltext.sources.tables import read_corpus, read_posts, write_corpus, write_report

__all__ = [
    "ArtifactStore", "load_classes", "load_encoders", "load_model", "read_corpus", "read_posts",
    "save_encoders", "save_model", "write_corpus", "write_report",
]
