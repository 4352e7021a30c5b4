"""Document tables: keyed change log with merge-on-read and compaction (K1-K4)."""

from .doc_table import DocumentTable, DocumentStore

__all__ = ["DocumentTable", "DocumentStore"]
