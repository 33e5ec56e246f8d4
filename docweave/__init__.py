"""Docweave: document-corpus jobs as PySpark DataFrame and Structured Streaming plans."""

from docweave.options import GateOptions, SearchOptions, SyncOptions

__all__ = ["GateOptions", "SearchOptions", "SyncOptions"]
