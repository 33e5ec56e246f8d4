"""Options of the jobs, as frozen dataclasses."""

from __future__ import annotations

from dataclasses import dataclass

MB = 1024 * 1024


@dataclass(frozen=True)
class SearchOptions:
    """Parameters of a search batch."""

    top_k_default: int = 5
    # None sets no upper limit to what a caller asks for.
    top_k_max: int | None = None
    fetch_multiplier: int = 3
    fetch_max: int | None = None
    # A chunk farther away than this is dropped; zero or less turns the filter off.
    distance_threshold: float = 0.30
    lexical_rerank: bool = True
    # None or zero: all chunks of a file, and no budget over the files of a query.
    max_chunks_per_file: int | None = None
    max_total_chunks: int | None = None
    drive_id: str | None = None
    # Query vectors that pass the chunks in one broadcast block.
    query_block_rows: int = 4096

    def clamp_top_k(self, top_k: int | None) -> int:
        k = max(1, top_k or self.top_k_default)
        return min(k, self.top_k_max) if self.top_k_max else k

    def fetch_k(self, top_k: int | None) -> int:
        k = self.clamp_top_k(top_k)
        fetch = max(k * self.fetch_multiplier, k)
        return min(self.fetch_max, fetch) if self.fetch_max else fetch


@dataclass(frozen=True)
class GateOptions:
    """Thresholds of the parse-quality gate."""

    density_threshold: float = 0.0005
    table_loss_ratio: float = 0.3
    min_text_length: int = 20
    mode: str = "log"  # log, reject or fallback
    fallback_enabled: bool = False


@dataclass(frozen=True)
class SyncOptions:
    """Parameters of change planning, state merging and recovery."""

    sync_roots: tuple[str, ...] = ()
    student_roots: tuple[str, ...] = ()
    storage_cap_bytes: int = 150 * MB
    max_changes: int = 200
    index_batch_uris: int = 10
    recovery_batch_uris: int = 24
    import_call_uris: int = 25
    max_attempts: int = 3
    max_pages: int = 50
    # True keeps the stored audience when the content hash did not change,
    # unless the document went through the HWP route.
    legacy_audience: bool = False
