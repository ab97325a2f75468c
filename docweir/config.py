"""Settings, checked as a whole before a run."""

from __future__ import annotations

import hashlib
import hmac
import re
from dataclasses import dataclass

# Dimensions that embeddings may have, and positions of the embedder.
DIMENSIONS = (384, 768, 1024)
POSITIONS = 512


@dataclass(frozen=True)
class Settings:
    """Limits of a run; invalid ones are refused together, with all reasons."""

    embedding_dimensions: int = 1024
    embedding_batch: int = 16
    chunk_tokens: int = 420
    overlap_tokens: int = 40
    deletion_floor: int = 1
    failure_budget: int = 5
    overlap_minutes: int = 5
    lease_seconds: int = 900

    def __post_init__(self) -> None:
        faults = [
            message
            for bad, message in (
                (self.embedding_dimensions not in DIMENSIONS, f"dimensions must be one of {DIMENSIONS}"),
                (not 1 <= self.embedding_batch <= 64, "a batch holds 1 to 64 texts"),
                (not 1 <= self.chunk_tokens <= 480, "a chunk has 1 to 480 tokens"),
                (not 0 <= self.overlap_tokens < self.chunk_tokens, "the overlap is less than a chunk"),
                (self.deletion_floor < 1, "the deletion floor is 1 or more"),
                (self.failure_budget < 1, "the failure budget is 1 or more"),
                (self.overlap_minutes < 0 or self.lease_seconds < 1, "times can't be negative"),
            )
            if bad
        ]
        if faults:
            raise ValueError("; ".join(faults))


def targeted_keys(keys: list[str], most: int = 10) -> list[str]:
    """Issue keys of a targeted run: well-formed, few, and of one project."""
    if not 0 < len(keys) <= most or any(not re.fullmatch(r"[A-Z][A-Z0-9]+-\d+", k) for k in keys) or len({k.rpartition("-")[0] for k in keys}) > 1:
        raise ValueError(f"1 to {most} well-formed keys of one project can be asked for")
    return keys


def signed_by(secret: bytes, body: bytes, header: str | None) -> bool:
    """Whether a webhook's header is the HMAC of its body; compared in constant time."""
    return hmac.compare_digest("sha256=" + hmac.new(secret, body, hashlib.sha256).hexdigest(), header or "")
