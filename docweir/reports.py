"""Reports of a run: whole or absent, and chained so that none can be changed unseen."""

from __future__ import annotations

import hashlib
import json
import os
import tempfile
from collections.abc import Iterable
from pathlib import Path


def write_report(path: str | Path, report: dict) -> None:
    """Writes a report so that a reader finds the old one or the new one, never a part."""
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    handle, draft = tempfile.mkstemp(dir=target.parent, prefix=f".{target.name}.")
    try:
        with os.fdopen(handle, "w", encoding="utf-8") as file:
            json.dump(report, file, ensure_ascii=False, sort_keys=True, indent=1)
            file.flush()
            os.fsync(file.fileno())
        os.replace(draft, target)
    except BaseException:
        Path(draft).unlink(missing_ok=True)
        raise


def contract(**parts: object) -> dict:
    """What a run was started with, and a digest of it. A resumed run must have the same digest."""
    text = json.dumps(parts, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    return {**parts, "digest": hashlib.sha256(text.encode()).hexdigest()}


def chained(events: Iterable[dict], before: str = "") -> list[dict]:
    """Events, each with the digest of itself and of the one before it."""
    out = []
    for event in events:
        before = hashlib.sha256((before + json.dumps(event, ensure_ascii=False, sort_keys=True)).encode()).hexdigest()
        out.append({**event, "chain": before})
    return out


def first_broken(events: list[dict]) -> int | None:
    """The place of the first event whose chain doesn't hold, or None."""
    expected = chained({k: v for k, v in e.items() if k != "chain"} for e in events)
    return next((i for i, (e, x) in enumerate(zip(events, expected)) if e.get("chain") != x["chain"]), None)
