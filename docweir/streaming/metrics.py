"""Counters and histograms of a run, collected in the pass that does the work."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

# Bounds of the histograms, in seconds.
SCOPE_SECONDS = (0.1, 0.5, 1, 2.5, 5, 10, 30, 60, 120, 300, 600, 1200, 3600)
STAGE_SECONDS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1, 2.5, 5, 10, 30, 60, 120, 300)
OPERATIONS = ("INDEX", "SKIP", "DELETE")
PROVIDERS = ("CONFLUENCE", "JIRA", "GITHUB", "LOCAL")
OTHER = "OTHER"


def counters(providers: Iterable[str] = PROVIDERS) -> list[Column]:
    """Documents by provider and operation, and chunks by provider, of rows (provider, operation, chunk_count); other providers are one."""
    known = list(providers)
    of = lambda p: ~F.col("provider").isin(known) if p == OTHER else F.col("provider") == p
    out = [F.count_if(of(p) & (F.col("operation") == o)).alias(f"documents|{p}|{o}") for p in [*known, OTHER] for o in OPERATIONS]
    return out + [F.coalesce(F.sum(F.when(of(p) & (F.col("operation") == "INDEX"), F.col("chunk_count"))), F.lit(0)).alias(f"chunks|{p}|INDEX") for p in [*known, OTHER]]


def histogram(name: str, value: Column, bounds: Iterable[float] = STAGE_SECONDS) -> list[Column]:
    """How many values are at most each bound, how many there are, and their sum."""
    return [*(F.count_if(value <= b).alias(f"{name}|le|{b:g}") for b in bounds), F.count(value).alias(f"{name}|le|+Inf"), F.coalesce(F.sum(value), F.lit(0)).cast("double").alias(f"{name}|sum|")]


class Meter(StreamingQueryListener):
    """Sums of what passes observed, of batches and, as a listener, of streams. names are those of streams' observations that count."""

    def __init__(self, names: Iterable[str] = ()) -> None:
        self.names, self.totals, self.open = set(names), Counter(), []

    def observed(self, rows: DataFrame, *more: Column) -> DataFrame:
        """rows of a batch, counted as they pass."""
        observation = Observation()
        self.open.append(observation)
        return rows.observe(observation, *(more or counters()))

    def close(self) -> dict[str, float]:
        """Adds what batches have passed since, and returns all sums. Each observed batch must have run."""
        for observation in self.open:
            self.add(observation.get)
        self.open = []
        return dict(self.totals)

    def add(self, values: dict[str, float]) -> None:
        self.totals.update({k: v for k, v in values.items() if v})

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        for name, row in event.progress.observedMetrics.items():
            if name in self.names:
                self.add(row.asDict())

    def onQueryTerminated(self, event) -> None:
        pass

    def exposition(self) -> str:
        """All sums in the text format that metric collectors read."""
        lines = []
        for key, value in sorted(self.totals.items()):
            name, label, mark = key.split("|")
            if label == "le":
                lines.append(f'{name}_bucket{{le="{mark}"}} {value:g}')
            elif label == "sum":
                lines.append(f"{name}_sum {value:g}")
            else:
                lines.append(f'{name}_total{{provider="{label}",operation="{mark}"}} {value:g}')
        return "\n".join([*lines, ""])
