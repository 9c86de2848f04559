"""A ledger of lost source offsets (S3).

With ``failOnDataLoss=false`` a topic whose oldest records were deleted goes on
without them, and nothing says so.  Every progress report of a query names the
offsets at which a batch began and ended.  Two things show a loss: a batch that
begins after the end of the one before, and a batch that spans more offsets
than it read rows (deleted while it was due; compacted or transactional topics
have such spans by nature).  Both are kept here, per query, topic and partition.
"""

from __future__ import annotations

import json
import logging
from collections import deque
from collections.abc import Callable
from dataclasses import dataclass

from .runner import StreamingQueryListener

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Gap:
    """Offsets from ``first`` up to, not including, ``last`` that no batch
    began with; or, with ``partition`` None, ``last - first`` rows that the
    spanned offsets of a batch do not account for."""

    query: str
    batch: int
    topic: str
    partition: int | None
    first: int
    last: int

    @property
    def lost(self) -> int:
        return self.last - self.first


def _offsets(value) -> dict[tuple[str, int], int]:
    """{"topic": {"0": 12}} -> {(topic, partition): offset}; other sources: none."""
    if isinstance(value, str):
        try:
            value = json.loads(value)
        except ValueError:
            return {}
    if not isinstance(value, dict):
        return {}
    return {(t, int(p)): int(o) for t, parts in value.items() if isinstance(parts, dict) for p, o in parts.items() if str(p).isdigit()}


class OffsetLedger(StreamingQueryListener):
    """Follows the progress of queries; ``gaps`` holds the losses found, the
    last 10,000 of them, and ``on_gap`` is told of each.  Memory is one offset
    per query and partition."""

    def __init__(self, on_gap: Callable[[Gap], None] | None = None, spans: bool = True):
        self.gaps: deque[Gap] = deque(maxlen=10_000)
        self.ends: dict[tuple[str, int], dict[tuple[str, int], int]] = {}
        self.on_gap, self.spans = on_gap, spans

    def record(self, progress: dict) -> list[Gap]:
        """Take one progress report (as a dictionary); returns its losses."""
        query, batch, found = progress.get("name") or str(progress.get("id")), int(progress["batchId"]), []
        for i, source in enumerate(progress.get("sources", [])):
            start, end = _offsets(source.get("startOffset")), _offsets(source.get("endOffset"))
            known = self.ends.setdefault((query, i), {})
            for (topic, part), first in sorted(start.items()):
                before = known.get((topic, part))
                if before is not None and first > before:
                    found.append(Gap(query, batch, topic, part, before, first))
            spanned = sum(end[k] - start[k] for k in end if k in start)
            rows = source.get("numInputRows")
            if self.spans and start and rows is not None and all(k in start for k in end) and spanned > int(rows):
                found.append(Gap(query, batch, ",".join(sorted({t for t, _ in end})), None, int(rows), spanned))
            known.update(end)
        for gap in found:
            log.warning("query %s batch %s: %s offsets of %s lost", gap.query, gap.batch, gap.lost, gap.topic)
            self.gaps.append(gap)
            if self.on_gap:
                self.on_gap(gap)
        return found

    def onQueryStarted(self, event) -> None:  # noqa: N802 - Spark listener API
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        self.record(json.loads(event.progress.json))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass
