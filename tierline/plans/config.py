"""Settings of a pipeline run."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from tierline import trips
from tierline.sources.tables import Period, RawInput


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def period_label(periods: Sequence[Period] | None, *more: str) -> str:
    """A folder name for some months, told apart by ``more``."""
    months = ["all"] if periods is None else ["-".join(map(str, p)) for p in periods]
    named = "+".join(months) if len(months) < 4 else f"{len(months)}-months"
    return f"{named}-{hashlib.sha256(repr((months, more)).encode()).hexdigest()[:12]}"


@dataclass(frozen=True)
class PipelineConfig:
    """Paths and settings; the defaults are those of taxi trips.

    ``periods`` limits a run to some months. For silver and gold that is exact: the
    pickup time is part of the trip key and the period derives from it, so
    duplicates never cross periods. Bronze then lands those months only; input
    rows of other months go to ``strays``, and without such a path they stop
    the run before anything of bronze changes. A named month without input rows stops
    it too, unless ``allow_empty`` asks for the month to be emptied. A bronze run
    without ``periods`` replaces every month that its input has a row of; one that
    has fewer rows than are stored stops the run, unless ``allow_shrinking``.
    """

    raw: tuple[RawInput, ...]
    zones: str
    bronze: str
    silver: str
    quarantine: str
    gold: str
    #: One time for all rows of the run, in UTC; give it to repeat a run exactly.
    run_ts: datetime | str = field(default_factory=_now)
    periods: tuple[Period, ...] | None = None
    source_system: str = trips.SOURCE_SYSTEM
    silver_version: str = trips.SILVER_VERSION
    rules: tuple[trips.Rule, ...] = field(default_factory=trips.quality_rules)
    critical_columns: tuple[str, ...] = trips.CRITICAL_COLUMNS
    null_rate_limit: float = trips.NULL_RATE_LIMIT
    #: Share of the rows of a run whose value a cast may change, for each column.
    cast_loss_limit: float = 0.0
    #: Compare the columns of every raw file with its input's schema first.
    check_files: bool = True
    #: Empty the named months that the input has no row of.
    allow_empty: bool = False
    #: Let a run without named months replace a stored month by fewer rows.
    allow_shrinking: bool = False
    database: str | None = None
    #: Table for input rows outside of ``periods``. Each run has its own folder in it,
    #: which a repeat of the run replaces.
    strays: str | None = None
    #: Set where raw files mix many months; costs a shuffle of the raw table.
    rebalance_bronze: bool = False
    #: Rows up to which neighbouring months are cleaned in one batch; a month with more
    #: is a batch of its own.
    batch_rows: int = 2_000_000
    #: Batches that are cleaned at the same time.
    batches_at_once: int = 4
    #: Table of finished steps. A run that is repeated under the same ``run_id`` goes on
    #: after the last of them; without an id nothing is skipped or recorded.
    ledger: str | None = None
    run_id: str | None = None
    #: Print a sample after each layer; an extra read of the layer just written.
    previews: bool = False

    @property
    def run_key(self) -> str:
        """Name of a run by what it lands: equal for a repeat, whenever that is."""
        return period_label(self.periods, *sorted(i.path for i in self.raw))

    @property
    def gold_periods(self) -> tuple[tuple[int | None, int | None], ...] | None:
        if self.periods is None:
            return None
        return tuple(
            (None if y is None else int(y), None if m is None else int(m)) for y, m in self.periods
        )
