"""Fixed parameters of the registered dashboard queries (one demo selection)."""

from __future__ import annotations

import datetime as _dt

from .operators.selection import Selection

DEMO_SELECTION = Selection(
    types=("click", "error", "purchase"),
    severities=(3, 4, 5),
    date_range=(_dt.date(2024, 1, 5), _dt.date(2024, 1, 20)),
)
TYPES_ONLY = Selection(types=DEMO_SELECTION.types)
SEVERITY_ONLY = Selection(severities=DEMO_SELECTION.severities)
DATES_ONLY = Selection(date_range=DEMO_SELECTION.date_range)

# Dates that the roll-up queries add, change and delete between two refreshes.
ROLLUP_ADDED = _dt.date(2024, 1, 10)
ROLLUP_CHANGED = _dt.date(2024, 1, 12)
ROLLUP_DROPPED = _dt.date(2024, 1, 15)
