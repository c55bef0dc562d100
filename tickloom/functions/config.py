"""Parameters of the bar engine."""

from __future__ import annotations

import dataclasses


@dataclasses.dataclass(frozen=True)
class BarConfig:
    """``parity`` reproduces the quirks of the engine whose results must be matched; without it the intended results."""

    bar_range: float = 2.5
    theta: float = 3.0
    tick: float = 0.25
    value_area: float = 0.70
    bb_period: int = 21
    bb_width: float = 2.4
    rsi_period: int = 14
    z_window: int = 11
    parity: bool = True


DEFAULT = BarConfig()
#: Columns that name a session, in the order in which everything is partitioned.
DAY = ["contract", "trade_date"]
