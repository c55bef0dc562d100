"""Range bars over a stream of ticks, with the same labeller and its state per session."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.config import DAY, DEFAULT, BarConfig
from ..operators.bars import Labeller

STATE = "high double, low double, close double, bar int, seq int"
OUT = "contract string, trade_date date, id long, Price double, AskVolume long, BidVolume long, bar_idx int, seq int, is_open boolean, is_change boolean"


def label_stream(ticks: DataFrame, config: BarConfig = DEFAULT) -> DataFrame:
    """Labelled ticks of a stream; ticks of a session must arrive in batches of rising id.

    The state of a session is five numbers, so the state store stays as small as the number of sessions.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        labeller = Labeller(config.bar_range)
        if state.exists:
            labeller.key = key
            labeller.high, labeller.low, labeller.close, labeller.bar, labeller.seq = state.get
        frame = pd.concat(list(frames)).sort_values("id", kind="stable")
        bars, seq, opens, changes = labeller.feed(key, frame["Price"].tolist())
        state.update((labeller.high, labeller.low, labeller.close, labeller.bar, labeller.seq))
        yield frame.assign(bar_idx=bars, seq=seq, is_open=opens, is_change=changes)

    flow = ticks.select("contract", "trade_date", "id", "Price", "AskVolume", "BidVolume")
    return flow.groupBy(*DAY).applyInPandasWithState(step, OUT, STATE, "append", GroupStateTimeout.NoTimeout)
