"""Developing volume profiles of a day or week: POC, high-volume node and value area at every bar close."""

from __future__ import annotations

from bisect import insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions.config import DEFAULT, BarConfig

OUT = "contract string, trade_date date, bar_idx int, poc double, hvn double, vah double, val double, profile_total long"


class Profile:
    """Volume by price index, as far as a day or week has come."""

    def __init__(self, share: float):
        self.share, self.prices, self.volume, self.total = share, [], {}, 0

    def add(self, price: int, volume: int) -> None:
        if price in self.volume:
            self.volume[price] += volume
        else:
            insort(self.prices, price)
            self.volume[price] = volume
        self.total += volume

    def nodes(self) -> tuple[int | None, int | None]:
        """The prices of most and second most volume, lower ones first on ties; None without volume."""
        best = second = None
        v1 = v2 = 0
        for p in self.prices:
            v = self.volume[p]
            if v > v1:
                best, second, v1, v2 = p, best, v, v1
            elif v > v2:
                second, v2 = p, v
        return best, second

    def value_area(self, poc: int | None) -> tuple[int, int]:
        """Lowest and highest price of the walk from the POC, one level a step to the side of more volume, down on ties,
        until the share of the volume is reached or both sides are without volume."""
        prices, volume = self.prices, self.volume
        i = j = prices.index(poc) if poc is not None else 0
        got, target = volume[prices[i]], int(self.total * self.share)
        while got < target:
            up = volume[prices[j + 1]] if j + 1 < len(prices) else 0
            down = volume[prices[i - 1]] if i > 0 else 0
            if up == 0 and down == 0:
                break
            if up > down:
                j, got = j + 1, got + up
            else:
                i, got = i - 1, got + down
        return prices[i], prices[j]


def developing(levels: DataFrame, bars: DataFrame, scope: list[str], config: BarConfig = DEFAULT) -> DataFrame:
    """Per closed bar: poc, hvn, vah, val and total of all levels of the scope up to this bar.

    ``scope``: the columns that name the profile, such as contract and trade_date, or contract and week_no. The levels of
    a scope, sorted by bar, flow through one pass that keeps one number per price; a grid of bars times prices, which is
    what windows would need, never comes to be.
    """
    tick, share = config.tick, config.value_area
    volume = levels.select("contract", "trade_date", "bar_idx", F.round(F.col("price") / tick).cast("long").alias("p"), (F.col("bidVolume") + F.col("askVolume")).alias("v"))
    wide = volume.join(bars.select(*dict.fromkeys([*scope, "contract", "trade_date", "bar_idx"]), "closed"), ["contract", "trade_date", "bar_idx"])
    name = F.to_json(F.struct(*scope)) if scope != ["contract", "trade_date"] else F.concat_ws(" ", *scope)
    flow = wide.select(name.alias("scope"), "contract", "trade_date", "bar_idx", "closed", "p", "v").repartition("scope").sortWithinPartitions("scope", "trade_date", "bar_idx")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = bar = profile = None
        out: list[tuple] = []

        def close() -> None:
            if bar is not None and bar[3]:
                poc, hvn = profile.nodes()
                low, high = profile.value_area(poc)
                out.append((*bar[:3], (poc or 0) * tick, (hvn or 0) * tick, high * tick, low * tick, profile.total))

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [c.to_pylist() for c in batch.columns]
            for scope_, contract, day, idx, closed, p, v in zip(*cols):
                here = (contract, day, idx, closed)
                if here != bar or scope_ != key:
                    close()
                    bar = here
                    if scope_ != key:
                        key, profile = scope_, Profile(share)
                profile.add(p, v)
            yield _batch(out)
            out.clear()
        close()
        yield _batch(out)

    return flow.mapInArrow(run, OUT)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.date32(), pa.int32(), *[pa.float64()] * 4, pa.int64()]
    cols = list(zip(*rows)) if rows else [[]] * 8
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], names=[c.split()[0] for c in OUT.split(", ")])
