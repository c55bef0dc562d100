"""The fold of a trading episode: actions against a series of closes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def fold(steps: DataFrame, initial: float = 10_000.0) -> DataFrame:
    """(series, step, balance, shares, net_worth, reward, done, next_close) of every act.

    ``steps`` has series, step (from 0), Close and action in [-1, 1]: a > 0 spends that share of the balance, a < 0 sells
    that share of the holding. The last step of a series only ends the episode. A series is one episode, whose state is
    sequential, so it is folded in one task, as rows in order.
    """
    from collections.abc import Iterator

    import pyarrow as pa

    schema = "series long, step long, balance double, shares double, net_worth double, reward double, done boolean, next_close double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, before = None, None
        for batch in batches:
            out = []
            for series, step, close, action in zip(*(c.to_pylist() for c in batch.columns)):
                if series != key:
                    key, before, balance, shares = series, None, initial, 0.0
                if before is not None:
                    step0, price, a = before
                    if a > 0:
                        spent = balance * a
                        balance, shares = balance - spent, shares + spent / price
                    elif a < 0:
                        sold = shares * -a
                        balance, shares = balance + sold * price, shares - sold
                    worth = balance + shares * price
                    out.append((series, step0, balance, shares, worth, worth - initial, False, close))
                before = (step, close, action)
            cols = list(zip(*out)) if out else [[]] * 8
            types = [pa.int64(), pa.int64(), *[pa.float64()] * 4, pa.bool_(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], names=[c.split()[0] for c in schema.split(", ")])

    flow = steps.select(F.col("series").cast("long"), F.col("step").cast("long"), F.col("Close").cast("double"), F.col("action").cast("double")).repartition("series").sortWithinPartitions("series", "step")
    last = steps.groupBy(F.col("series").cast("long").alias("series")).agg((F.max("step") - 1).cast("long").alias("last"))
    folded = flow.mapInArrow(run, schema).drop("done").join(last, "series")
    return folded.select("series", "step", "balance", "shares", "net_worth", "reward", (F.col("step") >= F.col("last")).alias("done"), "next_close")
