"""Depth over reads that arrive sorted by position: closed positions leave the state."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def sorted_depth(reads: DataFrame) -> DataFrame:
    """(rna, sample, pos, depth) of a stream of reads (rna, sample, left, right), sorted by left within rna and sample.

    A position is given out once, when a batch's largest left end lies beyond
    it; the state holds the positions from there to the largest right end only.
    Reads' places behind that point are dropped. A row with null ends and a
    known rna and sample closes all positions that are open. A batch's rows
    may come in any order.
    """

    def count(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        low, open_depth = state.get if state.exists else (None, [])
        depth = np.array(open_depth, np.int64)
        most, close = low, False
        for rows in chunks:
            close = close or bool(rows["left"].isna().any())
            rows = rows.dropna(subset=["left", "right"])
            if rows.empty:
                continue
            left, right = rows["left"].to_numpy(np.int64), rows["right"].to_numpy(np.int64)
            if low is None:
                low = most = int(left.min())
            elif state.exists is False and left.min() < low:  # the first batch has no closed positions yet
                depth, low = np.concatenate([np.zeros(low - left.min(), np.int64), depth]), int(left.min())
            most = max(most, int(left.max()))
            left, stop = np.maximum(left, low), right + 1
            left, stop = left[left < stop], stop[left < stop]
            if len(left):
                size = max(len(depth), int(stop.max()) - low)
                steps = np.bincount(left - low, minlength=size + 1) - np.bincount(stop - low, minlength=size + 1)
                depth = np.pad(depth, (0, size - len(depth))) + np.cumsum(steps)[:size]
        if low is None:
            return
        done = len(depth) if close else min(len(depth), most - low)
        pos = np.arange(low, low + done)
        seen = depth[:done] > 0
        state.update((low + done if close else max(most, low), depth[done:].tolist()))
        yield pd.DataFrame({"rna": key[0], "sample": key[1], "pos": pos[seen].astype(np.int32), "depth": depth[:done][seen]})

    out = "rna string, sample string, pos int, depth long"
    return reads.groupBy("rna", "sample").applyInPandasWithState(count, out, "low long, depth array<long>", "append", GroupStateTimeout.NoTimeout)
