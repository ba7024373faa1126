"""Answers that arrive as a stream of chunks: emit each new successful reading.

The state of a response is its text so far, which is one answer. A response whose chunks
stop is closed by the timeout; if a chunk is missing, the closing row says which one and carries
what came after it. A closed response stays closed: later chunks of it are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUTPUT = "response_id string, seq long, raw_text string, is_final boolean, gap_at long, after_gap string"
COLUMNS = ["response_id", "seq", "raw_text", "is_final", "gap_at", "after_gap"]
STATE = "text string, next_seq long, waiting map<long,string>, closed boolean"


def _complete(text: str) -> bool:
    return any(text.count(close) > 0 and text.count(close) >= text.count(open_) > 0 for open_, close in ("{}", "[]"))


def prefixes(stream: DataFrame, timeout_ms: int = 60_000) -> DataFrame:
    """(response_id, seq, raw_text, is_final, gap_at, after_gap): prefixes worth reading, from (response_id, seq, chunk).

    Chunks may come out of order; they wait until the ones before them are there. Read the
    result with ``parse_responses``.
    """
    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        text, at, waiting, closed = state.get if state.exists else ("", 0, {}, False)
        waiting = dict(waiting or {})
        if closed:
            return
        if state.hasTimedOut:
            state.update(("", at, {}, True))
            late = "".join(waiting[s] for s in sorted(waiting)) if waiting else None
            yield pd.DataFrame([(key[0], at - 1, text, True, at if waiting else None, late)], columns=COLUMNS)
            return
        for frame in frames:
            waiting.update({int(s): c for s, c in zip(frame["seq"], frame["chunk"]) if int(s) >= at})
        rows = []
        while at in waiting:
            chunk = waiting.pop(at)
            text += chunk
            if ("}" in chunk or "]" in chunk) and _complete(text):
                rows.append((key[0], at, text, False, None, None))
            at += 1
        state.update((text, at, waiting, False))
        state.setTimeoutDuration(timeout_ms)
        yield pd.DataFrame(rows, columns=COLUMNS)

    return stream.groupBy("response_id").applyInPandasWithState(
        step, OUTPUT, STATE, "append", GroupStateTimeout.ProcessingTimeTimeout)
