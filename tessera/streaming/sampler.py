"""The fixed-grid sampler as a stream: one state for each recording, the same frames as the batch form.

State: the first frame's time, the next target, the number of frames kept, the time up to which frames are settled, and frames
held back. A frame is held until one at least `delay` later has come, so frames that are late by less are sorted in, and
until it is known that it doesn't lie in the end that is skipped. A frame older than settled ones is an error, or is
given with a null sample_no, as `late` says; none is dropped without a trace.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

STATE = "first long, target long, kept long, latest long, settled long, held_t array<long>, held_id array<long>"


def sample(frames: DataFrame, recording: str, time: str, tie: str, stride: int, start_skip: int = 0, skip_end: int = 0, late: str = "fail", delay: int = 0) -> DataFrame:
    """(recording, time, tie, sample_no) of the frames kept, of a stream or a table; recording, time and tie are longs.

    late is "fail" or "mark". What is left at a recording's end is what the batch form trims; with a delay larger than
    skip_end it is that much more.
    """
    if late not in ("fail", "mark"):
        raise ValueError("late must be fail or mark")

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        first, target, kept, latest, settled, held_t, held_id = state.get if state.exists else (None, None, 0, None, None, [], [])
        out = []
        held = list(zip(held_t, held_id, strict=True))
        for part in parts:
            held += zip(part[time].tolist(), part[tie].tolist(), strict=True)
        held.sort()
        if settled is not None:
            behind = [x for x in held if x[0] < settled]
            if behind and late == "fail":
                raise ValueError(f"a frame of recording {key[0]} came late")
            out += [(t, i, None) for t, i in behind]
            held = held[len(behind) :]
        if held:
            latest = max(held[-1][0], latest) if latest is not None else held[-1][0]
        n = 0
        for t, i in held:
            if t > latest - delay:
                break
            if first is None:
                first, target = t, t + start_skip
            if t - first >= start_skip:
                if not t - first < latest - first - skip_end:
                    break
                if t >= target:
                    out.append((t, i, kept))
                    kept, target = kept + 1, target + stride
            settled = t
            n += 1
        held = held[n:]
        state.update((first, target, kept, latest, settled, [t for t, _ in held], [i for _, i in held]))
        if out:
            yield pd.DataFrame({recording: key[0], time: [x[0] for x in out], tie: [x[1] for x in out], "sample_no": pd.array([x[2] for x in out], "Int64")})

    schema = f"{recording} long, {time} long, {tie} long, sample_no long"
    return frames.select(recording, time, tie).groupBy(recording).applyInPandasWithState(step, schema, STATE, "append", GroupStateTimeout.NoTimeout)
