"""Turns of conversations in order, streamed through tasks in runs of bounded size.

Rows are dealt by ranges of (conversation, turn, a hash of role and text, a row number) and sorted within them, so that a
conversation of any size is spread over as many tasks as it needs and no task has more than its share. A task sees each
conversation as one run or several; only the first and the last one of a task may go on in another task.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any, NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: what `runs` needs to see in this order; further columns may follow
COLUMNS = ("conv_id", "turn", "role", "text")


class Run(NamedTuple):
    """Neighbouring rows of one conversation. at: what sorts the runs of a conversation; opens, closes: nothing comes before
    or after it, for certain."""

    conv_id: Any
    at: tuple
    rows: list[tuple]
    opens: bool
    closes: bool


def in_turns(rows: DataFrame, *more: str) -> DataFrame:
    """conv_id, turn, role, text, `more`, and what breaks ties: rows of one turn (nulls first) come by a hash of role and
    text; equal rows stay side by side."""
    tied = rows.select(*COLUMNS, *more, F.md5(F.concat_ws("\n", "role", "text").cast("binary")).alias("tie"), F.monotonically_increasing_id().alias("row"))
    keys = ["conv_id", "turn", "tie", "row"]
    return tied.repartitionByRange(*keys).sortWithinPartitions(*keys)


def runs(batches: Iterator[pa.RecordBatch], most_rows: int, most_chars: int, width: int = 4) -> Iterator[Run]:
    """The rows of `in_turns` as runs of at most `most_rows` rows; a run ends once it has `most_chars` characters."""
    own: list[tuple] = []
    key, at, size, opens, seen = None, None, 0, False, False
    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in range(width)]
        ties, numbers = batch.column("tie").to_pylist(), batch.column("row").to_pylist()
        for row, tie, number in zip(zip(*columns, strict=True), ties, numbers, strict=True):
            fresh = seen and row[0] != key
            if own and (fresh or len(own) >= most_rows or size >= most_chars):
                yield Run(key, at, own, opens, fresh)
                own, size, opens = [], 0, fresh
            if not own:
                key, at, seen = row[0], (row[1] is not None, row[1] or 0, tie, number), True
            own.append(row[1:])
            size += len(row[3] or "") + len(row[2] or "")
    if own:
        yield Run(key, at, own, opens, False)
