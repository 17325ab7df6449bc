"""Statistics of what a job writes, collected in the pass that writes it: `DataFrame.observe` adds up a few aggregates while rows
go by. Only what finished tasks saw counts, so a repeated task doesn't count twice, and no second scan is made."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def write_observed(rows: DataFrame, path: str, mode: str = "append", **measures: Column) -> dict:
    """Writes `rows` as Parquet and returns n and the `measures` (aggregates) over them."""
    seen = Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("n"), *[c.alias(name) for name, c in measures.items()]).write.mode(mode).parquet(path)
    return seen.get


def upload_run(files: DataFrame, path: str, ok: str = "ok", size: str = "size_mb") -> dict:
    """Writes a run's files (ok, size_mb, and whatever else they have) and returns its statistics: uploaded, failed, size_mb of the
    uploaded ones, success_rate (0 for no files), and `deletes`: whether sources may go, which is when nothing failed."""
    good = F.coalesce(F.col(ok), F.lit(False))
    seen = write_observed(files, path, uploaded=F.count_if(good), failed=F.count_if(~good), size_mb=F.sum(F.when(good, F.col(size)).otherwise(F.lit(0.0))))
    n = seen["n"]
    return {"uploaded": seen["uploaded"], "failed": seen["failed"], "size_mb": seen["size_mb"] or 0.0, "success_rate": seen["uploaded"] / n if n else 0.0, "deletes": seen["failed"] == 0}


def class_shares(rows: DataFrame, path: str, column: str, classes: list[str]) -> list[tuple[str, int, float]]:
    """Writes `rows` and returns (class, count, percent) of each class, the most frequent first, in that one pass; what is
    no class counts towards none of them."""
    names = {f"c{i}": F.count_if(F.col(column) == c) for i, c in enumerate(classes)}
    seen = write_observed(rows, path, **names)
    total = sum(seen[k] for k in names)
    return sorted(((c, seen[f"c{i}"], 100.0 * seen[f"c{i}"] / total if total else 0.0) for i, c in enumerate(classes)), key=lambda r: (-r[1], r[0]))
