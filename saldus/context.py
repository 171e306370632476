"""What a run is told from outside, so that results depend on nothing else."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def uuid_of(code: Column) -> Column:
    """An identifier in UUID form that is the same each time it is worked out."""
    h = F.md5(F.concat(F.lit("cliente:"), code))
    return F.concat(F.lit("PRIME-"), F.concat_ws("-", *(F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))))


def plain_id(code: Column) -> Column:
    return F.concat(F.lit("PRIME-"), code)


@dataclass(frozen=True)
class Context:
    """file: name of the source file; snapshot: its date; executed: time stamp of the run; new_id: identifier of a new record from its code."""

    file: str | None = "arquivo.xls"
    snapshot: str | None = field(default_factory=lambda: datetime.now(UTC).strftime("%Y-%m-%d"))
    executed: str | None = None
    new_id: Callable[[Column], Column] = uuid_of
