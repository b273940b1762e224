"""A dyadic ladder over the change log's days.

Level ``j`` holds blocks of ``2**j`` calendar days, aligned, each with the net
changes of its committed days (``operators.compose``). Any range of days is
covered by at most about two blocks a level, so time travel over D days opens
O(log D) folders instead of D. Blocks are named by what they were made of: one
whose days have been rerun, corrected or added to since doesn't count any more,
whatever is left of it on disk.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

# Fixed form of a block marker's name: index, level, attempt, days' mark, schema.
BLOCK_MARK = re.compile(r"(\d+)_(\d{2})_([0-9a-f]{12})_([0-9a-f]{16})_([0-9a-f]{16})")
#: 2**16 days are more than a hundred years.
LEVELS = 16


@dataclass(frozen=True)
class Block:
    """The net changes of the committed days of one aligned range."""

    index: int
    level: int
    attempt: str
    mark: str
    schema: str
    days: tuple[dt.date, ...] = ()

    @property
    def marker(self) -> str:
        return f"{self.index}_{self.level:02d}_{self.attempt}_{self.mark}_{self.schema}"

    @property
    def folder(self) -> str:
        return f"level={self.level:02d}/block={self.index}/v={self.attempt}"


def index_of(day: dt.date, level: int) -> int:
    return day.toordinal() >> level


def days_mark(versions: Sequence) -> str:
    """What a block is made of: its days, each in its attempt."""
    return hashlib.sha256(",".join(f"{v.day}:{v.attempt}" for v in versions).encode()).hexdigest()[:16]


def groups(versions: Mapping[dt.date, object], level: int) -> dict[int, list]:
    """The committed versions by their block of ``level``, in day order."""
    out: dict[int, list] = {}
    for day in sorted(versions):
        out.setdefault(index_of(day, level), []).append(versions[day])
    return out


def valid(names: Sequence[str], versions: Mapping[dt.date, object]) -> tuple[dict[tuple[int, int], Block], list[Block]]:
    """(blocks of the committed days as they are now, blocks that are stale)."""
    found = [Block(int(m[1]), int(m[2]), m[3], m[4], m[5]) for m in map(BLOCK_MARK.fullmatch, sorted(names)) if m]
    by_level = {level: groups(versions, level) for level in {b.level for b in found}}
    good: dict[tuple[int, int], Block] = {}
    stale = []
    for b in found:
        mine = by_level[b.level].get(b.index, [])
        if days_mark(mine) == b.mark and (b.level, b.index) not in good:
            good[b.level, b.index] = Block(b.index, b.level, b.attempt, b.mark, b.schema, tuple(v.day for v in mine))
        else:
            stale.append(b)
    return good, stale


def cover(run: Sequence, blocks: Mapping[tuple[int, int], Block]) -> list:
    """The fewest blocks and single versions whose days are those of ``run``.

    ``run``: consecutive committed versions, in day order.
    """
    parts, i = [], 0
    while i < len(run):
        for level in range(LEVELS, 0, -1):
            b = blocks.get((level, index_of(run[i].day, level)))
            if b and b.days[0] == run[i].day and b.days[-1] <= run[-1].day:
                parts.append(b)
                i += len(b.days)
                break
        else:
            parts.append(run[i])
            i += 1
    return parts


def missing(
    versions: Mapping[dt.date, object], blocks: Mapping[tuple[int, int], Block], level: int
) -> Iterator[tuple[int, list]]:
    """(index, versions) of the blocks of ``level`` to be built: two committed
    days or more, of one schema, and over (the newest day is its last or later)."""
    newest = max(versions).toordinal()
    for index, mine in groups(versions, level).items():
        over = ((index + 1) << level) - 1 <= newest
        halves = {index_of(v.day, level - 1) for v in mine}
        if over and len(mine) > 1 and len(halves) == 2 and len({v.schema for v in mine}) == 1 and (level, index) not in blocks:
            yield index, mine
