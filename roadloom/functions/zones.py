"""Speed zones of one scenario: sets of lanes that share one limit."""

from __future__ import annotations

import dataclasses

import numpy as np

# Metres, degrees and metres a second.
SHORT, GAP, SHARE, OPPOSITE, SAME, HOPS, TURN = 100.0, 8.0, 0.5, 150.0, 0.05, 4, 30.0


@dataclasses.dataclass
class Lane:
    """What zones need of a lane; points are rows x, y."""

    id: int
    line: np.ndarray
    limit: float = -1.0
    entries: list[int] = dataclasses.field(default_factory=list)
    exits: list[int] = dataclasses.field(default_factory=list)
    left: np.ndarray | None = None
    has_left: bool = False
    group: int | None = None
    junction: bool = False


class Sets:
    """Disjoint sets of ids; a set is called by its least id."""

    def __init__(self, ids):
        self.up = {i: i for i in ids}

    def of(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, a: int, b: int) -> None:
        a, b = self.of(a), self.of(b)
        self.up[max(a, b)] = min(a, b)

    def members(self) -> dict[int, list[int]]:
        """Members of each set, in the order of the ids given."""
        out: dict[int, list[int]] = {}
        for i in self.up:
            out.setdefault(self.of(i), []).append(i)
        return out


def same_limit(a: Lane, b: Lane) -> bool:
    """Whether limits agree."""
    return abs(a.limit - b.limit) <= SAME


def turn(a: np.ndarray | float, b: np.ndarray | float):
    """Angle between headings in degrees, 0 to 180."""
    return np.abs(np.rad2deg(np.angle(np.exp(1j * (np.asarray(a) - np.asarray(b))))))


def headings(line: np.ndarray) -> np.ndarray:
    """Heading at each vertex; the last has that of the last segment."""
    h = np.arctan2(np.diff(line[:, 1]), np.diff(line[:, 0]))
    return np.append(h, h[-1:])


def beside(a: np.ndarray, b: np.ndarray, gap: float) -> bool:
    """Whether most vertices of one line have the other's nearest vertex within the gap, running the other way."""
    d2 = ((a[:, None] - b[None]) ** 2).sum(axis=2)
    k = d2.argmin(axis=1)
    near = np.sqrt(d2[np.arange(len(a)), k]) <= gap
    return bool((near & (turn(headings(a), headings(b)[k]) >= OPPOSITE)).mean() >= SHARE)


def links(lanes: dict[int, Lane], gap: float) -> list[tuple[int, int]]:
    """Pairs of lanes outside junctions that belong to one zone: of one group, following with the same limit, or the other side of the road."""
    free = {i: l for i, l in lanes.items() if not l.junction}
    out, first = [], {}
    for i, l in free.items():
        if l.group is not None:
            out.append((first.setdefault(l.group, i), i))
        out += [(i, e) for e in l.exits if e in free and same_limit(l, free[e])]
    inner = [l for l in free.values() if not l.has_left and l.left is not None and len(l.left) > 1] if gap > 0 else []
    boxes = [(l.left.min(axis=0) - gap, l.left.max(axis=0) + gap) for l in inner]
    order = sorted(range(len(inner)), key=lambda k: boxes[k][0][0])
    for n, p in enumerate(order):
        for q in order[n + 1 :]:
            if boxes[q][0][0] + gap > boxes[p][1][0]:
                break
            a, b = inner[p], inner[q]
            if (boxes[p][1] >= boxes[q][0]).all() and (boxes[q][1] >= boxes[p][0]).all() and same_limit(a, b) and (beside(a.left, b.left, gap) or beside(b.left, a.left, gap)):
                out.append((a.id, b.id))
    return out


def size(lanes: dict[int, Lane], members: list[int]) -> float:
    """Diagonal of the box around the members."""
    xy = np.concatenate([lanes[i].line for i in members])
    return float(np.linalg.norm(xy.max(axis=0) - xy.min(axis=0)))


def _straight(before: Lane, after: Lane) -> bool:
    out = np.arctan2(*(before.line[-1] - before.line[-2])[::-1])
    into = np.arctan2(*(after.line[1] - after.line[0])[::-1])
    return bool(turn(into, out) <= TURN)


def across(lanes: dict[int, Lane], sets: Sets, members: list[int]) -> set[int]:
    """Zones of the limit of the first member that go straight on behind one to HOPS junction lanes, either way."""
    found = set()
    for i in members:
        for ahead in (True, False):
            step = lambda l, ahead=ahead: l.exits if ahead else l.entries
            level = [n for n in step(lanes[i]) if n in lanes and n not in sets.up]
            for _ in range(HOPS):
                nexts = [n for j in level for n in step(lanes[j]) if n in lanes]
                for n in nexts:
                    if n in sets.up and same_limit(lanes[n], lanes[members[0]]) and (_straight(lanes[i], lanes[n]) if ahead else _straight(lanes[n], lanes[i])):
                        found.add(sets.of(n))
                level = list(dict.fromkeys(n for n in nexts if n not in sets.up))
                if not level:
                    break
    return found


def merge_short(lanes: dict[int, Lane], sets: Sets, least: float) -> None:
    """Join short zones to a neighbour across a junction, one at a time: the shortest that has any, to its shortest; ties to the smaller id."""
    if least <= 0:
        return
    for _ in range(len(sets.up)):
        zones = sets.members()
        sizes = {r: size(lanes, m) for r, m in zones.items()}
        for r in sorted((r for r in zones if sizes[r] < least), key=lambda r: (sizes[r], r)):
            near = across(lanes, sets, zones[r]) - {r}
            if near:
                sets.join(r, min(near, key=lambda x: (sizes[x], x)))
                break
        else:
            return


def zones(lanes: list[Lane], least: float = SHORT, gap: float = GAP) -> dict[int, int]:
    """Zone of each lane, numbered by its least lane id; -1 for junction lanes, and for all where no lane has a group."""
    by = {l.id: l for l in lanes}
    out = dict.fromkeys(by, -1)
    if all(l.group is None for l in lanes):
        return out
    sets = Sets(i for i, l in by.items() if not l.junction)
    for a, b in links(by, gap):
        sets.join(a, b)
    merge_short(by, sets, least)
    for k, root in enumerate(sorted(sets.members())):
        for i in sets.members()[root]:
            out[i] = k
    return out
