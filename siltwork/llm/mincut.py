"""Least cuts: the cheapest labelling of nodes with costs of their own and costs for neighbours that differ."""

from __future__ import annotations

from collections import deque


def labels(terminals: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """True for each node on the source's side of a least cut.

    A node of terminal t > 0 costs t if it is labelled False, one of t < 0 costs -t if it is labelled True; an edge
    (a, b, w) costs w if a and b differ. Of several least cuts the one with the fewest True nodes is taken.

    Nodes whose terminal outweighs all their open edges are settled at once, which settles others; a maximum
    flow is sought over what is left.
    """
    n = len(terminals)
    near: list[dict[int, int]] = [{} for _ in range(n)]
    for a, b, w in edges:
        if a != b and w > 0:
            near[a][b] = near[a].get(b, 0) + w
            near[b][a] = near[b].get(a, 0) + w
    pull, rest = list(terminals), [sum(e.values()) for e in near]
    side: list[bool | None] = [None] * n
    queue = deque(range(n))
    while queue:
        v = queue.popleft()
        # A tie is False's unless the edges alone could make up for it.
        if side[v] is not None or not (pull[v] > rest[v] or -pull[v] >= rest[v]):
            continue
        side[v] = pull[v] > rest[v]
        for u, w in near[v].items():
            if side[u] is None:
                pull[u] += w if side[v] else -w
                rest[u] -= w
                queue.append(u)
    left = [v for v in range(n) if side[v] is None]
    if left:
        reached = _source_side({v: pull[v] for v in left}, {v: {u: w for u, w in near[v].items() if side[u] is None} for v in left})
        for v in left:
            side[v] = v in reached
    return [bool(s) for s in side]


def _source_side(pull: dict[int, int], room: dict[int, dict[int, int]]) -> set[int]:
    """Nodes that the source still reaches when the flow is at its most (levels by breadth, paths by depth)."""
    out = {v: p for v, p in pull.items() if p > 0}
    into = {v: -p for v, p in pull.items() if p < 0}
    while True:
        level = {v: 0 for v, c in out.items() if c > 0}
        queue, ends = deque(level), False
        while queue:
            v = queue.popleft()
            ends = ends or into.get(v, 0) > 0
            for u, c in room[v].items():
                if c > 0 and u not in level:
                    level[u] = level[v] + 1
                    queue.append(u)
        if not ends:
            return set(level)
        after = {v: iter(room[v]) for v in level}
        for root in [v for v, c in out.items() if c > 0]:
            path = [root]
            while path and out[root] > 0:
                v = path[-1]
                if into.get(v, 0) > 0:
                    steps = list(zip(path, path[1:], strict=False))
                    flow = min([out[root], into[v], *(room[a][b] for a, b in steps)])
                    out[root] -= flow
                    into[v] -= flow
                    for a, b in steps:
                        room[a][b] -= flow
                        room[b][a] += flow
                    # Back to before the first edge that is full.
                    full = next((i for i, (a, b) in enumerate(steps) if not room[a][b]), len(path) - 1)
                    del path[full + 1 :]
                    continue
                u = next((u for u in after[v] if room[v][u] > 0 and level.get(u, -1) == level[v] + 1), None)
                if u is None:
                    path.pop()
                else:
                    path.append(u)
