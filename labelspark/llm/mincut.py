"""Minimum cuts of small graphs with two terminals."""

from __future__ import annotations

from collections import deque


def content_side(
    gain: list[int], edges: list[tuple[int, int, int]], needs: list[tuple[int, int, int]] = []
) -> list[bool]:
    """Which nodes stay with the source in a minimum cut.

    ``gain`` is the source capacity less the sink capacity of each node (what both have in common flows straight
    through and cuts nothing). ``edges`` are (node, node, capacity), the same both ways; ``needs`` are those of one way, cut
    if the first node stays and the second does not. Of several minimum cuts this is the
    one with the most nodes on the source side: only nodes that can still reach the sink are cut off.
    """
    n = len(gain)
    ends: list[int] = []
    room: list[int] = []
    near: list[list[int]] = [[] for _ in range(n + 2)]
    source, sink = n, n + 1

    def link(a: int, b: int, forth: int, back: int) -> None:
        near[a].append(len(ends))
        near[b].append(len(ends) + 1)
        ends.extend((b, a))
        room.extend((forth, back))

    for i, g in enumerate(gain):
        if g > 0:
            link(source, i, g, 0)
        elif g < 0:
            link(i, sink, -g, 0)
    for a, b, capacity in edges:
        if capacity and a != b:
            link(a, b, capacity, capacity)
    for a, b, capacity in needs:
        link(a, b, capacity, 0)

    def levels() -> list[int]:
        """Steps from the source along edges with room left."""
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in near[a]:
                if room[e] and level[ends[e]] < 0:
                    level[ends[e]] = level[a] + 1
                    queue.append(ends[e])
        return level

    while True:
        level = levels()
        if level[sink] < 0:
            break
        tried = [0] * (n + 2)
        path: list[int] = []
        at = source
        while True:
            if at == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                full = next(i for i, e in enumerate(path) if not room[e])
                at = ends[path[full] ^ 1]
                del path[full:]
                continue
            while tried[at] < len(near[at]):
                e = near[at][tried[at]]
                if room[e] and level[ends[e]] == level[at] + 1:
                    break
                tried[at] += 1
            else:
                if at == source:
                    break
                at = ends[path.pop() ^ 1]
                tried[at] += 1
                continue
            path.append(e)
            at = ends[e]
    reach = [False] * (n + 2)
    reach[sink] = True
    queue = deque([sink])
    while queue:
        b = queue.popleft()
        for e in near[b]:
            if room[e ^ 1] and not reach[ends[e]]:
                reach[ends[e]] = True
                queue.append(ends[e])
    return [not reach[i] for i in range(n)]
