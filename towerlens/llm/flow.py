"""Least cuts of small graphs with a source and a sink."""

from collections import deque


def least_cut(excess: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Says of every node whether it's on the source's side of a least cut.

    ``excess`` is a node's capacity from the source less that to the sink; ``edges`` are undirected, ``(a, b,
    capacity)``. Capacities are whole numbers. Where several cuts are least, the source's side is the smallest.

    A node whose excess outweighs all its edges is settled and leaves its edges to its neighbours as excess; what
    remains goes through maximum flow, by shortest augmenting paths in layers.
    """
    near: list[dict[int, int]] = [{} for _ in excess]
    for a, b, capacity in edges:
        if a != b and capacity > 0:
            near[a][b] = near[a].get(b, 0) + capacity
            near[b][a] = near[b].get(a, 0) + capacity
    excess, side = list(excess), [None] * len(excess)
    waiting = deque(range(len(excess)))
    while waiting:
        node = waiting.popleft()
        if side[node] is None and abs(excess[node]) >= sum(near[node].values()) and (excess[node] or not near[node]):
            side[node] = excess[node] > 0
            for other, capacity in near[node].items():
                del near[other][node]
                excess[other] += capacity if side[node] else -capacity
                waiting.append(other)
            near[node] = {}
    rest = [node for node, where in enumerate(side) if where is None]
    if rest:
        for node, where in zip(rest, _by_flow([excess[node] for node in rest], rest, near)):
            side[node] = where
    return side


def _by_flow(excess: list[int], nodes: list[int], near: list[dict[int, int]]) -> list[bool]:
    """The source's side among ``nodes``, by maximum flow."""
    number = {node: i for i, node in enumerate(nodes)}
    source, sink = len(nodes), len(nodes) + 1
    room: list[dict[int, int]] = [{number[b]: c for b, c in near[a].items()} for a in nodes] + [{}, {}]
    for node, value in enumerate(excess):
        if value > 0:
            room[source][node], room[node][source] = value, 0
        elif value < 0:
            room[node][sink], room[sink][node] = -value, 0
    while True:
        layer = {source: 0}
        queue = deque([source])
        while queue:
            node = queue.popleft()
            for other, left in room[node].items():
                if left and other not in layer:
                    layer[other] = layer[node] + 1
                    queue.append(other)
        if sink not in layer:
            return [node in layer for node in range(len(nodes))]
        ways = [iter(list(r)) for r in room]
        path = [source]
        while path:
            node = path[-1]
            if node == sink:
                amount = min(room[a][b] for a, b in zip(path, path[1:]))
                for a, b in zip(path, path[1:]):
                    room[a][b] -= amount
                    room[b][a] += amount
                full = next(i for i, (a, b) in enumerate(zip(path, path[1:])) if not room[a][b])
                del path[full + 1 :]
                continue
            for other in ways[node]:
                if room[node][other] and layer.get(other) == layer[node] + 1:
                    path.append(other)
                    break
            else:
                path.pop()
