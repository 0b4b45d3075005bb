"""Minimum cuts of two-label problems: what each node costs under either label, and what unlike neighbours cost."""

from __future__ import annotations

from collections import deque


def _settle(gain: list[int], links: list[dict[int, int]]) -> dict[int, bool]:
    """Labels of nodes whose own evidence outweighs all their links, one after the other.

    Such a node has that label in every cheapest cut (on a tie, in the one that takes fewer nodes). Once it is
    settled, its links are evidence for its neighbours.
    """
    weight = [sum(l.values()) for l in links]
    label: dict[int, bool] = {}
    queue = deque(range(len(gain)))
    while queue:
        i = queue.popleft()
        if i in label:
            continue
        if gain[i] > weight[i]:
            label[i] = True
        elif -gain[i] >= weight[i]:
            label[i] = False
        else:
            continue
        for j, w in links[i].items():
            if j not in label:
                gain[j] += w if label[i] else -w
                weight[j] -= w
                del links[j][i]
                queue.append(j)
    return label


def _max_flow(gain: list[int], links: list[dict[int, int]], nodes: list[int]) -> set[int]:
    """The nodes on the source's side of the smallest cheapest cut, by Dinic's blocking flows."""
    source, sink = -1, -2
    room: dict[int, dict[int, int]] = {source: {}, sink: {}, **{i: dict(links[i]) for i in nodes}}
    for i in nodes:
        if gain[i] > 0:
            room[source][i], room[i][source] = gain[i], 0
        elif gain[i] < 0:
            room[i][sink], room[sink][i] = -gain[i], 0
    while True:
        level, queue = {source: 0}, deque([source])
        while queue:
            i = queue.popleft()
            for j, c in room[i].items():
                if c and j not in level:
                    level[j] = level[i] + 1
                    queue.append(j)
        if sink not in level:
            return {i for i in nodes if i in level}
        ways = {i: iter(room[i].items()) for i in level}
        path: list[int] = [source]
        while path:
            i = path[-1]
            if i == sink:
                flow = min(room[a][b] for a, b in zip(path, path[1:]))
                back = 0
                for k, (a, b) in reversed(list(enumerate(zip(path, path[1:])))):
                    room[a][b] -= flow
                    room[b][a] += flow
                    if not room[a][b]:
                        back = k
                del path[back + 1 :]
                continue
            for j, _ in ways[i]:
                if room[i][j] and level.get(j) == level[i] + 1:
                    path.append(j)
                    break
            else:
                path.pop()
                level[i] = -1


def cheapest_labels(gain: list[int], links: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes to take: the sum of ``gain`` of those taken, less the weights of links between taken and left
    nodes, is largest. Of several answers the one with the fewest nodes.

    ``links`` are (node, node, weight) with positive weights. Most nodes are settled by their own evidence; the
    maximum flow runs over each connected rest.
    """
    gain, near = list(gain), [{} for _ in gain]
    for a, b, w in links:
        if a != b and w > 0:
            near[a][b] = near[a].get(b, 0) + w
            near[b][a] = near[b].get(a, 0) + w
    label = _settle(gain, near)
    for start in range(len(gain)):
        if start in label:
            continue
        rest, stack = {start}, [start]
        while stack:
            for j in near[stack.pop()]:
                if j not in rest:
                    rest.add(j)
                    stack.append(j)
        nodes = sorted(rest)
        taken = _max_flow(gain, near, nodes)
        label.update((i, i in taken) for i in nodes)
    return [label[i] for i in range(len(gain))]
