"""Plain-Python brute force that the operators are compared with."""

from collections import defaultdict, deque
from fractions import Fraction
from itertools import combinations


def neighbours(edges):
    near = defaultdict(set)
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    return near


def distances(edges):
    """{(s, v): (depth, number of shortest paths)}"""
    near, found = neighbours(edges), {}
    for s in near:
        depth, count, queue = {s: 0}, defaultdict(int), deque([s])
        count[s] = 1
        while queue:
            v = queue.popleft()
            for w in near[v]:
                if w not in depth:
                    depth[w] = depth[v] + 1
                    queue.append(w)
                if depth[w] == depth[v] + 1:
                    count[w] += count[v]
        for v, d in depth.items():
            found[s, v] = (d, count[v])
    return found


def betweenness(edges):
    """By pair dependencies: for each edge, the share of shortest paths of every pair that use it."""
    found = distances(edges)
    nodes = sorted(neighbours(edges))
    scores = {}
    for a, b in edges:
        total = Fraction(0)
        for s in nodes:
            for t in nodes:
                if (s, a) in found and (b, t) in found and found[s, a][0] + 1 + found[b, t][0] == found[s, t][0]:
                    total += Fraction(found[s, a][1] * found[b, t][1], found[s, t][1])
        scores[min(a, b), max(a, b)] = total
    return scores


def components(nodes, edges):
    label = {v: v for v in nodes}

    def top(v):
        while label[v] != v:
            v = label[v]
        return v

    for a, b in edges:
        x, y = sorted((top(a), top(b)))
        label[y] = x
    return {v: top(v) for v in nodes}


def pair_modularity(edges, label):
    near, present, m = neighbours(edges), {tuple(sorted(e)) for e in edges}, len(edges)
    total = Fraction(0)
    for i, j in combinations(sorted(near), 2):
        if label[i] == label[j]:
            total += ((i, j) in present) - Fraction(len(near[i]) * len(near[j]), 2 * m)
    return total / (2 * m)


def standard_modularity(edges, label):
    near, m = neighbours(edges), len(edges)
    total = Fraction(0)
    for i in near:
        for j in near:
            if label[i] == label[j]:
                total += (j in near[i]) - Fraction(len(near[i]) * len(near[j]), 2 * m)
    return total / (2 * m)


def curve(order, min_removed=1):
    """[(k, components, q)] by one component run per k."""
    nodes = sorted(neighbours(order))
    before, rows = len(set(components(nodes, order).values())), []
    for k in range(1, len(order) + 1):
        label = components(nodes, order[k:])
        count = len(set(label.values()))
        if k >= min_removed and (count != before or k == min_removed):
            rows.append((k, count, pair_modularity(order, label)))
        before = count
    return rows
