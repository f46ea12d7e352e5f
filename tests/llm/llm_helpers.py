import random


def words(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def edited(ws, seed, share):
    rng = random.Random(seed)
    return [f"x{rng.randrange(10**6)}" if rng.random() < share else w for w in ws]


def components(nodes, links):
    """Node -> smallest node reachable, by union and find."""
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for a, b in links:
        if a in parent and b in parent:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
