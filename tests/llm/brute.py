"""Near-duplicate classes from all pairs of documents that share a shingle."""

from collections import Counter, defaultdict


def bag(text):
    words = (text or "").lower().split()
    return Counter(tuple(words[i:i + 5]) for i in range(max(len(words) - 4, 1))) if words else Counter()


def brute_classes(rows, similarity=0.8):
    bags = {i: bag(t) for i, t in rows}
    parent = {i: i for i in bags}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for a in sorted(bags):
        for b in {b for shingle in bags[a] for b in holders[shingle]}:
            common = (bags[a] & bags[b]).total()
            if common >= similarity * (bags[a].total() + bags[b].total() - common):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
        for shingle in bags[a]:
            holders[shingle].append(a)
    return {i: find(i) for i in parent}
