"""Plain versions of operators, for small inputs."""

import re


def shingle_set(text, width):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode()
    words = [w for w in re.split(rb"[\x20\x09-\x0D]+", lowered) if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1)))


def components(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def near_duplicates(texts, width, percent=80):
    """``{id: (set size, component)}`` by comparing all pairs."""
    sets = {i: shingle_set(t, width) for i, t in texts.items()}
    ids, links = sorted(sets), []
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                    links.append((a, b))
    found = components(ids, links)
    return {i: (len(sets[i]), found[i]) for i in ids}
