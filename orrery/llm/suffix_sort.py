"""Deep-shallow sorting of suffixes: multikey quicksort to a shallow depth, then blind tries."""

from __future__ import annotations

import numpy as np

SHALLOW, WORD = 64, 8


def common_prefix(a: bytes, b: bytes) -> int:
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


class _Branch:
    """Inner node of a blind trie: only the place of the distinguishing byte and its branches."""

    __slots__ = ("place", "kids")

    def __init__(self, place: int, kids: dict):
        self.place, self.kids = place, kids


def blind_order(strings: list[bytes]) -> list[int]:
    """Indices in byte order (a prefix first, equal strings in the order given).

    A string goes down by the distinguishing bytes alone to some leaf, is compared with
    that leaf once, and enters where the common prefix ends.
    """
    if not strings:
        return []
    byte = lambda s, i: s[i] if i < len(s) else -1
    root: _Branch | list[int] = [0]
    for i in range(1, len(strings)):
        s, node, path = strings[i], root, []
        while isinstance(node, _Branch):
            path.append(node)
            node = node.kids.get(byte(s, node.place)) or next(iter(node.kids.values()))
        other = strings[node[0]]
        n = common_prefix(s, other)
        if n == len(s) == len(other):
            node.append(i)
            continue
        above, below = None, root
        for b in path:
            if b.place >= n:
                below = b
                break
            above, below = b, b.kids[byte(s, b.place)]
        if isinstance(below, _Branch) and below.place == n:
            below.kids[byte(s, n)] = [i]
            continue
        split = _Branch(n, {byte(s, n): [i], byte(other, n): below})
        if above is None:
            root = split
        else:
            above.kids[byte(s, above.place)] = split
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if isinstance(node, _Branch):
            stack.extend(node.kids[k] for k in sorted(node.kids, reverse=True))
        else:
            out.extend(node)
    return out


def deep_shallow(rows: np.ndarray, size: np.ndarray, group: np.ndarray, skip: int = 0) -> np.ndarray:
    """Order by (group, bytes) of the suffixes in ``rows`` (zero-padded bytes, ``size`` of them each).

    Multikey quicksort goes over all groups at once, eight bytes at a step: it divides
    every class of equal prefixes by its next word, down to ``SHALLOW`` bytes. Classes
    that are then still larger than one have long common prefixes; a blind trie orders
    each. ``skip``: bytes that all of a group have in common.
    """
    n = len(rows)
    order = np.argsort(group, kind="stable")
    start = np.ones(n, bool)  # where a class begins, in order
    start[1:] = group[order[1:]] != group[order[:-1]]
    for depth in range(skip, min(skip + SHALLOW, rows.shape[1] - WORD + 1), WORD):
        class_ = np.cumsum(start) - 1
        many = np.flatnonzero(np.bincount(class_, minlength=n)[class_] > 1)
        if not len(many):
            return order
        word = np.ascontiguousarray(rows[order[many], depth:depth + WORD]).view(">u8")[:, 0].astype(np.uint64)
        by = np.lexsort((word, class_[many]))
        order[many] = order[many][by]
        word, own = word[by], class_[many][by]
        new = np.ones(len(many), bool)
        new[1:] = (word[1:] != word[:-1]) | (own[1:] != own[:-1])
        start[many] = new
    class_ = np.cumsum(start) - 1
    bounds = np.append(np.flatnonzero(start), n)
    for c in np.flatnonzero(np.diff(bounds) > 1):
        own = order[bounds[c]:bounds[c + 1]]
        order[bounds[c]:bounds[c + 1]] = own[blind_order([rows[i, :size[i]].tobytes() for i in own])]
    return order
