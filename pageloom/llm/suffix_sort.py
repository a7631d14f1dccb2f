"""Deep-shallow sorting of text suffixes, to find those that are equal for a given length.

Suffixes are sorted by multikey quicksort on eight bytes at a time to a shallow depth;
groups that still agree there are ordered by a blind trie each.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 32


class BlindTrie:
    """Suffixes that agree on their first bytes, kept in order by where they branch.

    A node holds the depth at which its children differ and one child per byte. To insert,
    the trie is walked by the bytes at branching depths alone; the leaf reached agrees as
    long as any, so one comparison with it gives the depth at which the new leaf belongs.
    """

    def __init__(self, limit: int):
        self.limit = limit
        self.root: list | None = None  # [depth, {byte: node}] or [limit, members, text]

    def insert(self, number: int, text: bytes) -> None:
        if self.root is None:
            self.root = [self.limit, [number], text]
            return
        node = self.root
        while node[0] < self.limit:
            children = node[1]
            node = children.get(text[node[0]]) or next(iter(children.values()))
        other = node[2]
        if other == text:
            node[1].append(number)
            return
        difference = int.from_bytes(other, "big") ^ int.from_bytes(text, "big")
        depth = self.limit - (difference.bit_length() + 7) // 8
        node, parent = self.root, None
        while node[0] < depth:
            parent, node = node, node[1][text[node[0]]]
        leaf = [self.limit, [number], text]
        if node[0] == depth:
            node[1][text[depth]] = leaf
            return
        branch = [depth, {other[depth]: node, text[depth]: leaf}]
        if parent is None:
            self.root = branch
        else:
            parent[1][text[parent[0]]] = branch

    def groups(self):
        """The leaves in order: numbers of the suffixes that agree up to the limit."""
        if self.root is None:
            return
        stack = [self.root]
        while stack:
            node = stack.pop()
            if node[0] == self.limit:
                yield node[1]
            else:
                stack += [node[1][byte] for byte in sorted(node[1], reverse=True)]


def sorted_groups(
    data: np.ndarray, starts: np.ndarray, classes: np.ndarray, limit: int
) -> tuple[np.ndarray, np.ndarray]:
    """Sort the suffixes at ``starts`` by their class, then by ``limit`` bytes.

    Returns the order and, for every place in it, whether the suffix equals the one
    before it in class and in all ``limit`` bytes.
    """
    order = np.argsort(classes, kind="stable")
    same = np.r_[False, classes[order][1:] == classes[order][:-1]]
    depth = 0
    while depth < min(SHALLOW, limit):
        # Only suffixes of groups that are not single yet.
        open_ = same | np.r_[same[1:], False]
        rows = np.flatnonzero(open_)
        if not len(rows):
            return order, same
        some = order[rows]
        key = np.zeros(len(rows), np.uint64)
        for k in range(min(8, limit - depth)):
            key = (key << np.uint64(8)) | data[starts[some] + (depth + k)].astype(np.uint64)
        group = np.cumsum(~same[rows])
        turn = np.lexsort((key, group))
        order[rows] = some[turn]
        key, group = key[turn], group[turn]
        same[rows] = np.r_[False, (key[1:] == key[:-1]) & (group[1:] == group[:-1])]
        depth += 8
    if depth >= limit:
        return order, same
    cuts = np.flatnonzero(~same)
    ends = np.r_[cuts[1:], len(order)]
    whole = data.tobytes()
    for a, b in zip(cuts.tolist(), ends.tolist()):
        if b - a < 2:
            continue
        trie = BlindTrie(limit)
        for number in order[a:b].tolist():
            at = int(starts[number])
            trie.insert(number, whole[at : at + limit])
        place = a
        for members in trie.groups():
            order[place : place + len(members)] = members
            same[place] = False
            same[place + 1 : place + len(members)] = True
            place += len(members)
    return order, same


def repeated(
    data: np.ndarray, starts: np.ndarray, classes: np.ndarray, weights: np.ndarray, limit: int
) -> np.ndarray:
    """Which suffixes have an equal one in their class, or a weight of two or more."""
    out = weights > 1
    if len(starts):
        order, same = sorted_groups(data, starts, classes, limit)
        out[order] |= same | np.r_[same[1:], False]
    return out


