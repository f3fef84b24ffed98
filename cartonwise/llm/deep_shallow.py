"""Deep-shallow sorting of short byte strings: multikey quicksort to a shallow depth, then a blind trie for each group of
strings that are still alike.

Quicksort compares eight bytes at a time and parts all groups of a round together. Strings that share the shallow depth often
share far more, so the rest is ordered by tries that look at one byte a branching and compare each string with one other.
"""

from __future__ import annotations

import numpy as np


def _multikey_quicksort(words: np.ndarray, shallow: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """(order, groups): the rows of words (strings as big-endian numbers of eight bytes) ordered by their first `shallow`
    columns, and the (start, end) of each run in that order that these leave tied."""
    order = np.arange(len(words))
    start, size, depth = np.array([0]), np.array([len(words)]), np.array([0])
    tied = []
    while True:
        done = depth >= shallow
        tied += [(s, s + n) for s, n in zip(start[done & (size > 1)].tolist(), size[done & (size > 1)].tolist())]
        live = ~done & (size > 1)
        start, size, depth = start[live], size[live], depth[live]
        if not len(start):
            return order, sorted(tied)
        group = np.repeat(np.arange(len(start)), size)
        first = np.cumsum(size) - size  # of each group among the live rows
        place = np.arange(len(group)) + np.repeat(start - first, size)
        rows = order[place]
        keys = words[rows, depth[group]]
        low, mid, high = keys[first], keys[first + size // 2], keys[first + size - 1]
        pivot = np.maximum(np.minimum(low, mid), np.minimum(np.maximum(low, mid), high))[group]
        less, equal = keys < pivot, keys == pivot
        counts_less, counts_equal = np.add.reduceat(less, first, dtype=np.int64), np.add.reduceat(equal, first, dtype=np.int64)

        def rank(mask):
            """How many rows of the same group before each have the mask."""
            total = np.cumsum(mask) - mask
            return total - total[first][group]

        after_less, after_equal = counts_less, counts_less + counts_equal
        within = np.where(less, rank(less), np.where(equal, after_less[group] + rank(equal), after_equal[group] + rank(~(less | equal))))
        order[np.repeat(start, size) + within] = rows
        start, size, depth = (np.concatenate(x) for x in (
            (start, start + after_less, start + after_equal), (counts_less, counts_equal, size - after_equal), (depth, depth + 1, depth)))


class BlindTrie:
    """Strings of one length in a trie whose inner nodes know only the place at which their strings part and the byte there."""

    class Node:
        __slots__ = ("place", "children")

        def __init__(self, place: int, children: dict):
            self.place, self.children = place, children

    def __init__(self) -> None:
        self.root: BlindTrie.Node | list | None = None

    def insert(self, text: bytes, name: int) -> None:
        """Leaves are lists of one text and the names of its copies."""
        if self.root is None:
            self.root = [text, name]
            return
        path, node = [], self.root
        while isinstance(node, BlindTrie.Node):
            path.append(node)
            child = node.children.get(text[node.place])
            node = next(iter(node.children.values())) if child is None else child
        other = node[0]
        if other == text:
            node.append(name)
            return
        apart = int.from_bytes(text) ^ int.from_bytes(other)
        place = len(text) - (apart.bit_length() + 7) // 8  # the first byte that differs
        above = None
        for inner in path:
            if inner.place >= place:
                break
            above = inner
        else:
            inner = None
        leaf = [text, name]
        if inner is not None and inner.place == place:
            inner.children[text[place]] = leaf
            return
        below = self.root if above is None else above.children[text[above.place]]
        parted = BlindTrie.Node(place, {other[place]: below, text[place]: leaf})
        if above is None:
            self.root = parted
        else:
            above.children[text[above.place]] = parted

    def leaves(self):
        """Lists of names of equal texts, in the order of the texts."""
        stack = [] if self.root is None else [self.root]
        while stack:
            node = stack.pop()
            if isinstance(node, BlindTrie.Node):
                stack += [node.children[byte] for byte in sorted(node.children, reverse=True)]
            else:
                yield node[1:]


def deep_shallow(rows: np.ndarray, lengths: np.ndarray, shallow_bytes: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """(order, common): the lexicographic order of strings, and how many leading bytes each shares with the one before it in
    that order (-1 for the first). rows: a row of bytes for each string, zero after its length, in a multiple of eight columns.
    Of equal strings, any may come first."""
    count, width = rows.shape
    if not count:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rows = np.ascontiguousarray(rows)
    words = rows.view(">u8").astype(np.uint64)
    order, tied = _multikey_quicksort(words, min(shallow_bytes // 8, width // 8))
    content = rows.tobytes()
    for start, end in tied:
        trie = BlindTrie()
        for name in order[start:end].tolist():
            trie.insert(content[name * width:(name + 1) * width], name)
        # A shorter string comes first where the rows agree: the longer one goes on with zeros.
        order[start:end] = [name for names in trie.leaves() for name in sorted(names, key=lengths.__getitem__)]
    apart = rows[order[1:]] != rows[order[:-1]]
    common = np.where(apart.any(axis=1), apart.argmax(axis=1), width)
    common = np.minimum(common, np.minimum(lengths[order[1:]], lengths[order[:-1]]))
    return order, np.concatenate([[-1], common]).astype(np.int64)
