"""Deep-shallow ordering of strings with long common prefixes.

Multikey quicksort orders the strings by a few bytes at a time down to a shallow depth; groups that
are still together there are ordered by a blind trie, which keeps only the branching positions and
reads each string about once however long the common prefixes are.
"""

from __future__ import annotations

from collections.abc import Sequence

SHALLOW = 128
STEP = 8


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


class BlindTrie:
    """Branch: [position, {byte or -1 at the end: child}]; leaf: list of numbers of equal strings."""

    def __init__(self, strings: Sequence[bytes], members: Sequence[int]):
        self.strings = strings
        self.root: list = [members[0]]
        self.branches: set[int] = set()
        for x in members[1:]:
            self._insert(x)

    def _is_branch(self, node: list) -> bool:
        return id(node) in self.branches

    def _byte(self, x: int, at: int) -> int:
        s = self.strings[x]
        return s[at] if at < len(s) else -1

    def _branch(self, at: int, children: dict) -> list:
        node = [at, children]
        self.branches.add(id(node))
        return node

    def _insert(self, x: int) -> None:
        node = self.root
        while self._is_branch(node):  # blind: bytes between the branches aren't looked at
            children = node[1]
            node = children.get(self._byte(x, node[0])) or next(iter(children.values()))
        other = node[0]
        same = common_prefix(self.strings[x], self.strings[other])
        if same == len(self.strings[x]) == len(self.strings[other]):
            node.append(x)
            return
        new, old = self._byte(x, same), self._byte(other, same)
        node, above = self.root, None
        while self._is_branch(node) and node[0] < same:
            above = (node, self._byte(x, node[0]))
            node = node[1][above[1]]
        if self._is_branch(node) and node[0] == same:
            node[1][new] = [x]
            return
        fresh = self._branch(same, {old: node, new: [x]})
        if above is None:
            self.root = fresh
        else:
            above[0][1][above[1]] = fresh

    def ordered(self) -> list[int]:
        out: list[int] = []
        todo = [self.root]
        while todo:
            node = todo.pop()
            if self._is_branch(node):
                todo += [node[1][c] for c in sorted(node[1], reverse=True)]
            else:
                out += node
        return out


def order(strings: Sequence[bytes], depth: int = 0, shallow: int = SHALLOW) -> list[int]:
    """Numbers of ``strings`` in byte order; all are known to agree in the first ``depth`` bytes."""
    out: list[int] = []
    todo: list[tuple[list[int], int]] = [(list(range(len(strings))), depth)]
    while todo:
        members, at = todo.pop()
        if len(members) < 2:
            out += members
        elif at >= shallow:
            out += BlindTrie(strings, members).ordered()
        else:
            keys = {x: strings[x][at : at + STEP] for x in members}
            pivot = keys[members[len(members) // 2]]
            less = [x for x in members if keys[x] < pivot]
            same = [x for x in members if keys[x] == pivot]
            more = [x for x in members if keys[x] > pivot]
            ended = len(pivot) < STEP  # equal strings that end here
            if ended:
                todo += [(more, at)]
                if less:
                    todo += [(same, shallow)] if len(same) > 1 else [(same, at)]
                    todo += [(less, at)]
                else:
                    out += same
            else:
                todo += [(more, at), (same, at + STEP), (less, at)]
    return out
