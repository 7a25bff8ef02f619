"""One pattern for a table of tokens, however many: a trie, leftmost and longest.

A plain alternation tries every token at every place, and takes the first that
matches, not the longest. Here tokens with a common beginning share it; after
it, the next characters are told apart by halves, so a place costs the length of
the longest match times the logarithm of the branches. The text is read once.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

FEW = 6  # branches that are tried one after the other


def longest_of(tokens: Iterable[str]) -> str:
    """A pattern (of Java's and Python's regular expressions) for the longest of the tokens at the leftmost place.

    Empty tokens are left out; without any other the pattern matches nothing.
    """
    root: dict = {}
    for token in tokens:
        node = root
        for character in token:
            node = node.setdefault(character, {})
        if token:
            node[""] = {}
    if not root:
        return r"(?!)"
    # from the deepest node up, so that long tokens need no deep recursion
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [child for character, child in node.items() if character]
    patterns: dict[int, str] = {}
    for node in reversed(order):
        branches = sorted((c, re.escape(c) + patterns.pop(id(child))) for c, child in node.items() if c)
        inside = _one_of(branches)
        if not branches:
            patterns[id(node)] = ""
        elif "" in node:
            patterns[id(node)] = f"(?:{inside})?"
        else:
            patterns[id(node)] = inside if len(branches) == 1 else f"(?:{inside})"
    return patterns[id(root)]


def _one_of(branches: list[tuple[str, str]]) -> str:
    if len(branches) <= FEW:
        return "|".join(pattern for _, pattern in branches)
    middle = len(branches) // 2
    halves = (branches[:middle], branches[middle:])
    return "|".join(f"(?=[{re.escape(h[0][0])}-{re.escape(h[-1][0])}])(?:{_one_of(h)})" for h in halves)
