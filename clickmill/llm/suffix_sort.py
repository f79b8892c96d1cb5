"""Deep-shallow sorting of many short strings: multikey quicksort to a fixed depth, blind tries below it.

All strings lie in one buffer and are given by start and length. Strings are sorted inside groups that the caller names; the
result is the order and, for every string but the first of a group, the length of the prefix it shares with the one
before it. The shallow part compares eight bytes at a time, for all groups at once; groups that are still tied at depth
``SHALLOW`` are ordered one by one in a blind trie, which compares single branching bytes on the way down and looks at a
whole string once, at the leaf.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 24
STEP = 8


def _characters(buffer: np.ndarray, starts: np.ndarray, lengths: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The eight bytes at ``depth`` as big-endian numbers, zeros beyond the end, and how many of them are real."""
    real = np.clip(lengths - depth, 0, STEP)
    at = starts[:, None] + depth + np.arange(STEP)
    chars = np.where(np.arange(STEP) < real[:, None], buffer[np.minimum(at, len(buffer) - 1)], 0).astype(np.uint8)
    return np.ascontiguousarray(chars).view(">u8").ravel().astype(np.uint64), real


def _common(a: np.ndarray, b: np.ndarray, real: np.ndarray) -> np.ndarray:
    """Leading equal bytes of two eight-byte characters, at most ``real``."""
    differ = a ^ b
    same = np.full(len(a), STEP)
    for k in range(STEP - 1, -1, -1):
        same[(differ >> np.uint64(8 * (STEP - 1 - k))) != 0] = k
    # the loop ends with the first differing byte: later, that is smaller, k overwrite
    return np.minimum(same, real)


def blind_trie(strings: list[bytes]) -> tuple[list[int], list[int]]:
    """Order of strings and the common prefix of each with the one before (0 for the first).

    A node is [depth, {byte or -1 for the end: child}], a leaf the list of the indices of equal strings.
    """
    root = None
    for i, s in enumerate(strings):
        if root is None:
            root = (len(s), [i])
            continue
        node = root
        while isinstance(node[1], dict):  # down by branching bytes only, any child where none fits
            depth, children = node
            byte = s[depth] if depth < len(s) else -1
            node = children.get(byte) or next(iter(children.values()))
        other = strings[node[1][0]]
        n = min(len(s), len(other))
        if s[:n] == other[:n]:
            shared = n
        else:
            shared = next(k for k in range(n) if s[k] != other[k])
        if shared == len(s) == len(other):
            node[1].append(i)
            continue
        above, node = None, root
        while isinstance(node[1], dict) and node[0] < shared:
            above, byte = node, s[node[0]]
            node = node[1][byte]
        mine = s[shared] if shared < len(s) else -1
        if isinstance(node[1], dict) and node[0] == shared:
            node[1][mine] = (len(s), [i])
            continue
        theirs = other[shared] if shared < len(other) else -1
        split = (shared, {theirs: node, mine: (len(s), [i])})
        if above is None:
            root = split
        else:
            above[1][byte] = split
    order: list[int] = []
    shared_before: list[int] = []
    stack = [(root, 0)] if root else []
    while stack:
        node, shared = stack.pop()
        if isinstance(node[1], dict):
            children = [node[1][b] for b in sorted(node[1])]
            stack += [(c, node[0]) for c in reversed(children[1:])] + [(children[0], shared)]
        else:
            order += node[1]
            shared_before += [shared] + [node[0]] * (len(node[1]) - 1)
    return order, shared_before


def deep_shallow(buffer: np.ndarray, starts: np.ndarray, lengths: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, shared prefix with the string before, -1 at the first of a group); groups come in ascending order."""
    n = len(starts)
    order, lcp = np.argsort(groups, kind="stable"), np.full(n, -1, np.int64)
    # a slot of the result belongs to a run of strings that are equal so far
    run = groups[order]
    first = np.r_[True, run[1:] != run[:-1]] if n else np.zeros(0, bool)
    run = np.cumsum(first) - 1
    open_ = np.arange(n)  # slots of runs longer than one
    for depth in range(0, SHALLOW, STEP):
        sizes = np.bincount(run[open_], minlength=1) if len(open_) else np.zeros(1, int)
        open_ = open_[sizes[run[open_]] > 1]
        if not len(open_):
            break
        who = order[open_]
        chars, real = _characters(buffer, starts[who], lengths[who], depth)
        by = np.lexsort((real, chars, run[open_]))
        order[open_], chars, real = who[by], chars[by], real[by]
        inside = np.r_[False, run[open_][1:] == run[open_][:-1]]
        same = _common(chars, np.roll(chars, 1), np.minimum(real, np.roll(real, 1)))
        # strings that end here are equal to each other, but shorter than what follows them
        tied = inside & (chars == np.roll(chars, 1)) & (real == np.roll(real, 1))
        cut = inside & ~tied
        lcp[open_[cut]] = depth + same[cut]
        lcp[open_[tied]] = depth + same[tied]
        starts_here = np.ones(n, bool)
        starts_here[open_[tied]] = False
        keep = np.zeros(n, bool)
        keep[open_] = True
        run = np.cumsum(np.where(keep, starts_here, True)) - 1
    sizes = np.bincount(run, minlength=1) if n else np.zeros(1, int)
    open_ = open_[sizes[run[open_]] > 1]
    if len(open_):
        edges = np.flatnonzero(np.r_[True, run[open_][1:] != run[open_][:-1], True])
        data = buffer.tobytes()
        for low, high in zip(edges[:-1].tolist(), edges[1:].tolist()):
            slots = open_[low:high]
            who = order[slots]
            strings = [data[s + SHALLOW:s + m] if m > SHALLOW else b"" for s, m in zip(starts[who].tolist(), lengths[who].tolist())]
            inner, shared = blind_trie(strings)
            order[slots] = who[inner]
            depth = np.minimum(SHALLOW, lengths[who[inner]])
            lcp[slots[1:]] = depth[1:] + np.asarray(shared[1:], np.int64)
    return order, lcp
