"""A minimal acyclic transducer: frequent words to token ids, with shared suffixes.

Words are added in order and every state is looked up among the finished ones before it is kept, so equal
suffixes share their states. An arc carries the number of words that sort before those behind it; the sum along a
word's path is the word's place in the list, which is where its ids are. The automaton is flat bytes that a task
maps into memory.
"""

from __future__ import annotations

import mmap
import struct
import tempfile
from collections.abc import Iterable

_HEAD = struct.Struct("<4q")


def compile_words(entries: Iterable[tuple[bytes, list[int]]]) -> bytes:
    """The transducer of ``(word, ids)`` pairs, which come sorted by word and without repeats."""
    entries = list(entries)
    finished: dict[tuple, int] = {}
    states: list[tuple] = []  # (final, ((label, target), ...))
    open_path: list[list] = [[False, []]]

    def close(down_to: int) -> None:
        while len(open_path) > down_to + 1:
            final, arcs = open_path.pop()
            key = (final, tuple(arcs))
            state = finished.get(key)
            if state is None:
                state = finished[key] = len(states)
                states.append(key)
            last = open_path[-1][1]
            last[-1] = (last[-1][0], state)

    before = b""
    for word, _ in entries:
        shared = 0
        for x, y in zip(before, word):
            if x != y:
                break
            shared += 1
        close(shared)
        for label in word[shared:]:
            open_path[-1][1].append((label, -1))
            open_path.append([False, []])
        open_path[-1][0] = True
        before = word
    close(0)
    states.append((open_path[0][0], tuple(open_path[0][1])))

    # Targets are finished before the states that point at them, so one pass counts the words below.
    below: list[int] = []
    first, labels, targets, skips, finals = [0], bytearray(), [], [], bytearray()
    for final, arcs in states:
        passed = int(final)
        for label, target in arcs:
            labels.append(label)
            targets.append(target)
            skips.append(passed)
            passed += below[target]
        below.append(passed)
        first.append(len(labels))
        finals.append(final)
    offsets, ids = [0], []
    for _, word_ids in entries:
        ids.extend(word_ids)
        offsets.append(len(ids))
    head = _HEAD.pack(len(states), len(labels), len(entries), len(ids))
    ints = [first, targets, skips, offsets, ids]
    return head + b"".join(struct.pack(f"<{len(x)}i", *x) for x in ints) + bytes(finals) + bytes(labels)


class Transducer:
    """Looks words up in a compiled transducer that is mapped from a file without a name."""

    def __init__(self, code: bytes):
        file = tempfile.TemporaryFile()
        file.write(code)
        file.flush()
        self._map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        file.close()
        states, arcs, words, ids = _HEAD.unpack(self._map[: _HEAD.size])
        at = _HEAD.size
        views = []
        for n in (states + 1, arcs, arcs, words + 1, ids):
            views.append(memoryview(self._map)[at : at + 4 * n].cast("i"))
            at += 4 * n
        self._first, self._targets, self._skips, self._offsets, self._ids = views
        self._finals, self._labels, self._root = at, at + states, states - 1

    def get(self, word: bytes) -> memoryview | None:
        """The ids of a word as a view of 32-bit integers; None when it is not in the list."""
        state, place, first, find, labels = self._root, 0, self._first, self._map.find, self._labels
        for i in range(len(word)):
            arc = find(word[i : i + 1], labels + first[state], labels + first[state + 1]) - labels
            if arc < 0:
                return None
            place += self._skips[arc]
            state = self._targets[arc]
        if not self._map[self._finals + state]:
            return None
        return self._ids[self._offsets[place] : self._offsets[place + 1]]
