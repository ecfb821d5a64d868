"""Minimal acyclic transducer over sorted byte strings: each string's output is its place in their order.

Built in one pass over sorted strings: what the next string does not share with the last one is closed, and a closed state
is replaced by an equal one that exists.  States know how many strings end below them; an arc puts out how
many come before it, so the outputs along a string add up to its ordinal.  The machine is four arrays, and strings are run through it in
step, one byte of all of them at a time.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np


class Transducer:
    """``arcs`` state * 256 + byte, ascending; ``targets`` and ``outputs`` of each arc; ``final`` for each state."""

    def __init__(self, arcs: np.ndarray, targets: np.ndarray, outputs: np.ndarray, final: np.ndarray, root: int, size: int):
        self.arcs, self.targets, self.outputs, self.final, self.root, self.size = arcs, targets, outputs, final, root, size

    @classmethod
    def build(cls, ordered: Iterable[bytes]) -> Transducer:
        """The machine of different strings in ascending order."""
        register: dict[tuple, int] = {}
        below: list[int] = []
        arcs: list[int] = []
        targets: list[int] = []
        outputs: list[int] = []
        final: list[bool] = []

        def closed(ends: bool, out: list[tuple[int, int]]) -> int:
            shape = (ends, *out)
            state = register.get(shape)
            if state is None:
                state = register[shape] = len(below)
                before = int(ends)
                for byte, target in out:
                    arcs.append(state << 8 | byte)
                    targets.append(target)
                    outputs.append(before)
                    before += below[target]
                below.append(before)
                final.append(ends)
            return state

        open_: list[list] = [[False, []]]
        last = b""
        for n, string in enumerate(ordered, 1):
            shared = _shared(last, string)
            if n > 1 and string <= last:
                raise ValueError("strings must be different and ascending")
            for at in range(len(last), shared, -1):
                ends, out = open_.pop()
                open_[-1][1].append((last[at - 1], closed(ends, out)))
            open_ += [[False, []] for _ in range(len(string) - shared)]
            open_[-1][0] = True
            last = string
        for at in range(len(last), 0, -1):
            ends, out = open_.pop()
            open_[-1][1].append((last[at - 1], closed(ends, out)))
        root = closed(*open_[0])
        return cls(np.array(arcs, np.int64), np.array(targets, np.int32), np.array(outputs, np.int64), np.array(final, bool), root, below[root])

    def ordinals(self, strings: list[bytes]) -> np.ndarray:
        """The ordinal of each string, -1 for those that are not in the machine."""
        out = np.full(len(strings), -1, np.int64)
        if not strings or not self.size:
            return out
        lengths = np.fromiter(map(len, strings), np.int64, len(strings))
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        data = np.frombuffer(b"".join(strings), np.uint8)
        alive, states, sums, step = np.arange(len(strings)), np.full(len(strings), self.root, np.int64), np.zeros(len(strings), np.int64), 0
        while len(alive):
            ended = lengths[alive] == step
            done = ended & self.final[states]
            out[alive[done]] = sums[done]
            alive, states, sums = alive[~ended], states[~ended], sums[~ended]
            if not len(alive) or not len(self.arcs):
                break
            wanted = states << 8 | data[starts[alive] + step]
            at = np.minimum(np.searchsorted(self.arcs, wanted), len(self.arcs) - 1)
            found = self.arcs[at] == wanted
            at = at[found]
            alive, states, sums, step = alive[found], self.targets[at].astype(np.int64), sums[found] + self.outputs[at], step + 1
        return out

    def spelled(self, ordinal: int) -> bytes:
        """The string of an ordinal."""
        if not 0 <= ordinal < self.size:
            raise IndexError(ordinal)
        out, state = bytearray(), self.root
        while ordinal or not self.final[state]:
            lo, hi = np.searchsorted(self.arcs, [state << 8, (state + 1) << 8])
            at = lo + int(np.searchsorted(self.outputs[lo:hi], ordinal, "right")) - 1
            out.append(int(self.arcs[at]) & 255)
            ordinal -= int(self.outputs[at])
            state = int(self.targets[at])
        return bytes(out)

    def packed(self) -> bytes:
        head = np.array([len(self.arcs), len(self.final), self.root, self.size], np.int64)
        return b"".join(x.tobytes() for x in (head, self.arcs, self.outputs, self.targets, self.final))

    @classmethod
    def unpacked(cls, data: bytes) -> Transducer:
        arcs, states, root, size = np.frombuffer(data, np.int64, 4).tolist()
        at, parts = 32, []
        for kind, n in ((np.int64, arcs), (np.int64, arcs), (np.int32, arcs), (bool, states)):
            parts.append(np.frombuffer(data, kind, n, at))
            at += parts[-1].nbytes
        return cls(parts[0], parts[2], parts[1], parts[3], root, size)


def _shared(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo = 0
    while n - lo > 8:  # halve until the first difference is near
        middle = (lo + n) // 2
        lo, n = (middle, n) if a[lo:middle] == b[lo:middle] else (lo, middle)
    while a[lo] == b[lo]:
        lo += 1
    return lo
