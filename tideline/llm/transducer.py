"""Minimal acyclic transducers: sorted terms to their lexicographic ordinals.

Built term by term from sorted input: what lies off the path of the next term can no longer change,
so it is merged with an equal state seen before. Each step carries the number of terms that branch
off before it; their sum along a term's path is the term's ordinal.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Transducer:
    """Steps are sorted by ``state * 256 + byte``; ``skips`` are terms that come before each step."""

    steps: np.ndarray
    targets: np.ndarray
    skips: np.ndarray
    final: np.ndarray
    start: int
    terms: int

    @staticmethod
    def of(terms: Iterable[bytes]) -> Transducer:
        """From distinct terms in ascending order of their bytes."""
        states: dict[tuple, int] = {}
        reach: list[int] = []  # terms that each state leads to

        def settled(final: bool, edges: list[tuple[int, int]]) -> int:
            shape = (final, *edges)
            state = states.get(shape)
            if state is None:
                state = states[shape] = len(reach)
                reach.append(final + sum(reach[target] for _, target in edges))
            return state

        path: list[list] = [[False, []]]  # the last term's states, as [final, edges]
        last, number = b"", 0

        def settle_to(depth: int) -> None:
            for at in range(len(path) - 1, depth, -1):
                final, edges = path.pop()
                path[-1][1].append((last[at - 1], settled(final, edges)))

        for term in terms:
            if number and term <= last:
                raise ValueError("terms must be distinct and ascending")
            shared, most = 0, min(len(term), len(last))
            while shared < most and term[shared] == last[shared]:
                shared += 1
            settle_to(shared)
            path.extend([False, []] for _ in range(len(term) - shared))
            path[-1][0] = True
            last, number = term, number + 1
        settle_to(0)
        start = settled(*path[0])

        steps, targets, skips = [], [], []
        for (final, *edges), state in states.items():  # in the order of their numbers
            before = int(final)
            for byte, target in edges:
                steps.append(state * 256 + byte)
                targets.append(target)
                skips.append(before)
                before += reach[target]
        final = np.fromiter((shape[0] for shape in states), dtype=bool, count=len(states))
        return Transducer(
            np.array(steps, np.int64), np.array(targets, np.int64), np.array(skips, np.int64), final, start, number
        )

    def to_bytes(self) -> bytes:
        head = np.array([len(self.steps), len(self.final), self.start, self.terms], "<i8")
        parts = [head, self.steps.astype("<i8"), self.targets.astype("<i4"), self.skips.astype("<i4")]
        return b"".join(p.tobytes() for p in parts) + np.packbits(self.final).tobytes()

    @staticmethod
    def from_bytes(data: bytes) -> Transducer:
        n, states, start, terms = (int(x) for x in np.frombuffer(data, "<i8", 4))
        steps = np.frombuffer(data, "<i8", n, 32)
        targets = np.frombuffer(data, "<i4", n, 32 + 8 * n)
        skips = np.frombuffer(data, "<i4", n, 32 + 12 * n)
        final = np.unpackbits(np.frombuffer(data, np.uint8, -1, 32 + 16 * n), count=states).astype(bool)
        return Transducer(steps, targets.astype(np.int64), skips.astype(np.int64), final, start, terms)

    def term(self, ordinal: int) -> bytes:
        """The term of an ordinal: the last step at each state that skips no more than is left."""
        state, left, out = self.start, ordinal, bytearray()
        while not (self.final[state] and left == 0):
            low, high = np.searchsorted(self.steps, [state * 256, state * 256 + 256])
            at = low + int(np.searchsorted(self.skips[low:high], left, "right")) - 1
            out.append(int(self.steps[at]) & 255)
            left -= int(self.skips[at])
            state = int(self.targets[at])
        return bytes(out)


def heads(data: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The first eight bytes of each term as a number that orders as they do; shorter terms end in zeros."""
    if not len(begin):
        return np.zeros(0, np.uint64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.lib.stride_tricks.sliding_window_view(padded, 8)[begin]
    unused = (8 * np.maximum(0, 8 - length)).astype(np.uint64)
    return (np.ascontiguousarray(eight).view(">u8")[:, 0].astype(np.uint64) >> unused) << unused


@dataclass(frozen=True)
class Shelf:
    """Transducers of consecutive ranges of terms side by side, as one machine with many starts.

    ``firsts`` is the number made of the first eight bytes of each range's first term. Ranges do not
    part terms that agree in these.
    """

    machine: Transducer
    starts: np.ndarray
    bases: np.ndarray
    firsts: np.ndarray

    @staticmethod
    def of(parts: list[tuple[int, int, Transducer]]) -> Shelf:
        """From (first number, base ordinal, transducer) in ascending order."""
        states = np.cumsum([0, *(len(t.final) for _, _, t in parts)])
        join = lambda arrays: np.concatenate([*arrays, np.zeros(0, np.int64)])
        machine = Transducer(
            join(t.steps + 256 * s for (_, _, t), s in zip(parts, states)),
            join(t.targets + s for (_, _, t), s in zip(parts, states)),
            join(t.skips for _, _, t in parts),
            np.concatenate([t.final for _, _, t in parts]),
            0, sum(t.terms for _, _, t in parts),
        )
        starts = np.array([t.start + s for (_, _, t), s in zip(parts, states)], np.int64)
        return Shelf(
            machine, starts, np.array([b for _, b, _ in parts], np.int64),
            np.array([f for f, _, _ in parts], np.uint64),
        )

    def ordinals(self, data: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Ordinals of the terms that lie in ``data`` from ``begin`` on; -1 for other terms.

        All terms step together: step k reads the k-th byte of every term that is still on a path.
        """
        out = np.full(len(begin), -1, np.int64)
        if not len(begin) or not len(self.machine.steps):
            return out
        number = heads(data, begin, length)
        shelf = np.searchsorted(self.firsts, number, "right") - 1
        active = np.flatnonzero(shelf >= 0)
        state, total = self.starts[shelf[active]], self.bases[shelf[active]]
        steps, k = self.machine.steps, 0
        while len(active):
            done = length[active] == k
            if done.any():
                ended = done & self.machine.final[state]
                out[active[ended]] = total[ended]
                active, state, total = active[~done], state[~done], total[~done]
            want = state * 256 + data[begin[active] + k]
            at = np.minimum(np.searchsorted(steps, want), len(steps) - 1)
            on = steps[at] == want
            at, active = at[on], active[on]
            state, total = self.machine.targets[at], total[on] + self.machine.skips[at]
            k += 1
        return out

    def term(self, ordinal: int) -> bytes:
        at = int(np.searchsorted(self.bases, ordinal, "right")) - 1
        m = self.machine
        part = Transducer(m.steps, m.targets, m.skips, m.final, int(self.starts[at]), m.terms)
        return part.term(ordinal - int(self.bases[at]))
