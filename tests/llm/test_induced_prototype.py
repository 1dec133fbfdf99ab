"""The full external induced sort of a shard, as a prototype: what op6 would take if all suffixes were sorted by it.

Suffix tuples go through disk-backed priority queues: S* substrings are sorted and named, the string of names is sorted by
recursion, L suffixes are induced from S* suffixes and S suffixes from L suffixes, each with the prefix that it has in common
with its neighbour (at the level of the text; those of S* suffixes by direct comparison). `python tests/llm/test_induced_prototype.py BYTES FOLDER` measures it; the README gives the figures.
"""

import heapq
import marshal
import os
import random
import sys
import time

import numpy as np

MOST = 400


class DiskQueue:
    """A priority queue of tuples: up to `held` in memory, the rest in sorted runs on disk that are read block by block."""

    written = 0

    def __init__(self, folder, held):
        self.folder, self.held, self.heap, self.runs, self.heads = folder, held, [], 0, []

    def push(self, item):
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.held:
            path = os.path.join(self.folder, f"run-{id(self)}-{self.runs}")
            self.heap.sort()
            with open(path, "wb") as f:
                for at in range(0, len(self.heap), 4096):
                    marshal.dump(self.heap[at : at + 4096], f)
            DiskQueue.written += os.path.getsize(path)
            self.heap, self.runs = [], self.runs + 1
            run = self._read(path)
            heapq.heappush(self.heads, (next(run), self.runs, run))

    @staticmethod
    def _read(path):
        with open(path, "rb") as f:
            while True:
                try:
                    yield from marshal.load(f)
                except EOFError:
                    break
        os.remove(path)

    def peek(self):
        best = self.heap[0] if self.heap else None
        return self.heads[0][0] if self.heads and (best is None or self.heads[0][0] < best) else best

    def pop(self):
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            item, n, run = self.heads[0]
            following = next(run, None)
            if following is None:
                heapq.heappop(self.heads)
            else:
                heapq.heapreplace(self.heads, (following, n, run))
            return item
        return heapq.heappop(self.heap)

    def drain(self):
        while (item := self.peek()) is not None:
            yield self.pop()


def common(t, a, b):
    k = 0
    while k < MOST and a + k < len(t) and b + k < len(t) and t[a + k] == t[b + k]:
        k += 1
    return k


def induced(t, folder, held, sign, seeds, wanted, carry):
    """Suffixes of one type in (sign = 1) ascending or (-1) descending order, from seeds in that order: (position, common prefix with the one before of its letter)."""
    queue, low, number, out, last = DiskQueue(folder, held), {}, 0, [], None
    seeds = iter(seeds)
    seed = next(seeds, None)
    while True:
        top = queue.peek()
        if top is None and seed is None:
            return out
        if seed is not None and (top is None or sign * t[seed[0]] < top[0]):
            (at, lcp), seed = seed, next(seeds, None)
            if carry and last is not None and last[1]:
                lcp = common(t, at, last[0]) if t[at] == t[last[0]] else 0
            last = (at, False)
        else:
            letter, _, at, lcp = queue.pop()
            if last is not None and t[last[0]] != t[at]:
                lcp = 0
            out.append((at, lcp))
            last = (at, True)
        for c in low if carry else ():
            low[c] = min(low[c], lcp)
        if at and wanted[at - 1]:
            c = t[at - 1]
            queue.push((sign * c, number, at - 1, min(MOST, low.get(c, -1) + 1)))
            low[c] = MOST
        number += 1


def _sorted(t, folder, held, carry=True):
    """[(position, common prefix)] of all suffixes of numbers whose last is the least and occurs once."""
    n = len(t)
    s_type = [False] * (n - 1) + [True]
    for i in range(n - 2, -1, -1):
        s_type[i] = t[i] < t[i + 1] or (t[i] == t[i + 1] and s_type[i + 1])
    star = [i for i in range(1, n) if s_type[i] and not s_type[i - 1]]
    names, named = DiskQueue(folder, held), DiskQueue(folder, held)
    for i, to in zip(star, [*star[1:], n - 1], strict=True):
        names.push((tuple(2 * t[k] + s_type[k] for k in range(i, to + 1)), i))  # of one letter an S suffix is the larger
    name, before = -1, None
    for text, i in names.drain():
        name += text != before
        before = text
        named.push((i, name))
    reduced = [x for _, x in named.drain()]
    order = [k for k, _ in _sorted(reduced, folder, held, False)] if name + 1 < len(star) else sorted(range(len(star)), key=reduced.__getitem__)
    ranked = [star[k] for k in order]
    seeds = [(i, common(t, i, ranked[k - 1]) if k and carry else 0) for k, i in enumerate(ranked)]
    large = induced(t, folder, held, 1, seeds, [not x for x in s_type], carry)
    after = [*large[1:], (n - 1, 0)]
    small = induced(t, folder, held, -1, [(i, x if t[i] == t[j] else 0) for (i, _), (j, x) in zip(large[::-1], after[::-1], strict=True)], s_type, carry)
    if not carry:
        order = [n - 1, *(i for *_, i in sorted([*((t[i], 0, k, i) for k, (i, _) in enumerate(large)), *((t[i], 1, -k, i) for k, (i, _) in enumerate(small))]))]
        return [(i, 0) for i in order]
    lcps = dict(large) | {i: x for (i, _), (_, x) in zip(small, small[1:], strict=False)}
    order = [n - 1, *(i for *_, i in sorted([*((t[i], 0, k, i) for k, (i, _) in enumerate(large)), *((t[i], 1, -k, i) for k, (i, _) in enumerate(small))]))]
    same = lambda i, j: t[i] == t[j] and s_type[i] == s_type[j]
    return [(i, 0 if not k else lcps[i] if same(i, order[k - 1]) else common(t, i, order[k - 1])) for k, i in enumerate(order)]


def suffix_order(t, folder, held):
    """[(position, common prefix with the suffix before, up to MOST)] of all suffixes of a sequence of numbers."""
    return _sorted([x + 1 for x in t] + [0], folder, held)[1:]


def test_prototype_matches_brute_force(tmp_path):
    r = random.Random(1)
    for k in range(120):
        text = "".join(r.choice("ab" if k % 3 else "abcd") for _ in range(r.randint(1, 60))) * r.choice([1, 1, 2])
        t = list(text.encode())
        found = suffix_order(t, str(tmp_path), 8)
        order = sorted(range(len(t)), key=lambda i: t[i:])
        assert [i for i, _ in found] == order, text
        assert [x for _, x in found] == [0, *(common(t, a, b) for a, b in zip(order, order[1:], strict=False))], text


if __name__ == "__main__":
    import pyarrow.parquet as pq

    size, folder = int(sys.argv[1]), sys.argv[2]
    text = "\x00".join(x or "" for x in pq.read_table("/root/testdata/check_s/documents.parquet", columns=["text"]).column(0).to_pylist()[:5000]).encode()[:size]
    began = time.process_time()
    suffix_order(list(text), folder, 20_000)
    print(f"{len(text)} bytes: {time.process_time() - began:.1f} CPU seconds, {DiskQueue.written / len(text):.1f} bytes through the queues' disk runs for each byte of text")
