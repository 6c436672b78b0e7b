"""Periodic runs of words, by longest common extensions from suffix trees.

Every run holds a Lyndon root, under the usual order of words or the reversed one, and
that root is the longest Lyndon word at its place.  So each place gives one candidate
for each order; how far its period goes on to the right and to the left are longest common
extensions in the document and its reversal.  Those are depths of common ancestors in
Ukkonen's suffix trees, which a tour of the tree and minima over ranges of it give.

In a run of 24 words and three periods each eight words in a row stand twice or more.
Trees are built for those stretches of a document where that holds; no run leaves them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .frames import bodies, in_batches, rows_of

LEAST_WORDS = 24
LEAST_PERIODS = 3
#: Words in a row that a run repeats: at most a third of LEAST_WORDS, and one more.
SEED = 8
MIX = 0x9E3779B97F4A7C15

Run = tuple[int, int, int]


class SuffixTree:
    """Ukkonen's tree of `text`, whose last symbol 0 stands nowhere else; the other symbols are 1 to `symbols`."""

    def __init__(self, text: list[int], symbols: int):
        self.size, self.width = len(text), symbols + 1
        self.first, self.last, self.child = [0], [0], {}
        self._build(text)
        self._sort_children()

    def _build(self, text: list[int]) -> None:
        first, last, child, width, size = self.first, self.last, self.child, self.width, self.size
        link = [0]
        node = edge = length = waiting = 0  # the active point, and suffixes that are not in the tree yet
        for at, symbol in enumerate(text):
            waiting += 1
            unlinked = 0
            while waiting:
                if not length:
                    edge = at
                key = node * width + text[edge]
                below = child.get(key)
                if below is None:
                    child[key] = len(first)
                    first.append(at)
                    last.append(size)
                    link.append(0)
                    if unlinked:
                        link[unlinked] = node
                        unlinked = 0
                else:
                    begin = first[below]
                    span = last[below] - begin
                    if length >= span:
                        node, edge, length = below, edge + span, length - span
                        continue
                    if text[begin + length] == symbol:
                        if unlinked:
                            link[unlinked] = node
                        length += 1
                        break
                    middle = len(first)
                    first += (begin, at)
                    last += (begin + length, size)
                    link += (0, 0)
                    child[key] = middle
                    child[middle * width + symbol] = middle + 1
                    child[middle * width + text[begin + length]] = below
                    first[below] = begin + length
                    if unlinked:
                        link[unlinked] = middle
                    unlinked = middle
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = at - waiting + 1

    def _sort_children(self) -> None:
        """The children of node v are `order[starts[v]:starts[v + 1]]`, by symbol, the end first."""
        keys = np.fromiter(self.child.keys(), np.int64, len(self.child))
        below = np.fromiter(self.child.values(), np.int64, len(self.child))
        by_key = np.argsort(keys)
        self.order = below[by_key].tolist()
        parents = keys[by_key] // self.width
        self.ends = (keys[by_key] % self.width == 0).tolist()
        self.starts = np.searchsorted(parents, np.arange(len(self.first) + 1)).tolist()
        self.child = None

    def tour(self) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """Depths along the Euler tour, where each suffix's leaf is in it, and the suffixes in order."""
        first, last, order, starts, size = self.first, self.last, self.order, self.starts, self.size
        depths, places, suffixes = [0], [0] * size, []
        path, depth = [(0, starts[0])], [0]
        while path:
            node, at = path.pop()
            if at == starts[node + 1]:
                depth.pop()
                if path:
                    depths.append(depth[-1])
                continue
            path.append((node, at + 1))
            below = order[at]
            deeper = depth[-1] + last[below] - first[below]
            if starts[below] == starts[below + 1]:
                places[size - deeper] = len(depths)
                suffixes.append(size - deeper)
                depths += (deeper, depth[-1])
            else:
                depths.append(deeper)
                path.append((below, starts[below]))
                depth.append(deeper)
        return np.array(depths, np.int64), np.array(places, np.int64), suffixes

    def reversed_order(self) -> list[int]:
        """The suffixes in the order of reversed symbols; the end still comes before all others."""
        order, starts, ends, first, last, size = self.order, self.starts, self.ends, self.first, self.last, self.size
        found, path = [], [(0, 0)]
        while path:
            node, depth = path.pop()
            begin, end = starts[node], starts[node + 1]
            if begin == end:
                found.append(size - depth)
                continue
            # The last one pushed is visited first.
            rest = order[begin:end]
            if ends[begin]:
                rest = [*rest[1:], rest[0]]
            path += [(below, depth + last[below] - first[below]) for below in rest]
        return found


def extensions(tree: SuffixTree, depths: np.ndarray, places: np.ndarray, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """How many symbols the suffixes at `one` and `other` have in common: the depth of their leaves' common ancestor.

    Minima over ranges of the tour, by tables for ranges of 1, 2, 4 and so on, of which two cover each range.
    """
    a, b = places[one], places[other]
    low, high = np.minimum(a, b), np.maximum(a, b)
    level = np.log2(high - low + 1).astype(np.int64)
    found = np.zeros(len(one), np.int64)
    minima = depths
    for size in range(int(level.max(initial=-1)) + 1):
        at = np.flatnonzero(level == size)
        found[at] = np.minimum(minima[low[at]], minima[high[at] + 1 - (1 << size)])
        step = 1 << size
        minima = np.minimum(minima[:-step], minima[step:])
    return found


def next_smaller(ranks: list[int]) -> list[int]:
    """For each suffix where the next smaller one starts: there its longest Lyndon word ends."""
    size = len(ranks)
    found = [size] * size
    for at in range(size - 2, -1, -1):
        after, own = at + 1, ranks[at]
        while after < size and ranks[after] > own:
            after = found[after]
        found[at] = after
    return found


def runs_in(symbols: np.ndarray) -> set[Run]:
    """(start, length, period) of all runs of LEAST_WORDS and LEAST_PERIODS in a stretch; symbols are 1 and more."""
    size, most = len(symbols), int(symbols.max())
    forward, backward = SuffixTree([*symbols.tolist(), 0], most), SuffixTree([*symbols[::-1].tolist(), 0], most)
    depths, places, suffixes = forward.tour()
    back_depths, back_places, _ = backward.tour()
    found: set[Run] = set()
    for order in (suffixes, forward.reversed_order()):
        ranks = np.empty(size + 1, np.int64)
        ranks[order] = np.arange(size + 1)
        ends = np.array(next_smaller(ranks[:size].tolist()), np.int64)
        begins = np.arange(size)
        period = ends - begins
        right = extensions(forward, depths, places, begins, ends)
        left = extensions(backward, back_depths, back_places, size - begins, size - ends)
        length = left + period + right
        good = np.flatnonzero((length >= LEAST_WORDS) & (length >= LEAST_PERIODS * period))
        found.update(zip((begins - left)[good].tolist(), length[good].tolist(), period[good].tolist(), strict=True))
    return found


def stretches(ids: np.ndarray) -> Iterator[tuple[int, int]]:
    """(begin, end) of the stretches of LEAST_WORDS or more whose every SEED words stand twice or more in the document.

    Equal hashes of different words only make stretches longer.
    """
    if len(ids) < LEAST_WORDS:
        return
    hashes, size = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(MIX), 1
    while size < SEED:
        factor = np.uint64(pow(MIX, 2 * size + 1, 1 << 64))
        hashes = (hashes[:-size] ^ (hashes[:-size] >> np.uint64(29))) * factor + hashes[size:]
        size *= 2
    by_value = np.sort(hashes)
    again = np.unique(by_value[1:][by_value[1:] == by_value[:-1]])
    if not len(again):
        return
    repeated = np.concatenate(([False], again[np.minimum(np.searchsorted(again, hashes), len(again) - 1)] == hashes, [False]))
    edges = np.flatnonzero(repeated[1:] != repeated[:-1])
    for begin, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        if end - begin + SEED - 1 >= LEAST_WORDS:
            yield begin, end + SEED - 1


def periodic(words: list[bytes]) -> list[Run]:
    """All runs of a document, by start and period."""
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    found: list[Run] = []
    for begin, end in stretches(ids):
        symbols = np.unique(ids[begin:end], return_inverse=True)[1] + 1
        found += [(begin + start, length, period) for start, length, period in runs_in(symbols)]
    return sorted(found, key=lambda run: (run[0], run[2]))


def strongest(runs: list[Run]) -> Run | None:
    """The run of the greatest length / period, compared exactly; of equal ones the first, then the shortest period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    covered = np.cumsum(change[:-1]) > 0
    return [word for word, gone in zip(words, covered.tolist(), strict=True) if not gone]


def words_of(doc_id: int | None, body: bytes) -> list[bytes]:
    return body.split()


def periodic_runs(docs: DataFrame, words_of: Callable[[int | None, bytes], list[bytes]] = words_of) -> DataFrame:
    """The periodic runs of every row of `docs`, whole texts.

    doc_id, n_words, n_runs, the strongest run (start, length, period, exponent_milli; null without
    a run), `runs` (all of them), `kept_text` (the words that stay, joined by a space) and the digests of
    both.  `words_of` gives the words of a row, by default those of its text.  A null or empty
    text has no words and no run.  Repeated rows and rows with a null id are judged each for itself;
    an empty table gives an empty result.  A task's memory follows the longest stretch of one text.
    """
    span = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    numbers = ("n_words", "n_runs", "start", "length", "period", "exponent_milli")
    schema = pa.schema(
        [("doc_id", pa.int64()), *((n, pa.int64()) for n in numbers), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string()), ("runs", pa.list_(span)), ("kept_text", pa.string())]
    )

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for doc_id, body in rows_of(batches):
            words = words_of(doc_id, body or b"")
            runs = periodic(words)
            best = strongest(runs)
            kept = b" ".join(collapsed(words, runs))
            lines = "".join(f"{start},{length},{period}\n" for start, length, period in runs)
            yield (
                doc_id,
                len(words),
                len(runs),
                *(best or (None, None, None)),
                best and 1000 * best[1] // best[2],
                hashlib.sha256(lines.encode()).hexdigest(),
                hashlib.sha256(kept).hexdigest(),
                [dict(zip(("start", "length", "period"), run, strict=True)) for run in runs],
                kept.decode("utf-8", "replace"),
            )

    kinds = ", ".join(f"{n} long" for n in ("doc_id", *numbers))
    kinds += ", runs_sha256 string, collapsed_sha256 string, runs array<struct<start: long, length: long, period: long>>, kept_text string"
    return bodies(docs).mapInArrow(lambda batches: in_batches(judged(batches), schema, 256), kinds)
