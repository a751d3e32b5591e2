"""Periodic run detection (operator 13).

A run is a stretch of consecutive words with smallest period q (words q apart
are the same) that is at least ``max(MIN_WORDS, 2 q)`` long and that no
neighbouring word extends. Each text is compressed, and runs are sought in the
grammar, not in the text:

* Re-Pair: the words' numbers are the first symbols; the most frequent pair of
  neighbouring symbols becomes a new symbol wherever it stands, until no pair
  occurs twice. Places of pairs are kept in lists, so a pair is replaced where it
  stands, without another pass.
* What is left of the text is a sequence of symbols; a balanced tree over it
  makes the rest of the grammar. A run crosses the boundary between the two
  halves of the smallest nonterminal that holds it whole, and this is where it is
  found: once per nonterminal, however often that is derived.
* Runs across a boundary: a run has the words at the boundary again one period
  on, together with at least three on one side. So the periods to try are the
  distances, inside the nonterminal, to the next occurrences of the grams of
  2^k words that touch the boundary, with k by the size of the distance (the
  repeat is at least as long as the period). Each is extended both ways;
  multiples of a period inside its run are passed over.
* Found runs are carried to every place where their nonterminal is derived;
  stretches of one period that overlap by a period are merged, and of the periods
  of one stretch the smallest one stays.

Only ``MIN_WORDS`` decides what a run is; there is no bound on texts, periods or
the number of runs. Each text is one row of one task; texts are independent.

Defined results: a null, empty or blank text has no words and no run; the four
columns of the longest run are then null; repeated rows each get their row;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 12
#: Words of the shortest gram that a repeat is sought by (2^2).
GRAM = 4

Run = tuple[int, int, int]  # start, end, period

FOUND = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, kept binary"


def re_pair(symbols: list[int], fresh: int) -> tuple[list[int], list[tuple[int, int]]]:
    """What is left of ``symbols``, and the rules: symbol ``fresh + i`` derives
    the pair ``rules[i]``. Every rule is used at least twice."""
    n = len(symbols)
    rules: list[tuple[int, int]] = []
    pairs = list(zip(symbols, symbols[1:]))
    times = Counter(pairs)
    places: dict[tuple[int, int], list[int]] = {p: [] for p, c in times.items() if c > 1}
    if not places:
        return symbols, rules
    for i, p in enumerate(pairs):
        if p in places:
            places[p].append(i)
    seq = symbols.copy()  # -1: swallowed by the symbol before
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    queue = [(-len(at), p) for p, at in places.items()]
    heapify(queue)
    while queue:
        most, pair = heappop(queue)
        a, b = pair
        # Where it still stands, without overlaps of itself.
        at, last = [], -1
        for i in places[pair]:
            if seq[i] == a and (j := after[i]) < n and seq[j] == b and i != last:
                at.append(i)
                last = j if a == b else -1
        if len(at) < 2:
            continue
        if len(at) < -most:
            places[pair] = at
            heappush(queue, (-len(at), pair))
            continue
        new = fresh + len(rules)
        rules.append(pair)
        del places[pair]
        met: dict[tuple[int, int], list[int]] = {}
        for i in at:
            j = after[i]
            if seq[i] != a or j >= n or seq[j] != b:
                continue
            seq[i], seq[j] = new, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                met.setdefault((new, seq[k]), []).append(i)
            if (h := before[i]) >= 0:
                met.setdefault((seq[h], new), []).append(h)
        for p, where in met.items():
            if len(where) > 1:
                where = sorted(set(where))
                if len(where) > 1:
                    places[p] = where
                    heappush(queue, (-len(where), p))
    return [s for s in seq if s >= 0], rules


class _Text:
    """Grams of 2^k words of a text, and how far two places agree."""

    def __init__(self, words: np.ndarray):
        self.words, self.n = words, len(words)
        self.grams: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        names = words
        for k in (0, 1):
            names = self._doubled(names, 1 << k)
        self._keep(2, names)

    @staticmethod
    def _doubled(names: np.ndarray, size: int) -> np.ndarray:
        pairs = names[:-size].astype(np.int64) * (int(names.max()) + 1) + names[size:]
        return np.unique(pairs, return_inverse=True)[1]

    def _keep(self, k: int, names: np.ndarray) -> None:
        order = np.argsort(names, kind="stable")
        starts = np.searchsorted(names[order], np.arange(int(names.max()) + 2))
        self.grams[k] = names, order, starts

    def places(self, k: int, i: int, lo: int, hi: int) -> np.ndarray:
        """Where the gram of 2^k words at ``i`` begins, of places in [lo, hi)."""
        if not 0 <= i <= self.n - (1 << k) or lo >= hi:
            return np.zeros(0, np.int64)
        if k not in self.grams:
            # Level by level: the one below is there by now.
            below = k - 1
            if below not in self.grams:
                self.places(below, 0, 0, 1)
            self._keep(k, self._doubled(self.grams[below][0], 1 << below))
        names, order, starts = self.grams[k]
        own = order[starts[names[i]] : starts[names[i] + 1]]
        return own[np.searchsorted(own, lo) : np.searchsorted(own, hi)]

    def forward(self, i: int, j: int, end: int) -> int:
        """How many words from ``i`` on are those from ``j`` on, before ``end``."""
        w, got, step = self.words, 0, 16
        while (left := end - max(i, j) - got) > 0:
            size = min(step, left)
            differ = w[i + got : i + got + size] != w[j + got : j + got + size]
            if differ.any():
                return got + int(differ.argmax())
            got, step = got + size, step * 4
        return got

    def backward(self, i: int, j: int, start: int) -> int:
        """How many words before ``i`` are those before ``j``, from ``start``."""
        w, got, step = self.words, 0, 16
        while (left := min(i, j) - got - start) > 0:
            size = min(step, left)
            differ = (w[i - got - size : i - got] != w[j - got - size : j - got])[::-1]
            if differ.any():
                return got + int(differ.argmax())
            got, step = got + size, step * 4
        return got

    def next_and_last(self) -> tuple[np.ndarray, np.ndarray]:
        """Per place the next and the last place of its gram of GRAM words
        (n and -1: none)."""
        names, order, _ = self.grams[2]
        following = np.full(self.n, self.n)
        previous = np.full(self.n, -1)
        same = names[order[1:]] == names[order[:-1]]
        following[order[:-1][same]] = order[1:][same]
        previous[order[1:][same]] = order[:-1][same]
        return following, previous

    def across(self, b: int, lo: int, hi: int, shortest: int) -> list[Run]:
        """Runs of [lo, hi) that cross the boundary before word ``b``."""
        periods: set[int] = set()
        k, near = 2, 1
        # Distances from 2^(k+1) on by grams of 2^k words, and all below 16 by GRAM.
        while near <= (hi - lo) // 2:
            far, size = 1 << k + 2, 1 << k
            for i in (b - 1, b - size):  # the repeat is on the right
                if i >= lo:
                    periods.update((self.places(k, i, i + near, min(i + far, hi - size + 1)) - i).tolist())
            for i in (b, b - size + 1):  # the repeat is on the left
                if i + size <= hi:
                    periods.update((i - self.places(k, i, max(lo, i - far + 1), i - near + 1)).tolist())
            near, k = far, k + 1
        found: list[Run] = []
        for q in sorted(periods):
            for i, j in ((b, b + q), (b - q, b)):
                if i < lo or j > hi or any(q % p == 0 and s <= i and j <= e for s, e, p in found):
                    continue
                start = i - self.backward(i, j, lo)
                end = j + self.forward(i, j, hi)
                if start < b < end and end - start >= max(shortest, 2 * q):
                    found.append((start, end, q))
        return found


def _merged(found: set[Run]) -> list[Run]:
    """Stretches of one period that overlap by a period are one; of the periods
    of a stretch the smallest stays. By start, then period."""
    whole: dict[tuple[int, int], int] = {}
    held: Run | None = None
    for q, s, e in sorted((q, s, e) for s, e, q in found) + [(0, 0, 0)]:
        if held and held[2] == q and s <= held[1] - q:
            held = held[0], max(held[1], e), q
            continue
        if held:
            whole.setdefault(held[:2], held[2])
        held = s, e, q
    return sorted(((s, e, q) for (s, e), q in whole.items()), key=lambda r: (r[0], r[2]))


def runs(words: list[bytes], shortest: int = MIN_WORDS) -> list[Run]:
    """All runs of a text as (start, end, period), by start, then period."""
    n = len(words)
    if n < shortest:
        return []
    number: dict[bytes, int] = {}
    symbols = [number.setdefault(w, len(number)) for w in words]
    fresh = len(number)
    left, rules = re_pair(symbols, fresh)
    if not rules:
        return []  # no pair of words occurs twice
    # Lengths of what symbols derive, and where those that are left begin.
    length = [1] * fresh
    for a, b in rules:
        length.append(length[a] + length[b])
    starts = [0]
    for s in left:
        starts.append(starts[-1] + length[s])
    # A place for every nonterminal of at least ``shortest`` words.
    first: dict[int, int] = {}
    for s, at in zip(left, starts):
        if s >= fresh and length[s] >= shortest:
            first.setdefault(s, at)
    for s in range(fresh + len(rules) - 1, fresh - 1, -1):
        if s in first:
            a, b = rules[s - fresh]
            for part, at in ((a, first[s]), (b, first[s] + length[a])):
                if part >= fresh and length[part] >= shortest:
                    first.setdefault(part, at)
    text = _Text(np.array(symbols, np.int64))
    following, previous = text.next_and_last()
    if not (previous >= 0).any():
        return []  # no gram that a run would have to repeat
    # Boundaries: of the nonterminals, and between the symbols that are left. In
    # the tree over these, the boundary i is the middle of 2^(d+1) symbols where
    # 2^d is the largest power of 2 that divides i.
    of = np.array(list(first), np.int64)
    lo = np.array([first[s] for s in first], np.int64)
    b = lo + np.array([length[rules[s - fresh][0]] for s in first], np.int64)
    hi = lo + np.array([length[s] for s in first], np.int64)
    place, i = np.array(starts, np.int64), np.arange(1, len(left))
    half = i & -i
    of = np.concatenate((of, np.full(len(i), -1)))
    b, lo = np.concatenate((b, place[i])), np.concatenate((lo, place[i - half]))
    hi = np.concatenate((hi, place[np.minimum(i + half, len(left))]))
    # A repeat of GRAM words that touch the boundary, inside the nonterminal.
    open_ = np.zeros(len(b), bool)
    for at in (b - 1, b - GRAM):
        open_ |= (at >= lo) & (following[np.maximum(at, 0)] + GRAM <= hi)
    for at in (b, b - GRAM + 1):
        open_ |= (at >= lo) & (previous[np.maximum(at, 0)] >= lo)
    open_ &= hi - lo >= shortest
    inside: dict[int, list[Run]] = {}
    found: set[Run] = set()
    for i in np.flatnonzero(open_).tolist():
        for s, e, q in text.across(int(b[i]), int(lo[i]), int(hi[i]), shortest):
            if of[i] < 0:
                found.add((s, e, q))
            else:
                inside.setdefault(int(of[i]), []).append((s - int(lo[i]), e - int(lo[i]), q))
    if inside:
        found |= _derived(inside, left, starts, rules, fresh, length, shortest)
    return _merged(found)


def _derived(inside, left, starts, rules, fresh, length, shortest) -> set[Run]:
    """The runs inside nonterminals at all places where these are derived."""
    holds = set(inside)
    for i, (a, b) in enumerate(rules):  # a rule's parts come before it
        if a in holds or b in holds:
            holds.add(fresh + i)
    places: dict[int, list[np.ndarray]] = {}
    for s in set(left) & holds:
        places[s] = []
    by_symbol: dict[int, list[int]] = {}
    for s, at in zip(left, starts):
        if s in holds:
            by_symbol.setdefault(s, []).append(at)
    for s, at in by_symbol.items():
        places[s].append(np.array(at, np.int64))
    found: set[Run] = set()
    for s in range(fresh + len(rules) - 1, fresh - 1, -1):
        if s not in places:
            continue
        at = np.concatenate(places.pop(s))
        for start, end, q in inside.get(s, ()):
            found.update(zip((at + start).tolist(), (at + end).tolist(), [q] * len(at)))
        a, b = rules[s - fresh]
        if a in holds:
            places.setdefault(a, []).append(at)
        if b in holds:
            places.setdefault(b, []).append(at + length[a])
    return found


def collapse(words: list[bytes], found: list[Run]) -> list[bytes]:
    """The words without those that a run repeats: each run keeps its first
    period, unless another run drops of it."""
    if not found:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, end, q in found:
        change[start + q] += 1
        change[end] -= 1
    drop = np.cumsum(change[:-1]) > 0
    return [w for w, d in zip(words, drop.tolist()) if not d]


def _find(shortest: int):
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n_words, found, kept = [], [], []
            for text in batch["text"]:
                words = text.split()
                own = runs(words, shortest)
                n_words.append(len(words))
                found.append([{"start": s, "length": e - s, "period": q} for s, e, q in own])
                kept.append(b" ".join(collapse(words, own)))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_words": n_words, "runs": found, "kept": kept})

    return find


def periodic_runs(docs: DataFrame, *, shortest: int = MIN_WORDS) -> DataFrame:
    """``doc_id, n_words, runs, kept`` of ``docs(doc_id, text)``: the runs by
    start, then period, and the text with each run collapsed to its first period
    (words joined by one blank, as UTF-8 bytes). Words are what ASCII white space
    separates."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return texts.mapInPandas(_find(shortest), FOUND)


def longest(found: str = "runs") -> Column:
    """``length, start, period`` of the run of greatest length; of several the
    first by start, then period. Null if there is none."""
    top = F.array_max(F.transform(found, lambda r: F.struct(r["length"], (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return F.when(
        F.size(found) > 0,
        F.struct(top["length"].alias("length"), (-top["start"]).alias("start"), (-top["period"]).alias("period")),
    )
