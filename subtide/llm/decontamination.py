"""Benchmark decontamination with a generalised suffix automaton.

All test items go into one automaton over words. Training texts stream through
it; after each word the automaton knows the longest suffix that occurs in some
item. Where that length reaches the window, or a whole short item, the words
are hit.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subtide.llm.frames import append_columns, bytes_of, filter_rows
from subtide.session import materialized

#: Words of an automaton; larger benchmarks are cut into several automata.
BLOCK_WORDS = 200_000

# Digits, letters and everything beyond ASCII belong to words; A-Z is lower-cased.
_WORD_BYTES = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_TO_WORDS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _WORD_BYTES else 0x20 for b in range(256))

SPANS = T.StructField("spans", T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType())])))
FIELDS = [
    T.StructField("n_words", T.LongType(), False),
    T.StructField("n_hit", T.LongType(), False),
    T.StructField("items", T.ArrayType(T.StringType(), False), False),
    SPANS,
]

#: Names of what the blocks before have found, while the next one is searched.
EARLIER = {"items": "_earlier_items", "spans": "_earlier_spans"}


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TO_WORDS).split()


class Automaton:
    """Generalised suffix automaton of word sequences, with what a match means."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.words: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = []
        for name, words in items:
            codes = [self.words.setdefault(w, len(self.words)) for w in words]
            coded.append((name, codes))
            last = 0
            for code in codes:
                last = self._extend(last, code)
        size = len(self.words)
        self.pairs = np.unique([a * size + b for _, c in coded for a, b in zip(c, c[1:])]).astype(np.int64)
        self.shortest = min((min(window, len(c)) for _, c in coded if c), default=0)
        self._mark(coded)

    def _state(self, length: int, like: int | None = None) -> int:
        self.next.append(dict(self.next[like]) if like is not None else {})
        self.length.append(length)
        self.link.append(self.link[like] if like is not None else -1)
        return len(self.length) - 1

    def _split(self, state: int, code: int, target: int) -> int:
        """A state for the shorter strings of ``target`` that continue ``state``."""
        copy = self._state(self.length[state] + 1, target)
        self.link[target] = copy
        while state != -1 and self.next[state].get(code) == target:
            self.next[state][code] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, code: int) -> int:
        known = self.next[last].get(code)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, code, known)
        state = self._state(self.length[last] + 1)
        at = last
        while at != -1 and code not in self.next[at]:
            self.next[at][code] = state
            at = self.link[at]
        if at == -1:
            self.link[state] = 0
        else:
            target = self.next[at][code]
            exact = self.length[target] == self.length[at] + 1
            self.link[state] = target if exact else self._split(at, code, target)
        return state

    def _mark(self, coded) -> None:
        """Which items end where: windows by the state of their length, short items by their last state."""
        window, states = self.window, range(len(self.length))
        by_length = sorted(states, key=self.length.__getitem__)
        self.at_window = [-1] * len(states)
        for state in by_length:
            if self.length[state] >= window:
                link = self.link[state]
                self.at_window[state] = state if self.length[link] < window else self.at_window[link]
        self.window_items: dict[int, set] = {}
        self.short_items: dict[int, list] = {}
        for name, codes in coded:
            state = 0
            for n, code in enumerate(codes):
                state = self.next[state][code]
                if n + 1 >= window:
                    self.window_items.setdefault(self.at_window[state], set()).add(name)
            if 0 < len(codes) < window:
                self.short_items.setdefault(state, []).append((len(codes), name))
        self.short_up = [-1] * len(states)
        for state in by_length:
            link = self.link[state]
            self.short_up[state] = state if state in self.short_items else self.short_up[link] if link >= 0 else -1

    def match(self, codes: list[int], names: set) -> np.ndarray:
        """Which words of a sequence are hit; adds the items to ``names``."""
        hit = np.zeros(len(codes), bool)
        nexts, links, lengths, window = self.next, self.link, self.length, self.window
        state = matched = 0
        for n, code in enumerate(codes):
            while state and code not in nexts[state]:
                state = links[state]
                matched = lengths[state]
            if code not in nexts[state]:
                continue
            state = nexts[state][code]
            matched += 1
            if matched >= window:
                hit[n - window + 1 : n + 1] = True
                names |= self.window_items[self.at_window[state]]
            up = self.short_up[state]
            while up != -1:
                for size, name in self.short_items[up]:
                    if size <= matched:
                        hit[n - size + 1 : n + 1] = True
                        names.add(name)
                up = self.short_up[links[up]]
        return hit

    def scan(self, texts: list[bytes]) -> tuple[list[int], list[set], list[list[tuple[int, int]]]]:
        """Words, items and hit spans of each text."""
        counts, codes = [], []
        get = self.words.get
        for text in texts:
            words = words_of(text)
            counts.append(len(words))
            codes.append(np.fromiter(map(get, words, repeat(-1)), np.int64, len(words)))
            codes.append(np.array([-1]))
        names: list[set] = [set() for _ in texts]
        spans: list[list] = [[] for _ in texts]
        if not self.shortest or not texts:
            return counts, names, spans
        flat = np.concatenate(codes)
        begins = np.cumsum(np.array(counts) + 1) - np.array(counts) - 1
        for first, last in self._runs(flat):
            doc = int(np.searchsorted(begins, first, "right")) - 1
            hit = self.match(flat[first : last + 1].tolist(), names[doc])
            edges = np.flatnonzero(np.diff(hit, prepend=False, append=False)).tolist()
            at = first - int(begins[doc])
            spans[doc] += [(at + a, at + b - 1) for a, b in zip(edges[::2], edges[1::2])]
        return counts, names, spans

    def _runs(self, flat: np.ndarray) -> Iterator[tuple[int, int]]:
        """Stretches long enough for a window in which each pair of neighbours occurs in some item."""
        if self.shortest == 1:
            good, extra = flat >= 0, 0
        else:
            keys = flat[:-1] * len(self.words) + flat[1:]
            at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
            good, extra = (self.pairs[at] == keys) & (flat[:-1] >= 0) & (flat[1:] >= 0), 1
        edges = np.flatnonzero(np.diff(good, prepend=False, append=False))
        for first, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if end - first + extra >= self.shortest:
                yield first, end - 1 + extra


def automata(items: DataFrame, window: int, block_words: int, text_column: str, id_column: str) -> Iterator[Automaton]:
    """Automata over at most ``block_words`` words each (a longer item has its own); items come one by one."""
    block, size = [], 0
    for row in items.select(F.col(id_column).cast("string"), F.col(text_column)).toLocalIterator():
        words = words_of((row[1] or "").encode())
        if block and size + len(words) > block_words:
            yield Automaton(block, window)
            block, size = [], 0
        block.append((row[0], words))
        size += len(words)
    if block:
        yield Automaton(block, window)


def _merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if merged and first <= merged[-1][1] + 1:
            merged[-1] = (merged[-1][0], max(merged[-1][1], last))
        else:
            merged.append((first, last))
    return merged


def _scanner(shared, text_column):
    def start():
        automaton = shared.value
        return lambda batch: automaton.scan(bytes_of(batch, text_column))

    return start


def find_spans(
    docs: DataFrame,
    items: DataFrame,
    window: int = 13,
    text_column: str = "text",
    id_column: str = "item_id",
    keep: list[str] | None = None,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Append ``n_words, n_hit, items, spans`` (word positions, inclusive) to each document.

    Null and empty texts have no words; items without words match nothing, items
    without an id hit words but are not listed, repeated items count once.
    Without items nothing is hit. Input columns with these names give way. One
    automaton of at most ``block_words`` words is broadcast at a time; further
    blocks go over the written result of those before.
    """
    sc = docs.sparkSession.sparkContext
    out = None
    for automaton in _or_empty(automata(items, window, block_words, text_column, id_column), window):
        shared = sc.broadcast(automaton)
        before = out is not None
        source = materialized(out, "spans").withColumnsRenamed(EARLIER) if before else docs
        kept = _kept(keep, text_column, before)
        out = append_columns(source, text_column, FIELDS, _start(shared, text_column, before), kept).drop(*EARLIER.values())
    return out if keep is None or text_column in keep else out.drop(text_column)


def _or_empty(blocks: Iterator[Automaton], window: int) -> Iterator[Automaton]:
    some = False
    for automaton in blocks:
        some = True
        yield automaton
    if not some:
        yield Automaton([], window)


def _kept(keep: list[str] | None, text_column: str, before: bool) -> list[str] | None:
    return None if keep is None else [*keep, text_column, *(EARLIER.values() if before else ())]


def _start(shared, text_column: str, before: bool):
    scanner = _scanner(shared, text_column)

    def start():
        scan = scanner()

        def compute(batch):
            counts, names, spans = scan(batch)
            if before:
                names = [n | set(old) for n, old in zip(names, batch.column(EARLIER["items"]).to_pylist())]
                old_spans = batch.column(EARLIER["spans"]).to_pylist()
                spans = [s + [(o["first"], o["last"]) for o in old] for s, old in zip(spans, old_spans)]
            spans = [_merge_spans(s) for s in spans]
            hits = [sum(last - first + 1 for first, last in s) for s in spans]
            listed = [sorted(n for n in own if n is not None) for own in names]
            as_structs = [[{"first": a, "last": b} for a, b in s] for s in spans]
            return [
                pa.array(counts, pa.int64()),
                pa.array(hits, pa.int64()),
                pa.array(listed, pa.list_(pa.string())),
                pa.array(as_structs, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
            ]

        return compute

    return start


def is_contaminated(min_hit: int = 1, share: float = 0.05) -> Column:
    """At least ``min_hit`` hit words that are at least ``share`` of all words."""
    return (F.col("n_hit") >= min_hit) & (F.col("n_hit") >= F.col("n_words") * F.lit(share))


def contaminated() -> Column:
    """The contract's rule: some hit word, and a twentieth of the words or more."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = 13, text_column: str = "text") -> DataFrame:
    """Documents that are not contaminated, all their columns unchanged.

    One pass without a shuffle where one automaton holds all items, which is so
    up to ``BLOCK_WORDS`` words; else the spans of all blocks decide.
    """
    blocks = list(_first_two(automata(items, window, BLOCK_WORDS, text_column, "item_id")))
    if len(blocks) > 1:
        names = {name: f"_in_{name}" for name in docs.columns if name in {f.name for f in FIELDS}}
        found = find_spans(docs.withColumnsRenamed(names), items, window, text_column)
        kept = found.where(~contaminated()).drop(*(f.name for f in FIELDS))
        return kept.withColumnsRenamed({new: old for old, new in names.items()}).select(docs.columns)
    shared = docs.sparkSession.sparkContext.broadcast(blocks[0] if blocks else Automaton([], window))
    scanner = _scanner(shared, text_column)

    def start():
        scan = scanner()

        def compute(batch):
            counts, _, spans = scan(batch)
            hits = [sum(b - a + 1 for a, b in _merge_spans(s)) for s in spans]
            return [not (hit and 20 * hit >= count) for hit, count in zip(hits, counts)]

        return compute

    return filter_rows(docs, text_column, start)


def _first_two(blocks: Iterator[Automaton]) -> Iterator[Automaton]:
    for n, automaton in enumerate(blocks):
        yield automaton
        if n:
            return


def remove_spans(docs: DataFrame, items: DataFrame, window: int = 13, min_words: int = 13, text_column: str = "text") -> DataFrame:
    """Cut hit spans of ``min_words`` words or more out of the texts; what stands around them stays.

    Returns the columns of ``docs``. Null stays null; texts without such spans
    do not change.
    """
    found = find_spans(docs, items, window, text_column)
    names = [f.name for f in found.schema.fields if f.name not in {"n_words", "n_hit", "items", "spans"}]
    schema = T.StructType([found.schema[name] for name in names])

    def run(batches):
        for batch in batches:
            texts = [
                None if text is None else cut_words(text, [s for s in spans if s["last"] - s["first"] + 1 >= min_words])
                for text, spans in zip(batch.column(text_column).to_pylist(), batch.column("spans").to_pylist())
            ]
            arrays = [pa.array(texts, pa.string()) if n == text_column else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return found.mapInArrow(run, schema)


def cut_words(text: str, spans: list[dict]) -> str:
    """The text without the words of the spans and what stands between them."""
    if not spans:
        return text
    data = text.encode()
    plain = data.translate(_TO_WORDS)
    is_word = np.frombuffer(plain, np.uint8) != 0x20
    edges = np.flatnonzero(np.diff(is_word, prepend=False, append=False))
    begins, ends = edges[::2].tolist(), edges[1::2].tolist()
    parts, at = [], 0
    for span in spans:
        parts.append(data[at : begins[span["first"]]])
        at = ends[span["last"]]
    return b"".join([*parts, data[at:]]).decode()
