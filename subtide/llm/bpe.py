"""Byte-pair encoding and decoding with forced boundaries.

A pair of bytes that lies inside no token of the vocabulary can never be joined
by a merge, so a text may be cut there for certain. Texts are cut at such pairs
first (before white space that follows a visible character, and before a stop
that follows a letter or digit), each distinct fragment is encoded once per task,
and the ids of the fragments are put together again. Inside a fragment the pre-tokens are cut at all further pairs of that
kind, and all fragments of a batch are merged at once, round by round.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from subtide.llm.frames import append_columns, prepare_workers, ragged, texts_of

#: Fixed value: the pattern of byte-level pre-tokens.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Bytes of remembered fragments and their ids, about, before a task starts anew; ENTRY is the share of one fragment.
MEMORY, ENTRY = 48 << 20, 200

#: Texts are cut before these signs. A stop after another sign, and white space
#: after white space, is no certain cut; such texts are cut at pre-tokens only.
STOPS = ",."
CUTS = " \n" + STOPS
MARK = "\0"
STOP, SIGN, RISK = 1, 2, 4


def byte_letters() -> dict[str, int]:
    """Letters that stand for bytes in the vocabulary file: printable bytes stand for themselves."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(others)}


class Store:
    """Growing list of id sequences, read in bulk."""

    def __init__(self):
        self.values, self.used = np.empty(1 << 16, np.int32), 0
        self.start, self.length, self.count = np.empty(1 << 12, np.int64), np.empty(1 << 12, np.int64), 0

    def add(self, values: np.ndarray, lengths: np.ndarray) -> None:
        while self.used + len(values) > len(self.values):
            self.values = np.concatenate([self.values, np.empty_like(self.values)])
        while self.count + len(lengths) > len(self.start):
            self.start = np.concatenate([self.start, np.empty_like(self.start)])
            self.length = np.concatenate([self.length, np.empty_like(self.length)])
        self.values[self.used : self.used + len(values)] = values
        new = slice(self.count, self.count + len(lengths))
        self.start[new] = self.used + np.cumsum(lengths) - lengths
        self.length[new] = lengths
        self.used += len(values)
        self.count += len(lengths)

    def get(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = self.length[codes]
        return self.values[ragged(self.start[codes], lengths)], lengths

    def bytes(self) -> int:
        return self.values.nbytes + self.start.nbytes + self.length.nbytes


class Codes(dict):
    """Number of each key; keys met for the first time wait in ``new``."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, key):
        self.new.append(key)
        code = self[key] = len(self)
        return code


class ByteBPE:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        vocabulary = spec["model"]["vocab"]
        self.special = {token["content"]: token["id"] for token in spec["added_tokens"]}
        size = max([*vocabulary.values(), *self.special.values()]) + 1
        self.tokens = [b""] * size
        for token, number in vocabulary.items():
            self.tokens[number] = raw(token)
        for token, number in self.special.items():
            self.tokens[number] = token.encode()
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        left, right = (np.array([vocabulary[p[side]] for p in pairs], np.int64) for side in (0, 1))
        self.size = size
        self.byte_id = np.array([vocabulary[c] for c, b in sorted(letters.items(), key=lambda x: x[1])], np.int64)
        order = np.argsort(left * size + right)
        self.pair_keys = (left * size + right)[order]
        self.pair_rank = order.astype(np.int64)
        self.merged = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        self.inside = np.zeros((256, 256), bool)
        for token in vocabulary:
            data = np.frombuffer(raw(token), np.uint8)
            self.inside[data[:-1], data[1:]] = True
        joined = regex.compile(r"\S[ \n]|[\p{L}\p{N}][" + regex.escape(STOPS) + "]")
        self.certain = not any(joined.search(raw(token).decode("utf-8", "ignore")) for token in vocabulary)
        self.byte_length = np.array([len(t) for t in self.tokens], np.int64)
        self.byte_start = np.cumsum(self.byte_length) - self.byte_length
        self.flat_bytes = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.pre_token = regex.compile(PRE_TOKEN)
        special = sorted(self.special, key=len, reverse=True)
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.forget()

    def forget(self) -> None:
        self.pieces, self.piece_ids = Codes(), Store()
        self.chunks, self.chunk_ids = Codes(), Store()
        self.flags = np.zeros(1 << 12, np.int8)

    def remembered(self) -> int:
        """Bytes of the fragments met so far, about. Longer fragments than usual count through their ids."""
        return (len(self.chunks) + len(self.pieces)) * ENTRY + 2 * (self.chunk_ids.bytes() + self.piece_ids.bytes())

    # --- merging -------------------------------------------------------------

    def _merge(self, data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of byte fragments, and the byte position where each id begins."""
        symbols, place = self.byte_id[data], np.arange(len(data))
        group = np.cumsum(first) - 1
        done_symbols, done_places = [], []
        none = len(self.merged)
        while len(symbols):
            rank = np.full(len(symbols), none, np.int64)
            keys = symbols[:-1] * self.size + symbols[1:]
            at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
            hit = (self.pair_keys[at] == keys) & (group[:-1] == group[1:])
            rank[:-1][hit] = self.pair_rank[at[hit]]
            begins = np.flatnonzero(np.diff(group, prepend=group[0] - 1))
            sizes = np.diff(begins, append=len(symbols))
            least = np.repeat(np.minimum.reduceat(rank, begins), sizes)
            finished = least == none
            if finished.any():
                done_symbols.append(symbols[finished])
                done_places.append(place[finished])
            chosen = np.flatnonzero((rank == least) & ~finished)
            # In a run of one symbol the pairs overlap: every second one counts, from the left.
            run = np.cumsum(np.diff(chosen, prepend=-2) != 1)
            order = np.arange(len(chosen)) - np.searchsorted(run, run)
            chosen = chosen[order % 2 == 0]
            symbols[chosen] = self.merged[rank[chosen]]
            stays = ~finished
            stays[chosen + 1] = False
            symbols, place, group = symbols[stays], place[stays], group[stays]
        if not done_symbols:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        symbols, place = np.concatenate(done_symbols), np.concatenate(done_places)
        order = np.argsort(place)
        return symbols[order], place[order]

    def _learn_pieces(self) -> None:
        """Encode the pre-tokens met for the first time."""
        new, self.pieces.new = self.pieces.new, []
        if not new:
            return
        encoded = [piece.encode() for piece in new]
        data = np.frombuffer(b"".join(encoded), np.uint8)
        lengths = np.array([len(e) for e in encoded], np.int64)
        begins = np.cumsum(lengths) - lengths
        first = np.zeros(len(data), bool)
        first[1:] = ~self.inside[data[:-1], data[1:]]
        first[begins] = True
        ids, place = self._merge(data, first)
        self.piece_ids.add(ids, np.diff(np.searchsorted(place, begins), append=len(ids)))

    def _ids_of_pieces(self, lists: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        codes = np.array([code for pieces in lists for code in map(self.pieces.__getitem__, pieces)], np.int64)
        self._learn_pieces()
        ids, lengths = self.piece_ids.get(codes)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        bounds = np.concatenate([[0], np.cumsum([len(p) for p in lists])]).astype(np.int64)
        return ids, np.diff(ends[bounds])

    # --- texts ---------------------------------------------------------------

    def _learn_chunks(self) -> None:
        new, self.chunks.new = self.chunks.new, []
        if not new:
            return
        find = self.pre_token.findall
        ids, lengths = self._ids_of_pieces([[c] if c[1:].isalpha() and c[0] == " " else find(c) for c in new])
        first = self.chunk_ids.count
        self.chunk_ids.add(ids, lengths)
        while self.chunk_ids.count > len(self.flags):
            self.flags = np.concatenate([self.flags, np.zeros_like(self.flags)])
        self.flags[first : self.chunk_ids.count] = list(map(self._flag, new))

    def _flag(self, chunk: str) -> int:
        """How a chunk ends and begins; cuts next to it are certain only for some neighbours."""
        last = chunk[-1:]
        if last.isspace():
            return RISK
        return (0 if last.isalnum() else SIGN) | (STOP if chunk[0] in STOPS else 0)

    def _whole(self, text: str) -> np.ndarray:
        """Ids of a text that is cut at pre-tokens only."""
        parts = []
        for part in self.special_split.split(text) if self.special_split else [text]:
            if part in self.special:
                parts.append(np.array([self.special[part]], np.int32))
            elif part:
                parts.append(self._ids_of_pieces([self.pre_token.findall(part)])[0])
        return np.concatenate(parts) if parts else np.empty(0, np.int32)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the number of ids of each text."""
        if self.remembered() > MEMORY:
            self.forget()
        if not self.certain:
            whole = [self._whole(text) for text in texts]
            return np.concatenate([np.empty(0, np.int32), *whole]), np.array([len(w) for w in whole], np.int64)
        codes, counts = [], []
        number, never = self.chunks.__getitem__, [MARK, *self.special]
        for text in texts:
            marked = text
            for sign in CUTS:
                marked = marked.replace(sign, MARK + sign)
            chunks = marked.split(MARK)
            if not chunks[0]:
                del chunks[0]
            counts.append(len(chunks))
            codes.extend(map(number, chunks))
        self._learn_chunks()
        codes, counts = np.array(codes, np.int64), np.array(counts, np.int64)
        ids, id_counts = self.chunk_ids.get(codes)
        bounds = np.concatenate([[0], np.cumsum(counts)])
        ends = np.concatenate([[0], np.cumsum(id_counts)])[bounds]
        flags = self.flags[codes]
        risky = flags == RISK
        # After a sign, a stop goes on with the same pre-token.
        risky[1:] |= ((flags[:-1] & SIGN) > 0) & ((flags[1:] & STOP) > 0)
        risks = np.concatenate([[0], np.cumsum(risky)])[bounds]
        parts, lengths = [], np.diff(ends)
        for n in np.flatnonzero((np.diff(risks) > 0) | [any(x in text for x in never) for text in texts]).tolist():
            whole = self._whole(texts[n])
            parts.append((n, whole))
            lengths[n] = len(whole)
        if not parts:
            return ids, lengths
        out, at = [], 0
        for n, whole in parts:
            out += [ids[at : ends[n]], whole]
            at = ends[n + 1]
        return np.concatenate([*out, ids[at:]]).astype(np.int32), lengths

    def decode(self, ids: np.ndarray, lengths: np.ndarray) -> list[str]:
        """Texts of id sequences; bytes that are no UTF-8 become the replacement character."""
        data = self.flat_bytes[ragged(self.byte_start[ids], self.byte_length[ids])].tobytes()
        sizes = np.concatenate([[0], np.cumsum(self.byte_length[ids])])
        bounds = sizes[np.concatenate([[0], np.cumsum(lengths)])].tolist()
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(bounds, bounds[1:])]


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBPE:
    """One coder per Python worker and file."""
    return ByteBPE(path)


IDS = T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)
DECODED = T.StructField("decoded", T.StringType(), False)


def encode_documents(
    docs: DataFrame, path: str, text_column: str = "text", keep: list[str] | None = None, decoded: bool = False
) -> DataFrame:
    """Append ``ids``, the token ids of the whole text, and with ``decoded`` the text that they give back.

    Null and empty texts have no ids and decode to the empty text. All rows
    stay, repeated ones too; input columns ``ids`` and (with ``decoded``)
    ``decoded`` give way. ``keep`` limits the columns that are kept.
    ``path`` is the vocabulary file, present on every machine. Both
    directions share one step, so a task has one coder.
    """

    def start():
        coder = byte_bpe(path)

        def compute(batch):
            ids, lengths = coder.encode(texts_of(batch, text_column))
            offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            arrays = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))]
            return arrays + ([pa.array(coder.decode(ids, lengths), pa.string())] if decoded else [])

        return compute

    return append_columns(docs, text_column, [IDS, DECODED] if decoded else [IDS], start, keep)


def decode_documents(encoded: DataFrame, path: str, ids_column: str = "ids") -> DataFrame:
    """Append ``decoded``, the text of the ids; null or no ids give the empty text."""
    prepare_workers(encoded.sparkSession)
    names = [f for f in encoded.schema.fields if f.name.lower() != "decoded"]

    def run(batches):
        coder = byte_bpe(path)
        for batch in batches:
            lists = batch.column(ids_column)
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            lengths = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            texts = coder.decode(ids, lengths)
            arrays = [batch.column(f.name) for f in names] + [pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, [*(f.name for f in names), "decoded"])

    return encoded.mapInArrow(run, T.StructType([*names, DECODED]))
