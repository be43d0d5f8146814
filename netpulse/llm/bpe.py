"""Byte-level BPE encoding and decoding over length-bucketed matrices of token ids."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netpulse.llm.common import slices

#: Longer pieces are encoded one by one, all places of a rank in one round.
WIDEST = 256
#: Token ids in one matrix at most.
CELLS = 1 << 20
#: Pieces a worker remembers; characters taken at once; pieces taken at once from a longer text.
REMEMBERED, CHUNK, SLICE = 100_000, 1 << 20, 200_000
_NONE = np.int32(2**31 - 1)


class Vocabulary:
    """Ranks of a token file: token bytes by id, and a hash table from a pair of ids to the merged id."""

    def __init__(self, path: str):
        self.tokens = _tokens(path)
        self.ids = {token: rank for rank, token in enumerate(self.tokens) if token}
        self.of_byte = np.array([self.ids[bytes([b])] for b in range(256)], np.int32)
        left, right, merged = [], [], []
        for token, rank in self.ids.items():
            for cut in range(1, len(token)):
                a, b = self.ids.get(token[:cut]), self.ids.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), merged.append(rank)
        self._hash(np.array(left, np.int64), np.array(right, np.int64), np.array(merged, np.int32))
        self.known: dict[bytes, bytes] = {}

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _hash(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray) -> None:
        self.bits = max(4, (len(merged) * 3).bit_length())
        size = 1 << self.bits
        self.keys = np.full(size, -1, np.int64)
        self.values = np.full(size, _NONE, np.int32)
        todo = (left << 32) | right
        slots = self._slot(todo)
        while len(todo):
            _, first = np.unique(slots, return_index=True)
            first = first[self.keys[slots[first]] == -1]
            self.keys[slots[first]] = todo[first]
            self.values[slots[first]] = merged[first]
            rest = np.ones(len(todo), bool)
            rest[first] = False
            todo, merged, slots = todo[rest], merged[rest], (slots[rest] + 1) & (size - 1)
        self.mask = size - 1

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id that each pair merges to, or a number above all ids; negative ids are padding."""
        shape = left.shape
        keys = (left.astype(np.int64).ravel() << 32) | (right.astype(np.int64).ravel() & 0xFFFFFFFF)
        keys[(left.ravel() < 0) | (right.ravel() < 0)] = -2
        slots = self._slot(keys)
        seen = self.keys[slots]
        out = np.where(seen == keys, self.values[slots], _NONE)
        open_ = np.flatnonzero((seen != keys) & (seen != -1) & (keys != -2))
        slots = slots[open_]
        while len(open_):
            slots = (slots + 1) & self.mask
            seen = self.keys[slots]
            hit = seen == keys[open_]
            out[open_[hit]] = self.values[slots[hit]]
            more = ~hit & (seen != -1)
            open_, slots = open_[more], slots[more]
        return out.reshape(shape)

    def learn(self, pieces: set[bytes]) -> None:
        """Encode pieces not yet known."""
        buckets: dict[int, list[bytes]] = {}
        for piece in pieces:
            whole = self.ids.get(piece)
            if whole is not None:
                self.known[piece] = whole.to_bytes(4, "little")
            elif len(piece) > WIDEST:
                self.known[piece] = self._encode_long(piece).astype("<u4").tobytes()
            else:
                buckets.setdefault(max(2, 1 << (len(piece) - 1).bit_length()), []).append(piece)
        for width, members in buckets.items():
            rows = max(1, CELLS // width)
            for start in range(0, len(members), rows):
                self._encode_matrix(members[start : start + rows], width)

    def _encode_matrix(self, pieces: list[bytes], width: int) -> None:
        """Every row merges its leftmost pair of least rank each round; finished rows leave."""
        lengths = np.array([len(p) for p in pieces])
        ids = np.full((len(pieces), width), -1, np.int32)
        ids[np.arange(width) < lengths[:, None]] = self.of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
        ranks = np.full((len(pieces), width), _NONE, np.int32)
        ranks[:, :-1] = self.merged(ids[:, :-1], ids[:, 1:])
        who, columns = np.arange(len(pieces)), np.arange(width)
        while len(who):
            best = ranks.argmin(axis=1)
            rank = ranks[np.arange(len(who)), best]
            done = rank == _NONE
            for row in np.flatnonzero(done):
                self.known[pieces[who[row]]] = ids[row, : lengths[row]].astype("<u4").tobytes()
            if done.any():
                ids, ranks, who, lengths, best, rank = (x[~done] for x in (ids, ranks, who, lengths, best, rank))
                if not len(who):
                    return
            row = np.arange(len(who))
            ids[row, best] = rank
            shift = columns + (columns > best[:, None])
            gone = shift >= width
            shift[gone] = width - 1
            ids = np.take_along_axis(ids, shift, 1)
            ids[gone] = -1
            kept = columns + (columns >= best[:, None])
            over = kept >= width
            kept[over] = width - 1
            ranks = np.take_along_axis(ranks, kept, 1)
            ranks[over] = _NONE
            lengths = lengths - 1
            follows = np.minimum(best + 1, width - 1)
            ranks[row, best] = np.where(best + 1 < width, self.merged(ids[row, best], ids[row, follows]), _NONE)
            some = best > 0
            ranks[row[some], best[some] - 1] = self.merged(ids[row[some], best[some] - 1], ids[row[some], best[some]])

    def _encode_long(self, piece: bytes) -> np.ndarray:
        """One row. A round merges all places of the least rank if no pair of lower rank can arise
        between them, else the leftmost place only; the result is that of one merge a round."""
        ids = self.of_byte[np.frombuffer(piece, np.uint8)].copy()
        ranks = self.merged(ids[:-1], ids[1:])
        while len(ranks) and (least := ranks.min()) != _NONE:
            at = np.flatnonzero(ranks == least)
            run = np.r_[0, np.flatnonzero(np.diff(at) > 1) + 1]
            lead = np.repeat(at[run], np.diff(np.r_[run, len(at)]))
            at = at[(at - lead) % 2 == 0]
            while True:
                new = ids.copy()
                new[at] = least
                new = np.delete(new, at + 1)
                place = at - np.arange(len(at))
                fresh = np.delete(ranks, at)
                touched = np.unique(np.r_[place, place - 1])
                touched = touched[(touched >= 0) & (touched < len(new) - 1)]
                changed = self.merged(new[touched], new[touched + 1])
                side = at[1:][np.diff(at) == 2]
                between = self.merged(np.full(len(side), least, np.int32), ids[side])
                if len(at) == 1 or ((changed > least).all() and (between > least).all()):
                    break
                at = at[:1]
            fresh = fresh[: len(new) - 1]
            fresh[touched] = changed
            ids, ranks = new, fresh
        return ids

    def encode(self, texts: list[str | None], pattern: regex.Pattern) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers.

        Texts are taken CHUNK characters at a time, so that new pieces fill large matrices and the
        pieces held stay few; a longer text is taken SLICE pieces at a time.
        """
        out: list[bytes] = []
        held: list[list[bytes]] = []
        size = 0
        for text in texts:
            text = text or ""
            if len(text) > CHUNK:
                out += self._looked_up(held)
                held, size = [], 0
                found = (m.group().encode() for m in pattern.finditer(text))
                parts = iter(lambda: list(islice(found, SLICE)), [])
                out.append(b"".join(x for part in parts for x in self._looked_up([part])))
                continue
            held.append([p.encode() for p in pattern.findall(text)])
            size += len(text)
            if size >= CHUNK:
                out += self._looked_up(held)
                held, size = [], 0
        return out + self._looked_up(held)

    def _looked_up(self, held: list[list[bytes]]) -> list[bytes]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        new = {p for pieces in held for p in pieces if p not in known}
        if new:
            self.learn(new)
        return [b"".join(map(known.__getitem__, pieces)) for pieces in held]

    def decode(self, ids: bytes) -> bytes:
        return _decode(self.tokens, ids)


@lru_cache(maxsize=2)
def _tokens(path: str) -> list[bytes]:
    """Token bytes by id; b"" where an id has none."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in (line.split() for line in lines if line.strip())}
    return [ranks.get(i, b"") for i in range(max(ranks) + 1)]


def _decode(tokens: list[bytes], ids: bytes) -> bytes:
    return b"".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=4)
def _compiled(pattern: str) -> regex.Pattern:
    return regex.compile(pattern)


def encoded(docs: DataFrame, path: str, pattern: str, column: str = "text", into: str = "ids") -> DataFrame:
    """``docs`` with ``into``: the token ids of ``column`` as packed little-endian unsigned 32-bit integers.

    Each match of ``pattern`` is encoded alone; no special tokens. ``path`` names a rank file that
    every executor can open. A null text is empty and has no ids. Rows are independent; other columns
    pass through, except one already named ``into``, which is replaced.
    """
    return _mapped(docs, lambda: [_encoder(path, pattern)], column, [into])


def decoded(df: DataFrame, path: str, column: str = "ids", into: str = "decoded") -> DataFrame:
    """``df`` with ``into``: the bytes that the packed ids of ``column`` stand for; null ids are empty."""
    return _mapped(df, lambda: [_decoder(path)], column, [into])


def encoded_and_decoded(
    docs: DataFrame, path: str, pattern: str, column: str = "text", into: str = "ids", back: str = "decoded"
) -> DataFrame:
    """``docs`` with the ids of :func:`encoded` and what :func:`decoded` makes of those ids.

    Both happen in one Python worker per task, so that an executor holds one vocabulary per core and
    texts and ids cross to Python and back once.
    """
    return _mapped(docs, lambda: [_encoder(path, pattern), _decoder(path)], column, [into, back])


def _encoder(path: str, pattern: str):
    words, pieces = vocabulary(path), _compiled(pattern)
    return lambda texts: words.encode(texts, pieces)


def _decoder(path: str):
    tokens = _tokens(path)
    return lambda packed: [_decode(tokens, ids) if ids else b"" for ids in packed]


def _mapped(df: DataFrame, steps, column: str, into: list[str]) -> DataFrame:
    """``df`` with one binary column per step; each step takes the values that the one before it made."""
    kept = [name for name in df.columns if name not in into]
    source = df.select(F.col(column).alias("_in"), *[F.col(name).alias(f"_c{i}") for i, name in enumerate(kept)])
    made = [f"_made{i}" for i in range(len(into))]
    fields = [*[f"{m} binary" for m in made], *[f"_c{i} {df.schema[name].dataType.simpleString()}" for i, name in enumerate(kept)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = steps()
        for batch in slices(batches):
            values, columns = batch.column(0).to_pylist(), []
            for step in ready:
                values = step(values)
                columns.append(pa.array(values, pa.binary()))
            yield pa.RecordBatch.from_arrays([*columns, *batch.columns[1:]], names=[*made, *batch.schema.names[1:]])

    out = source.mapInArrow(run, ", ".join(fields))
    back = [F.col(m).alias(name) for m, name in zip(made, into)]
    return out.select(*[F.col(f"_c{i}").alias(name) for i, name in enumerate(kept)], *back)
