"""Byte-level BPE encoding and decoding of whole texts.

Pre-tokens come from the vectorised scan in ``pretokens``; each distinct slice
is merged once per worker and kept in a cache that is emptied when it reaches
``cache_entries``.  Slices that are not in the cache are merged together, all
words of a batch in the same numpy steps; words above ``LONG`` bytes use a heap.
"""

from __future__ import annotations

import base64
import heapq
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm import pretokens
from strata.llm.common import as_text, by_rows, by_volume, map_arrow

LONG = 64
NONE = np.int64(1) << 40


@dataclass
class Merges:
    """Pairs of token ids that merge: sorted keys, their rank, the id they make; bytes' ids."""

    keys: np.ndarray
    ranks: np.ndarray
    made: np.ndarray
    byte_ids: np.ndarray
    pieces: list[bytes]

    @classmethod
    def of(cls, pairs: dict[tuple[int, int], tuple[int, int]], pieces: list[bytes]) -> "Merges":
        keys = np.array([a << 32 | b for a, b in pairs], np.int64)
        order = np.argsort(keys)
        both = np.array(list(pairs.values()), np.int64).reshape(-1, 2)[order]
        single = {p: i for i, p in enumerate(pieces) if len(p) == 1}
        return cls(keys[order], both[:, 0], both[:, 1], np.array([single[bytes([b])] for b in range(256)], np.int64), pieces)

    @classmethod
    def from_ranks(cls, path: str) -> "Merges":
        """From a rank file: a pair merges when its joined bytes have a rank, lowest rank first."""
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        pairs = {}
        for piece, rank in ranks.items():
            for cut in range(1, len(piece)):
                a, b = ranks.get(piece[:cut]), ranks.get(piece[cut:])
                if a is not None and b is not None:
                    pairs[a, b] = rank, rank
        pieces = [b""] * (max(ranks.values()) + 1)
        for piece, rank in ranks.items():
            pieces[rank] = piece
        return cls.of(pairs, pieces)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], NONE), self.made[at]

    def encode_long(self, word: bytes) -> list[int]:
        """Heap-based merging for one long word: n log n."""
        ids = self.byte_ids[np.frombuffer(word, np.uint8)]
        n = len(ids)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        ranks, made = self.look_up(ids[:-1], ids[1:])
        heap = [(int(r), i, int(m)) for i, (r, m) in enumerate(zip(ranks, made)) if r < NONE]
        heapq.heapify(heap)
        tokens = ids.tolist()
        current = {i: r for r, i, _ in heap}

        def offer(i: int) -> None:
            current.pop(i, None)
            if i >= 0 and after[i] < n:
                r, m = self.look_up(np.array([tokens[i]]), np.array([tokens[after[i]]]))
                if r[0] < NONE:
                    current[i] = int(r[0])
                    heapq.heappush(heap, (int(r[0]), i, int(m[0])))

        while heap:
            rank, i, new = heapq.heappop(heap)
            if current.get(i) != rank:
                continue
            j = after[i]
            tokens[i], after[i] = new, after[j]
            tokens[j] = -1
            current.pop(j, None)
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            offer(before[i])
        return [t for t in tokens if t >= 0]

    def encode(self, words: list[bytes]) -> list[np.ndarray]:
        """Token ids of each (non-empty) word."""
        out: list = [None] * len(words)
        short = [i for i, w in enumerate(words) if len(w) <= LONG]
        for i, w in enumerate(words):
            if len(w) > LONG:
                out[i] = np.array(self.encode_long(w), np.int64)
        if not short:
            return out
        lengths = np.array([len(words[i]) for i in short])
        ids = self.byte_ids[np.frombuffer(b"".join(words[i] for i in short), np.uint8)]
        owner = np.repeat(np.arange(len(short)), lengths)
        done_ids, done_owner = [], []

        def rank_at(i: np.ndarray) -> np.ndarray:
            """Ranks of the pairs that begin at i; none where the word ends."""
            ranks = np.full(len(i), NONE)
            ok = np.flatnonzero(i + 1 < len(ids))
            ok = ok[owner[i[ok]] == owner[i[ok] + 1]]
            ranks[ok] = self.look_up(ids[i[ok]], ids[i[ok] + 1])[0]
            return ranks

        ranks = rank_at(np.arange(len(ids)))
        while len(ids):
            starts = np.concatenate([[True], owner[1:] != owner[:-1]])
            first = np.flatnonzero(starts)
            counts = np.diff(np.append(first, len(ids)))
            place = np.arange(len(ids)) - np.repeat(first, counts)
            best = np.minimum.reduceat(ranks << 8 | place, first)  # lowest rank, then leftmost
            live = best >> 8 < NONE
            at = (first + (best & 255))[live]
            keep = np.repeat(live, counts)
            if not live.all():
                done_ids.append(ids[~keep])
                done_owner.append(owner[~keep])
            ids[at] = self.look_up(ids[at], ids[at + 1])[1]
            keep[at + 1] = False
            at = np.cumsum(keep)[at] - 1
            ids, owner, ranks = ids[keep], owner[keep], ranks[keep]
            ranks[at] = rank_at(at)
            left = at[at > 0] - 1
            ranks[left] = rank_at(left)
        ids, owner = np.concatenate(done_ids), np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        cuts = np.cumsum(np.bincount(owner, minlength=len(short)))[:-1]
        for i, tokens in zip(short, np.split(ids[order], cuts)):
            out[i] = tokens
        return out


class Encoder:
    """A worker's cache of pre-token -> ids, as little-endian unsigned 32-bit integers."""

    def __init__(self, merges: Merges, cache_entries: int) -> None:
        self.merges, self.most = merges, cache_entries
        self.cache: dict[bytes, bytes] = {}
        self.widths = np.array([len(p) for p in merges.pieces], np.int64)

    def texts(self, texts: list[str]) -> Iterator[tuple[bytes, bytes]]:
        """(ids, byte offset of each token in the text) of each text."""
        data, offsets, firsts = pretokens.split(texts)
        at = offsets.tolist()
        slices = [data[a:b] for a, b in zip(at, at[1:])]
        if len(self.cache) > self.most:
            self.cache.clear()
        cache = self.cache
        missing = list({s for s in slices if s not in cache})
        for word, ids in zip(missing, self.merges.encode(missing)):
            cache[word] = ids.astype("<u4").tobytes()
        tokens = list(map(cache.__getitem__, slices))
        for a, b in zip(firsts.tolist(), firsts[1:].tolist()):
            ids = b"".join(tokens[a:b])
            ends = np.cumsum(self.widths[np.frombuffer(ids, "<u4")])
            yield ids, np.concatenate([[0], ends[:-1]]).astype("<u4").tobytes() if len(ends) else b""


def decode_tokens(pieces: list[bytes], ids: bytes, offsets: bytes) -> bytes:
    """The bytes of packed token ids; the retained offsets must fit them."""
    tokens = np.frombuffer(ids, "<u4").tolist()
    text = b"".join(map(pieces.__getitem__, tokens))
    if tokens and int(np.frombuffer(offsets, "<u4")[-1]) + len(pieces[tokens[-1]]) != len(text):
        raise ValueError("token offsets do not fit the ids")
    return text


def encode_documents(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", outputs: tuple[str, ...] = ("token_ids", "token_offsets"),
                     cache_entries: int = 200_000, group_chars: int = 1 << 18) -> DataFrame:
    """Encode every whole text with the rank file at ``vocabulary``.

    Returns ``<id_col>, n_tokens`` and the ``outputs``, one row for each input
    row: token_ids and token_offsets (the byte at which each token begins), both
    as little-endian unsigned 32-bit integers, and decoded, the bytes that ids
    and offsets decode to.  Only the two named columns are read, so others may
    have any name.  A null text counts as empty; an empty text has 0 tokens;
    equal rows give equal rows; no rows give no rows.  The rank file is read on
    the driver and broadcast (its size is fixed, under 1 MB).  Texts are handled
    in runs of about ``group_chars`` code points; a longer text makes its own run.
    """
    shared = df.sparkSession.sparkContext.broadcast(Merges.from_ranks(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value, cache_entries)
        pieces = shared.value.pieces
        for batch in by_rows(batches):
            texts = batch.column(1).to_pylist()
            done = [x for group in by_volume(texts, map(len, texts), group_chars) for x in encoder.texts(group)]
            made = {"token_ids": (ids for ids, _ in done), "token_offsets": (offsets for _, offsets in done),
                    "decoded": (decode_tokens(pieces, ids, offsets) for ids, offsets in done)}
            counts = pa.array([len(ids) // 4 for ids, _ in done], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), counts, *(pa.array(list(made[x]), pa.binary()) for x in outputs)], names=["id", "n_tokens", *outputs])

    rows = df.select(df[id_col].alias("id"), as_text(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = map_arrow(rows, run, f"id {kind}, n_tokens long" + "".join(f", {x} binary" for x in outputs))
    return out.withColumnRenamed("id", id_col)


def decode_documents(df: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "token_ids",
                     offsets_col: str = "token_offsets") -> DataFrame:
    """Decode what ``encode_documents`` returned: ``<id_col>, n_tokens, decoded``.

    Null ids count as none and decode to no bytes.  Ids outside the vocabulary
    and offsets that don't fit raise an error.
    """
    shared = df.sparkSession.sparkContext.broadcast(Merges.from_ranks(vocabulary).pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_rows(batches):
            ids, offsets = (batch.column(i).to_pylist() for i in (1, 2))
            decoded = [decode_tokens(shared.value, x or b"", y or b"") for x, y in zip(ids, offsets)]
            counts = pa.array([len(x or b"") // 4 for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), counts, pa.array(decoded, pa.binary())], names=["id", "n_tokens", "decoded"])

    rows = df.select(df[id_col].alias("id"), df[ids_col].cast("binary").alias("ids"), df[offsets_col].cast("binary").alias("offsets"))
    kind = rows.schema["id"].dataType.simpleString()
    return map_arrow(rows, run, f"id {kind}, n_tokens long, decoded binary").withColumnRenamed("id", id_col)
