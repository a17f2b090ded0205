"""Token counts of whole texts by a byte-level BPE tokenizer file, map-side only.

Two tiers stand before the merges.  The first is a compact hash table of the
corpus' most frequent pre-tokens and their token counts: arrays of at most
``table_entries`` entries, so its size is fixed, broadcast once and looked up
for a whole batch in a few numpy steps.  Its entries are exact (pre-tokens of
up to 15 bytes are their own key).  The second is a cache in each worker.  What
neither holds is merged.  The frequent pre-tokens are found in a pass over all
documents in which each task keeps a bounded summary of heavy pre-tokens; only
these summaries meet, no pre-token of a text is shuffled.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import pretokens
from strata.llm.bpe import Merges
from strata.llm.common import as_text, by_volume, map_arrow, mix64

KEY_BYTES = 15


def byte_symbols() -> dict[str, int]:
    """The printable stand-ins of the 256 bytes in byte-level vocabulary files: printable
    Latin-1 stands for itself, the other bytes are numbered from code point 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


def load(path: str) -> tuple[Merges, list[str]]:
    """Merges and special strings of a byte-level BPE file of the tokenizers library."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, before = spec["model"], spec["pre_tokenizer"]
    plain = (spec.get("normalizer") is None and before["type"] == "ByteLevel" and not before["add_prefix_space"]
             and before.get("use_regex", True) and not model.get("ignore_merges") and not model.get("dropout"))
    if model["type"] != "BPE" or not plain or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
        raise ValueError(f"{path} is not a plain byte-level BPE tokenizer")
    vocab, symbols = model["vocab"], byte_symbols()
    special = [t["content"] for t in spec["added_tokens"]]
    pieces = [b""] * (max(vocab.values()) + 1)
    for piece, i in vocab.items():
        if piece not in special:
            pieces[i] = bytes(symbols[c] for c in piece)
    pairs = {}
    for rank, merge in enumerate(model["merges"]):
        a, b = merge.split(" ") if isinstance(merge, str) else merge
        pairs.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
    return Merges.of(pairs, pieces), special


def keys_of(data: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two 64-bit words that hold each slice of up to 15 bytes and its length; which fit."""
    starts, lengths = offsets[:-1], np.diff(offsets)
    padded = np.frombuffer(data + bytes(16), np.uint8)
    words = np.ndarray((len(padded) - 7,), "<u8", padded, 0, (1,))
    fits = lengths <= KEY_BYTES
    masks = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)
    low = words[starts] & masks[np.minimum(lengths, 8)]
    high = words[np.minimum(starts + 8, len(words) - 1)] & masks[np.clip(lengths - 8, 0, 7)]
    return low, high | lengths.astype(np.uint64) << np.uint64(56), fits


@dataclass
class FrequentTable:
    """Open addressing with linear probing, at most half full; count 0 marks a free slot."""

    low: np.ndarray
    high: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, low: np.ndarray, high: np.ndarray, counts: np.ndarray) -> "FrequentTable":
        slots = 1 << max(4, int(2 * len(low) - 1).bit_length())
        table = cls(np.zeros(slots, np.uint64), np.zeros(slots, np.uint64), np.zeros(slots, np.uint8))
        for a, b, n, at in zip(low, high, counts, table._slot(low, high).tolist()):
            while table.counts[at]:
                at = (at + 1) & (slots - 1)
            table.low[at], table.high[at], table.counts[at] = a, b, n
        return table

    def _slot(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return (mix64(low ^ mix64(high)) & np.uint64(len(self.low) - 1)).astype(np.int64)

    def look_up(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Token counts, 0 where there is no entry."""
        found = np.zeros(len(low), np.int64)
        left = np.arange(len(low))
        at = self._slot(low, high)
        while len(left):
            here = self.counts[at]
            hit = (here > 0) & (self.low[at] == low[left]) & (self.high[at] == high[left])
            found[left[hit]] = here[hit]
            on = (here > 0) & ~hit
            left, at = left[on], (at[on] + 1) & (len(self.low) - 1)
        return found


def _cut(text: str, special: list[str]) -> tuple[list[str], int]:
    """The text around special strings, and how many of them there are (leftmost, longest first)."""
    parts, found = [text], 0
    for token in sorted(special, key=len, reverse=True):
        if token in text:
            cut = [p.split(token) for p in parts]
            found += sum(len(c) - 1 for c in cut)
            parts = [p for c in cut for p in c]
    return parts, found


def frequent_pretokens(df: DataFrame, text_col: str, special: list[str], table_entries: int, group_chars: int) -> DataFrame:
    """``low, high, n``: heavy pre-tokens of the corpus, at most ``table_entries`` rows.

    Each task counts all its pre-tokens and drops the rarest half whenever it
    holds more than 16 x ``table_entries``; it reports at most ``table_entries``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = 16 * table_entries
        keys = np.zeros(0, [("high", "<u8"), ("low", "<u8")])
        counts = np.zeros(0, np.int64)
        pending: list[np.ndarray] = []

        def merged(parts: list[np.ndarray], keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            new = np.concatenate(parts + [keys])
            weights = np.concatenate([np.ones(len(new) - len(keys), np.int64), counts])
            order = np.lexsort((new["low"], new["high"]))
            new, weights = new[order], weights[order]
            first = np.flatnonzero(np.concatenate([[True], new[1:] != new[:-1]]))
            keys, counts = new[first], np.add.reduceat(weights, first)
            if len(keys) > most:
                top = np.argpartition(counts, -most // 2)[-most // 2:]
                keys, counts = keys[top], counts[top]
            return keys, counts

        for batch in batches:
            texts = [p for t in batch.column(0).to_pylist() for p in _cut(t, special)[0]]
            for group in by_volume(texts, map(len, texts), group_chars):
                data, offsets, _ = pretokens.split(group)
                if len(offsets) > 1:
                    low, high, fits = keys_of(data, offsets)
                    part = np.zeros(int(fits.sum()), keys.dtype)
                    part["low"], part["high"] = low[fits], high[fits]
                    pending.append(part)
                if sum(map(len, pending)) > 1 << 20:
                    keys, counts = merged(pending, keys, counts)
                    pending = []
        if pending:
            keys, counts = merged(pending, keys, counts)
        if len(keys) > table_entries:
            top = np.argpartition(counts, -table_entries)[-table_entries:]
            keys, counts = keys[top], counts[top]
        yield pa.RecordBatch.from_arrays([pa.array(keys["low"].astype("<i8")), pa.array(keys["high"].astype("<i8")), pa.array(counts)],
                                         names=["low", "high", "n"])

    parts = map_arrow(df.select(as_text(text_col).alias("text")), run, "low long, high long, n long")
    return parts.groupBy("low", "high").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "low", "high").limit(table_entries)


def count_tokens(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024,
                 table_entries: int = 1 << 13, cache_entries: int = 400_000, group_chars: int = 1 << 20) -> DataFrame:
    """``<id_col>, n_bytes, n_tokens, over_limit, n_frequent``, one row for each input row.

    n_tokens is what the tokenizers library counts for the file ``tokenizer``
    without added special tokens; special strings inside a text count as one
    token each, as is its default.  n_frequent tells how many pre-tokens the
    broadcast table answered.  Only the two named columns are read.  A null text
    counts as empty; an empty text has 0 bytes and tokens; equal rows give equal
    rows; no rows give no rows.
    """
    merges, special = load(tokenizer)
    sc = df.sparkSession.sparkContext
    heavy = frequent_pretokens(df, text_col, special, table_entries, group_chars).toPandas()  # at most table_entries rows
    low, high = (heavy[c].to_numpy(np.int64).astype(np.uint64) for c in ("low", "high"))
    words = [int(a).to_bytes(8, "little") + int(b & (1 << 56) - 1).to_bytes(7, "little") for a, b in zip(low.tolist(), high.tolist())]
    words = [w[:h >> 56] for w, h in zip(words, high.tolist())]
    lengths = np.array([len(x) for x in merges.encode(words)], np.uint8)
    shared = sc.broadcast((merges, FrequentTable.of(low, high, lengths)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges, table = shared.value
        cache: dict[bytes, int] = {}
        for batch in batches:
            texts = batch.column(1).to_pylist()
            tokens, frequent = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
            parts, rows = [], []
            for i, text in enumerate(texts):
                pieces, found = _cut(text, special)
                tokens[i] = found
                parts += pieces
                rows += [i] * len(pieces)
            for group in by_volume(zip(parts, rows), map(len, parts), group_chars):
                data, offsets, firsts = pretokens.split([p for p, _ in group])
                if len(offsets) == 1:
                    continue
                low, high, fits = keys_of(data, offsets)
                counts = np.zeros(len(low), np.int64)
                counts[fits] = table.look_up(low[fits], high[fits])
                missed = np.flatnonzero(counts == 0)
                slices = [data[a:b] for a, b in zip(offsets[missed].tolist(), offsets[missed + 1].tolist())]
                if len(cache) > cache_entries:
                    cache.clear()
                new = list({s for s in slices if s not in cache})
                cache.update((w, len(x)) for w, x in zip(new, merges.encode(new)))
                frequent_here = (counts > 0).astype(np.int64)
                counts[missed] = list(map(cache.__getitem__, slices))
                row = np.array([r for _, r in group])
                sums = np.concatenate([[0], np.cumsum(counts)])[firsts]
                hits = np.concatenate([[0], np.cumsum(frequent_here)])[firsts]
                np.add.at(tokens, row, np.diff(sums))
                np.add.at(frequent, row, np.diff(hits))
            n_bytes = pc.binary_length(batch.column(1)).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), n_bytes, pa.array(tokens), pa.array(tokens > limit), pa.array(frequent)],
                                             names=["id", "n_bytes", "n_tokens", "over_limit", "n_frequent"])

    rows = df.select(df[id_col].alias("id"), as_text(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = map_arrow(rows, run, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean, n_frequent long")
    return out.withColumnRenamed("id", id_col)
