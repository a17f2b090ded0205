"""Exact removal of repeated byte strings across a corpus, by prefix-free parsing.

A rolling hash picks triggers: of the 32-byte windows in a string of ``length``
bytes the one with the smallest hash, the leftmost of equals.  Equal strings so
have their trigger at the same place, and neighbouring strings mostly share
theirs.  All strings around one trigger make a phrase; the phrases overlap, and
as triggers cut them, no phrase depends on what lies outside.  The corpus is the
sequence of its phrases (the parse) over the distinct phrases (the dictionary).

Every string lies in the phrase of its trigger, so two equal strings lie in
phrases with the same trigger bytes.  A phrase that stands earlier in the corpus
is a repeat whole.  What is left is the first occurrence of each dictionary
entry: where a trigger has several entries, these are cut into slices of
neighbouring strings, equal slices are folded, and only the strings of slices
that agree in their common bytes but not in all are compared one by one.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import as_text, by_rows, by_volume, map_arrow, materialise, mix64

TRIGGER = 32
#: no text of Spark is longer
PLACE_BITS = 31
#: strings of a slice
SLICE = 8
LAST = (1 << 63) - 1
_BASE = 0x9E3779B97F4A7C15
_BYTES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


class _Powers:
    """Powers of the rolling hash's base and of its inverse, modulo 2**64."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 1 << 16)
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(cls, name, np.cumprod(steps, dtype=np.uint64))
        return cls.up, cls.down


def prefix_sums(data: np.ndarray) -> np.ndarray:
    up, _ = _Powers.of(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * up[:len(data)], out=out[1:])
    return out


def hashes(sums: np.ndarray, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
    """Rolling hashes of the strings at ``start``, scrambled together with their lengths."""
    _, down = _Powers.of(len(sums))
    plain = (sums[start + length] - sums[start]) * down[start]
    return mix64(plain + np.atleast_1d(length).astype(np.uint64) * np.uint64(0x632BE59BD9B4E019)).view(np.int64)


@dataclass
class Phrases:
    """Phrases of some texts: whose, the first and last string's start and the trigger's start in
    the text, the hashes of the trigger and of the phrase."""

    owner: np.ndarray
    first: np.ndarray
    last: np.ndarray
    place: np.ndarray
    trigger: np.ndarray
    phrase: np.ndarray

    def again(self) -> np.ndarray:
        """Which phrases stand earlier in the same text."""
        order = np.lexsort((self.first, self.phrase, self.trigger, self.owner))
        same = np.zeros(len(order), bool)
        if len(order):
            o, t, p = self.owner[order], self.trigger[order], self.phrase[order]
            same[order[1:]] = (o[1:] == o[:-1]) & (t[1:] == t[:-1]) & (p[1:] == p[:-1])
        return same


def parse(texts: list[bytes], length: int) -> Phrases:
    """Cut texts (each of ``length`` bytes or more) into phrases."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    sums = prefix_sums(data)
    _, down = _Powers.of(len(sums))
    n = len(data) - TRIGGER + 1
    rank = (sums[TRIGGER:] - sums[:-TRIGGER]) * down[:n]
    rank ^= rank >> np.uint64(32)
    rank *= np.uint64(0xD6E8FEB86659FD93)
    least = (rank >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | np.arange(n, dtype=np.uint64)
    span, width = length - TRIGGER + 1, 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[:len(least) - (span - width)], least[span - width:])
    inside = np.ones(len(least), bool)  # strings that don't cross a text's end
    for end in ends[:-1]:
        inside[max(0, end - length + 1):end] = False
    start = np.flatnonzero(inside)
    place = (least[start] & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    cut = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    first, last, place = start[cut], start[np.append(cut[1:], len(start)) - 1], place[cut]
    owner = np.searchsorted(ends, first, side="right")
    begin = (ends - sizes)[owner]
    return Phrases(owner, first - begin, last - begin, place - begin, hashes(sums, place, TRIGGER), hashes(sums, first, last - first + length))


def _rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc, mark, text``: the id (null counts as the last), a hash that tells texts of one id
    apart (0 where every id has one row), the text."""
    text = as_text(text_col)
    rows = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("doc"), text.alias("text"))
    unique = rows.groupBy("doc").count().where("count > 1").isEmpty()
    return rows.select("doc", (F.lit(0).cast("long") if unique else F.xxhash64("text")).alias("mark"), "text")


def _parsed(batches: Iterator[pa.RecordBatch], length: int, group_bytes: int) -> Iterator[tuple[np.ndarray, np.ndarray, Phrases]]:
    """Ids, marks and phrases of the texts, group by group."""
    for batch in by_rows(batches, 1024):
        texts = batch.column(2).cast(pa.binary()).to_pylist()
        doc, mark = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        long_enough = [i for i, t in enumerate(texts) if len(t) >= length]
        for group in by_volume(long_enough, (len(texts[i]) for i in long_enough), group_bytes):
            yield doc[group], mark[group], parse([texts[i] for i in group], length)


def dictionary(rows: DataFrame, length: int, group_bytes: int) -> DataFrame:
    """``trigger, first_doc, several``: the triggers in more than one document, or with more than
    one phrase, and the smallest document of each.  Tasks fold their triggers before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def folded() -> pa.RecordBatch:
            trigger, low, high, least, most = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(trigger, kind="stable")
            trigger = trigger[order]
            cut = np.flatnonzero(np.concatenate([[True], trigger[1:] != trigger[:-1]]))
            columns = [trigger[cut], np.minimum.reduceat(low[order], cut), np.maximum.reduceat(high[order], cut),
                       np.minimum.reduceat(least[order], cut), np.maximum.reduceat(most[order], cut)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["trigger", "low", "high", "least", "most"])

        for doc, _, phrases in _parsed(batches, length, group_bytes):
            ids = doc[phrases.owner]
            held.append((phrases.trigger, ids, ids, phrases.phrase, phrases.phrase))
            if sum(len(x[0]) for x in held) > 100_000:
                yield folded()
                held.clear()
        if held:
            yield folded()

    parts = map_arrow(rows, run, "trigger long, low long, high long, least long, most long")
    whole = parts.groupBy("trigger").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.min("least").alias("least"), F.max("most").alias("most"))
    several = F.col("least") != F.col("most")
    return whole.where((F.col("low") < F.col("high")) | several).select("trigger", F.col("low").alias("first_doc"), several.alias("several"))


def key_filter(keys: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of 2**bits bits over the highest bits of well-mixed 64-bit ``keys``: those that may occur.

    Its size is fixed; when it fills up, it spares less work, nothing else."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            slot = batch.column(0).to_numpy()
            for page in np.unique(slot >> 16).tolist():
                bitmap = found.setdefault(page, np.zeros(1 << 16, bool))
                bitmap[slot[slot >> 16 == page] & 0xFFFF] = True
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array([np.packbits(b).tobytes() for b in found.values()], pa.binary())], names=["page", "bitmap"])

    slots = keys.select(F.shiftrightunsigned(F.col(keys.columns[0]), 64 - bits).alias("slot"))
    out = np.zeros(1 << (bits - 3), np.uint8)
    for row in map_arrow(slots.repartition(F.shiftright("slot", 16)), run, "page long, bitmap binary").collect():  # 2**(bits - 16) rows of 8 kB at most
        out[row.page << 13:(row.page + 1) << 13] = np.frombuffer(row.bitmap, np.uint8)
    return out


def may_hold(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which 64-bit keys may be in a ``key_filter``."""
    slot = (keys.view(np.uint64) >> np.uint64(64 - (len(bitmap).bit_length() + 2))).astype(np.int64)
    return (bitmap[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8) & 1).astype(bool)


def merged(first: np.ndarray, last: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Join ranges that follow one another without a break: positions of the first of each, first, last."""
    cut = np.flatnonzero(breaks | np.concatenate([[True], first[1:] != last[:-1] + 1])[:len(first)])
    return cut, first[cut], last[np.append(cut[1:], len(first)) - 1] if len(cut) else last[:0]


def occurrences(rows: DataFrame, triggers: DataFrame, length: int, group_bytes: int, filter_bits: int) -> DataFrame:
    """``doc, mark, first, last, place, trigger, phrase``: phrases that repeat (trigger null), and
    phrases whose trigger has several (place, trigger and phrase given)."""
    shared = rows.sparkSession.sparkContext.broadcast((key_filter(triggers.select("trigger"), filter_bits), key_filter(triggers.where("several").select("trigger"), filter_bits)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, mixed = shared.value
        for doc, mark, p in _parsed(batches, length, group_bytes):
            again = p.again()
            at = np.flatnonzero(again)
            owner = p.owner[at]
            cut, first, last = merged(p.first[at], p.last[at], np.concatenate([[True], owner[1:] != owner[:-1]])[:len(at)])
            ask = np.flatnonzero(~again & may_hold(known, p.trigger))
            who = np.concatenate([owner[cut], p.owner[ask]])
            nulls = np.concatenate([np.ones(len(cut), bool), np.zeros(len(ask), bool)])
            trigger = pa.array(np.concatenate([np.zeros(len(cut), np.int64), p.trigger[ask]]), mask=nulls)
            phrase = pa.array(np.concatenate([np.zeros(len(cut), np.int64), p.phrase[ask]]), mask=np.concatenate([np.ones(len(cut), bool), ~may_hold(mixed, p.trigger[ask])]))
            ranges = [np.concatenate(x).astype(np.int32) for x in ((first, p.first[ask]), (last, p.last[ask]), (first, p.place[ask]))]
            yield pa.RecordBatch.from_arrays([pa.array(doc[who]), pa.array(mark[who]), *map(pa.array, ranges), trigger, phrase], names=["doc", "mark", "first", "last", "place", "trigger", "phrase"])

    found = map_arrow(rows, run, "doc long, mark long, first int, last int, place int, trigger long, phrase long")
    joined = found.join(triggers, "trigger", "left").where("trigger is null or several or doc > first_doc")
    return joined.select("doc", "mark", "first", "last", "place", F.when(F.col("several"), F.col("trigger")).alias("trigger"), F.when(F.col("several"), F.col("phrase")).alias("phrase"))


def by_presence(rows: DataFrame, keys: DataFrame, filter_bits: int, held: bool) -> DataFrame:
    """``doc, mark, packed``: of the rows that ``keys`` (``doc, mark``) may name, the text compressed
    for a shuffle; or, with ``held`` false, ``doc, mark, text`` of the rows that it doesn't name.

    By a bitmap of fixed size, so that the unnamed rows need no shuffle."""
    bits, key = min(filter_bits, 24), F.xxhash64("doc", "mark")
    bitmap = rows.sparkSession.sparkContext.broadcast(key_filter(keys.select(key.alias("key")), bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_rows(batches):
            mine = pa.array(may_hold(bitmap.value, batch.column(3).to_numpy()) == held)
            doc, mark, text = (c.filter(mine) for c in batch.columns[:3])
            if held:
                text = pa.array([zlib.compress(t, 1) for t in text.cast(pa.binary()).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([doc, mark, text], names=["doc", "mark", "packed" if held else "text"])

    return map_arrow(rows.select("doc", "mark", "text", key.alias("key")), run, f"doc long, mark long, {'packed binary' if held else 'text string'}")


def entry_bytes(rows: DataFrame, entries: DataFrame, length: int, filter_bits: int) -> DataFrame:
    """``doc, mark, first, last, offset, bytes``: the entries with their phrases' bytes and the
    trigger's place in them; and, without bytes, the strings of entries that start earlier in the same text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_rows(batches):
            out = []
            for doc, mark, text, spans in zip(*(c.to_pylist() for c in batch.columns)):
                data = zlib.decompress(text)
                out += [(doc, mark, s["first"], s["last"], s["place"] - s["first"], data[s["first"]:s["last"] + length]) for s in spans]
                if len(spans) > 1:
                    start = np.concatenate([np.arange(s["first"], s["last"] + 1) for s in spans])
                    string = hashes(prefix_sums(np.frombuffer(data, np.uint8)), start, length)
                    order = np.lexsort((start, string))
                    again = np.sort(start[order[1:]][string[order[1:]] == string[order[:-1]]])
                    _, first, last = merged(again, again, np.zeros(len(again), bool))
                    out += [(doc, mark, a, b, None, None) for a, b in zip(first.tolist(), last.tolist())]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["doc", "mark", "first", "last", "offset", "bytes"])

    spans = materialise(entries.groupBy("doc", "mark").agg(F.collect_list(F.struct("first", "last", "place")).alias("spans")), "entries-by-doc")
    texts = by_presence(rows, spans, filter_bits, True).join(spans, ["doc", "mark"])
    return map_arrow(texts.select("doc", "mark", "packed", "spans"), run, "doc long, mark long, first int, last int, offset int, bytes binary")


def _ranges(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of some ranges laid end to end: whose, the place in it."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)


def _slices(batch: pa.RecordBatch, length: int) -> tuple[np.ndarray, ...]:
    """Cut entries into slices of SLICE strings by their distance to the trigger.

    All strings of a slice hold its core, the bytes that they have in common, so
    entries that share a string of a slice share its core.  Returns sums of the
    rolling hash, and of each slice: the entry, the first string (in the sums'
    bytes), the number of strings, the hashes of the core and of all its bytes."""
    offset, pieces = batch.column(3).to_numpy().astype(np.int64), batch.column(4).to_pylist()
    sizes = np.array([len(p) for p in pieces], np.int64)
    begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    sums = prefix_sums(np.frombuffer(b"".join(pieces), np.uint8))
    strings = sizes - length + 1
    near, far = (offset - strings + 1) // SLICE, offset // SLICE  # distances of the last and the first string
    owner, step = _ranges(far - near + 1)
    distance = (near[owner] + step) * SLICE  # the smallest of the slice
    high = np.minimum(distance + SLICE - 1, offset[owner])
    low = np.maximum(distance, offset[owner] - strings[owner] + 1)
    place = begin[owner] + offset[owner]
    core = hashes(sums, place - distance, length - SLICE + 1) ^ mix64(distance.astype(np.uint64)).view(np.int64)
    return sums, owner, place - high, high - low + 1, core, hashes(sums, place - high, length + high - low)


def compared(entries: DataFrame, length: int, filter_bits: int) -> DataFrame:
    """``doc, mark, first, last``: strings of entries (``doc, mark, first, offset, bytes``) that a smaller document has.

    Slices with equal bytes are repeats of the first; where a core has several
    contents, the strings of each content's first slice are compared.  All of it
    is grouping by hash, so no group of entries meets in one task."""
    def sliced(batch: pa.RecordBatch) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        sums, owner, first, n, core, content = _slices(batch, length)
        sizes = np.array([len(p) for p in batch.column(4).to_pylist()], np.int64)
        shift = (batch.column(2).to_numpy() - np.concatenate([[0], np.cumsum(sizes)[:-1]]))[owner]  # to places in the text
        doc, mark = (batch.column(i).to_numpy()[owner] for i in (0, 1))
        return sums, {"core": core, "content": content, "doc": doc, "mark": mark, "first": first, "n": n, "shift": shift}

    def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_rows(batches, 4096):
            _, x = sliced(batch)
            yield pa.RecordBatch.from_arrays([pa.array(x[c]) for c in ("core", "content", "doc")], names=["core", "content", "doc"])

    counted = map_arrow(entries, contents, "core long, content long, doc long").groupBy("core", "content").agg(F.min("doc").alias("first_doc"), F.count("*").alias("n"))
    counted = materialise(counted, "slice-contents")
    several = materialise(counted.groupBy("core").agg(F.count("*").alias("contents")).where("contents > 1").select("core"), "slice-cores")
    both = F.col("core").bitwiseXOR(F.col("content"))
    repeated = counted.where("n > 1")
    asked = counted.join(several, "core").select(both.bitwiseXOR(F.shiftleft("first_doc", 64 - filter_bits)).alias("key"))
    shared = entries.sparkSession.sparkContext.broadcast((key_filter(repeated.select(both.alias("key")), filter_bits), key_filter(asked, filter_bits)))

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Slices that may repeat (with their content), and the strings of slices that are asked for."""
        repeats, asks = shared.value
        for batch in by_rows(batches, 4096):
            sums, x = sliced(batch)
            key = x["core"] ^ x["content"]
            whole = np.flatnonzero(may_hold(repeats, key))
            split = np.flatnonzero(may_hold(asks, key ^ (x["doc"] << (64 - filter_bits))))
            of, step = _ranges(x["n"][split])
            at = split[of]
            start = x["first"][at] + step
            rows = np.concatenate([whole, at])
            first = np.concatenate([x["first"][whole], start]) + x["shift"][rows]
            last = np.concatenate([first[:len(whole)] + x["n"][whole] - 1, first[len(whole):]])
            value = np.concatenate([x["content"][whole], hashes(sums, start, length)])
            kind = np.concatenate([np.ones(len(whole), bool), np.zeros(len(at), bool)])
            columns = [x["core"][rows], value, x["doc"][rows], x["mark"][rows], first.astype(np.int32), last.astype(np.int32), kind]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["core", "value", "doc", "mark", "first", "last", "whole"])

    found = materialise(map_arrow(entries, parts, "core long, value long, doc long, mark long, first int, last int, whole boolean"), "slice-parts")
    columns = ["doc", "mark", "first", "last"]
    slices = found.where("whole").join(repeated.select("core", F.col("content").alias("value"), "first_doc"), ["core", "value"]).where("doc > first_doc")
    strings = found.where("not whole")
    seen = strings.groupBy("core", "value").agg(F.min("doc").alias("first_doc"), F.max("doc").alias("last_doc")).where("first_doc < last_doc")
    later = strings.join(materialise(seen.drop("last_doc"), "strings-seen"), ["core", "value"]).where("doc > first_doc")
    return slices.select(columns).unionByName(later.select(columns))


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100, group_bytes: int = 1 << 18, filter_bits: int = 26) -> DataFrame:
    """``<id_col>, n_bytes, n_removed, n_spans, kept``, one row for each input row.

    Removes from each text's UTF-8 bytes every byte covered by a string of
    ``length`` bytes (at least 33) that also starts earlier: in a row of a
    smaller id, or earlier in the same text.  Strings are judged on the input and
    never cross texts.  ``kept`` is the remaining bytes, ``n_spans`` the number of
    removed runs.  A null text counts as empty; texts below ``length`` bytes stay
    whole.  A null id comes after every other.  Rows of one id are not earlier
    than each other, so repeated rows give equal rows.  No rows give no rows.
    Only the two named columns are read; ids must be whole numbers.  A text is
    handled in one piece, whatever its length.
    """
    rows = _rows(df, id_col, text_col)
    triggers = materialise(dictionary(rows, length, group_bytes), "triggers")
    phrases = materialise(occurrences(rows, triggers, length, group_bytes, filter_bits), "occurrences")
    mixed = phrases.where("trigger is not null")
    firsts = materialise(mixed.groupBy("trigger", "phrase").agg(F.min("doc").alias("first_doc")), "entries")
    ordered = mixed.join(firsts, ["trigger", "phrase"])
    entries = materialise(entry_bytes(rows, ordered.where("doc = first_doc"), length, filter_bits), "entry-bytes")
    columns = ["doc", "mark", "first", "last"]
    strings = compared(entries.where("bytes is not null").select("doc", "mark", "first", "offset", "bytes"), length, filter_bits)
    spans = (phrases.where("trigger is null").select(columns).unionByName(ordered.where("doc > first_doc").select(columns))
             .unionByName(entries.where("bytes is null").select(columns)).unionByName(strings))
    spans = materialise(spans.groupBy("doc", "mark").agg(F.collect_list(F.struct("first", "last")).alias("spans")), "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_rows(batches):
            out = []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data = np.frombuffer(zlib.decompress(text), np.uint8)
                change = np.zeros(len(data) + 1, np.int64)
                for s in found or ():
                    change[s["first"]] += 1
                    change[s["last"] + length] -= 1
                gone = np.cumsum(change)[:-1] > 0
                runs = int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
                out.append((len(data), int(gone.sum()), runs, data[~gone].tobytes()))
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, [pa.int64()] * 3 + [pa.binary()]))],
                                             names=["doc", "n_bytes", "n_removed", "n_spans", "kept"])

    joined = by_presence(rows, spans, filter_bits, True).join(spans, ["doc", "mark"], "left").select("doc", "packed", "spans")
    out = map_arrow(joined, run, "doc long, n_bytes long, n_removed long, n_spans long, kept binary")
    whole = by_presence(rows, spans, filter_bits, False).select("doc", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
                                                          F.lit(0).cast("long").alias("n_spans"), F.col("text").cast("binary").alias("kept"))
    return out.unionByName(whole).select(F.when(F.col("doc") != LAST, F.col("doc")).alias(id_col), "n_bytes", "n_removed", "n_spans", "kept")
