"""Near duplicates by BagMinHash signatures, banding and verified multiset overlap.

A document is the multiset of its five-word shingles.  For each shingle Poisson
processes run over time and weight: the unit cells of weight up to the
shingle's count each emit points at rate 1 for each of the signature's
positions, and a position keeps the earliest point.  Equal positions of two
signatures have the probability of the weighted Jaccard similarity.  Weights
above 1 come in dyadic intervals whose process is split, level by level, only
after a point came early enough to matter, and no process runs on beyond the
latest position of its document.

Exact copies (equal word sequences) are folded into one node first.  Nodes that
share a band are compared with the bucket's hub, the member with most bucket
mates, by the overlap of their shingle multisets; further rounds compare the
other classes of a bucket with new hubs, each at the cost of the bucket's size.
What is still of several classes then is compared by an exact prefix filter:
texts over the bound share one of their rarest shingles.
"""

from __future__ import annotations

import math
import zlib
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import as_text, by_rows, by_volume, hash64, map_arrow, materialise, mix64, row_mark

SHINGLE = 5
POSITIONS, ROWS = 96, 4
BANDS = POSITIONS // ROWS
#: counters that put shingles in order of frequency (any order gives the same pairs)
COUNTERS = 1 << 20
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    """Hashes of words, kept between texts."""

    def __missing__(self, word: str) -> int:
        if len(self) > 250_000:
            self.clear()
        self[word] = h = hash64(word.encode("utf-8", "replace"))
        return h


def word_hashes(text: str, words: _Words) -> np.ndarray:
    """A hash for each white-space separated word, in lower case."""
    parts = text.lower().split()
    return np.fromiter(map(words.__getitem__, parts), np.uint64, len(parts))


def shingles(hashes: np.ndarray) -> np.ndarray:
    """Hashes of all runs of SHINGLE words (of all words, if fewer)."""
    n = max(len(hashes) - SHINGLE + 1, 1)
    out = np.zeros(n if len(hashes) else 0, np.uint64)
    for i in range(min(SHINGLE, len(hashes))):
        out = mix64(out + GOLDEN) ^ hashes[i:i + n]
    return mix64(out)


def _draw(seeds: np.ndarray, what: np.ndarray | int) -> np.ndarray:
    return mix64(seeds + GOLDEN * (np.atleast_1d(what).astype(np.uint64) + np.uint64(1)))


def _uniform(x: np.ndarray) -> np.ndarray:
    """In (0, 1]."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1) * 2.0 ** -53


def bag_minhash(elements: np.ndarray, weights: np.ndarray, owners: np.ndarray, n: int, positions: int = POSITIONS) -> np.ndarray:
    """Signatures of ``n`` bags: the earliest time at each position, inf where a bag is empty.

    ``elements`` are 64-bit hashes, distinct within a bag; ``weights`` whole
    numbers from 1; ``owners`` says whose they are.
    """
    totals = np.bincount(owners, weights, n)
    horizon = np.where(totals > 0, (math.log(positions) + 12) / np.maximum(totals, 1), 0)
    out = np.full((n, positions), np.inf)
    todo = np.flatnonzero(totals > 0)
    while len(todo):
        mine = np.isin(owners, todo) if len(todo) < n else np.ones(len(owners), bool)
        _run(elements[mine], weights[mine], owners[mine], out, horizon, positions)
        todo = todo[np.isinf(out[todo]).any(axis=1)]  # about one in 160,000: a position had no point in time
        out[todo] = np.inf
        horizon[todo] *= 2
    return out


def _run(elements: np.ndarray, weights: np.ndarray, owners: np.ndarray, out: np.ndarray, horizon: np.ndarray, positions: int) -> None:
    """Run the processes of all bags up to their horizons."""
    seed, owner, weight, low, high = [elements], [owners], [weights], [np.zeros(len(elements), np.int64)], [np.ones(len(elements), np.int64)]
    top = int(weights.max(initial=1))
    edge = 1
    while edge < top:  # the dyadic intervals above the first cell
        some = np.flatnonzero(weights > edge)
        seed.append(_draw(elements[some], edge))
        owner.append(owners[some])
        weight.append(weights[some])
        low.append(np.full(len(some), edge, np.int64))
        high.append(np.full(len(some), 2 * edge, np.int64))
        edge *= 2
    seed, owner, weight, low, high = (np.concatenate(x) for x in (seed, owner, weight, low, high))
    time, step, pending = np.zeros(len(seed)), np.zeros(len(seed), np.uint64), np.zeros(len(seed), bool)
    flat = out.reshape(-1)
    while len(seed):
        wait = -np.log(_uniform(_draw(seed, 2 * step))) / (positions * (high - low))
        time = np.where(pending, time, time + wait)
        latest = np.minimum(horizon, out.max(axis=1))
        live = np.flatnonzero((time <= latest[owner]) & (low < weight))
        seed, owner, weight, low, high, time, step = (x[live] for x in (seed, owner, weight, low, high, time, step))
        cell = high - low == 1
        place = _draw(seed[cell], 2 * step[cell] + np.uint64(1)) % np.uint64(positions)
        np.minimum.at(flat, owner[cell] * positions + place.astype(np.int64), time[cell])
        step[cell] += np.uint64(1)
        pending = np.zeros(len(seed), bool)
        if cell.all():
            continue
        wide = ~cell  # the point falls in one half; both halves go on from its time
        middle = (low[wide] + high[wide]) // 2
        upper = (_draw(seed[wide], 1 << 32) & np.uint64(1)).astype(bool)
        parts = [[x[cell] for x in (seed, owner, weight, low, high, time, step, pending)]]
        for half in (False, True):
            parts.append([_draw(seed[wide], (1 << 33) + half), owner[wide], weight[wide], middle if half else low[wide], high[wide] if half else middle,
                          time[wide], np.zeros(int(wide.sum()), np.uint64), upper == half])
        seed, owner, weight, low, high, time, step, pending = (np.concatenate(x) for x in zip(*parts))


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """For each signature a key for each band, and one for each pair of neighbouring bands."""
    bits = np.ascontiguousarray(signatures).view(np.uint64).reshape(len(signatures), BANDS, ROWS)
    keys = np.zeros((len(signatures), BANDS), np.uint64)
    for i in range(ROWS):
        keys = mix64(keys + GOLDEN) ^ bits[:, :, i]
    keys = mix64(keys + np.arange(1, BANDS + 1, dtype=np.uint64) * GOLDEN)
    pairs = mix64(keys + GOLDEN) ^ np.roll(keys, -1, axis=1)
    return np.concatenate([keys, mix64(pairs)], axis=1).view(np.int64)


def signature_rows(df: DataFrame, id_col: str, text_col: str, group_words: int = 1 << 18) -> DataFrame:
    """``id, mark, print, keys`` of every row: a hash of the text, the 128-bit print of the word
    sequence and the band keys, these two null for texts without words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in by_rows(batches, 1024):
            hashed = [word_hashes(t, words) for t in batch.column(1).to_pylist()]
            prints = [hash64(h.tobytes()).to_bytes(8, "little") + hash64(b"2" + h.tobytes()).to_bytes(8, "little") if len(h) else None for h in hashed]
            once = list({p: i for i, p in enumerate(prints) if p}.values())
            keys: dict[bytes, np.ndarray] = {}
            for group in by_volume(once, (len(hashed[i]) for i in once), group_words):
                bags = [np.unique(shingles(hashed[i]), return_counts=True) for i in group]
                signatures = bag_minhash(np.concatenate([b[0] for b in bags]), np.concatenate([b[1] for b in bags]),
                                         np.repeat(np.arange(len(group)), [len(b[0]) for b in bags]), len(group))
                keys.update(zip((prints[i] for i in group), band_keys(signatures)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(prints, pa.binary()), pa.array([keys.get(p) for p in prints], pa.list_(pa.int64()))],
                                             names=["id", "mark", "print", "keys"])

    rows = df.select(df[id_col].cast("long").alias("id"), as_text(text_col).alias("text"), row_mark(text_col).alias("mark"))
    return map_arrow(rows, run, "id long, mark long, print binary, keys array<long>")


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two bags, each (sorted distinct elements, counts)."""
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    both = b[0][at] == a[0]
    common = int(np.minimum(a[1][both], b[1][at[both]]).sum())
    return common / (int(a[1].sum()) + int(b[1].sum()) - common)


def verify(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``a, b`` whose texts overlap by ``similarity`` or more; ``texts`` has ``node, packed``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, bags = _Words(), {}

        def bag(node: int, packed: bytes) -> tuple[np.ndarray, np.ndarray]:
            if node not in bags:
                if len(bags) >= 64:
                    bags.pop(next(iter(bags)))
                bags[node] = np.unique(shingles(word_hashes(zlib.decompress(packed).decode("utf-8"), words)), return_counts=True)
            return bags[node]

        for batch in by_rows(batches, 1024):
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            same = [overlap(bag(x, p), bag(y, q)) >= similarity for x, y, p, q in zip(a, b, batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([x.filter(pa.array(same, pa.bool_())) for x in batch.columns[:2]], names=["a", "b"])

    joined = (pairs.join(texts.select(F.col("node").alias("a"), F.col("packed").alias("text_a")), "a")
              .join(texts.select(F.col("node").alias("b"), F.col("packed").alias("text_b")), "b").select("a", "b", "text_a", "text_b"))
    return map_arrow(joined, run, "a long, b long")


def pack_texts(df: DataFrame, nodes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``node, packed``: the compressed texts of the documents in ``nodes`` (``node``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_rows(batches, 1024):
            packed = [zlib.compress(t, 1) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["node", "packed"])

    rows = df.select(df[id_col].cast("long").alias("id"), as_text(text_col).alias("text")).where("id is not null")
    packed = map_arrow(rows, run, "node long, packed binary")
    return packed.join(nodes, "node", "left_semi")


def components(edges: DataFrame) -> DataFrame:
    """``node, label``: the smallest node of each node's component, for the nodes of ``edges`` (``a, b``).

    Alternates large-star and small-star steps until every component is a star
    around its smallest node; each round is written, so a lost executor costs a
    round at most.
    """
    def star(links: DataFrame, large: bool) -> DataFrame:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        if not large:
            both = both.where("b < a")
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        out = both.join(materialise(least, "stars"), "a")
        if large:
            return out.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        return out.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(least.select("a", F.col("m").alias("b"))).distinct()

    def all_stars(links: DataFrame) -> bool:
        """With a > b in each link: no node has two smaller ones, or a smaller and a larger one."""
        ends = links.select(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(
            links.select(F.col("b").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up")))
        return ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up")).where("down > 1 or down > 0 and up > 0").isEmpty()

    edges = materialise(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    while not all_stars(edges):
        edges = materialise(star(materialise(star(edges, True), "edges"), False), "edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))


def merge_links(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """``labels`` (of ``components``) after further links ``a, b``: only the classes that these join are worked on."""
    if labels is None:
        return components(links)
    ends = links
    for end in ("a", "b"):
        known = labels.select(F.col("node").alias(end), F.col("label").alias(f"{end}_label"))
        ends = ends.join(known, end, "left").withColumn(end, F.coalesce(f"{end}_label", end))
    joined = materialise(ends.where("a <> b").select("a", "b").distinct(), "joined")
    if joined.isEmpty():
        return labels
    moved = components(joined)
    to = moved.select(F.col("node").alias("label"), F.col("label").alias("to"))
    # a class's smallest node has no label of its own yet, so no node comes twice
    kept = labels.join(to, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
    return materialise(kept.unionByName(moved), "labels")


def choose_hubs(buckets: DataFrame, labels: DataFrame | None, past: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """The buckets' rows with their class, and ``key, hub, hub_label``: each bucket's next hub.

    The hub is the member of highest degree outside the classes of the bucket's
    ``past`` hubs.  Buckets of one class need no more hubs.
    """
    best = F.max(F.struct("degree", (-F.col("node")).alias("order"), "node", "label")).alias("hub")
    rows = buckets.withColumn("label", F.col("node"))
    if labels is not None:
        rows = buckets.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        mixed = rows.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("key")
        rows = materialise(rows.join(materialise(mixed, "mixed"), "key"), "mixed-rows")
    left = rows
    if past is not None:
        done = past.join(labels, past["hub"] == labels["node"], "left").select("key", F.coalesce("label", "hub").alias("label")).distinct()
        left = rows.join(materialise(done, "hubs-done"), ["key", "label"], "left_anti")
    hubs = left.groupBy("key").agg(best).select("key", F.col("hub.node").alias("hub"), F.col("hub.label").alias("hub_label"))
    return rows, materialise(hubs, "hubs")


def hub_pairs(rows: DataFrame, hubs: DataFrame) -> DataFrame:
    """``a, b``: the members of each bucket that aren't in its hub's class, with the hub."""
    return rows.join(hubs, "key").where("label <> hub_label").select(F.greatest("node", "hub").alias("a"), F.least("node", "hub").alias("b")).distinct()


def left_over(buckets: DataFrame, labels: DataFrame, past: DataFrame) -> DataFrame:
    """``node, label`` of the members, not hubs, of buckets where such members are of several classes."""
    rows = buckets.select("key", "node").join(past.select("key", F.col("hub").alias("node")), ["key", "node"], "left_anti")
    rows = materialise(rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "left-rows")
    mixed = rows.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("key")
    return rows.join(mixed, "key", "left_semi").select("node", "label").distinct()


def prefixes(texts: DataFrame, similarity: float) -> DataFrame:
    """``node, token, size, place``: of each text's shingles, equal ones numbered, the rarest that any
    other text of the given similarity must share one of.  ``texts`` has ``node, packed``."""
    def bag(packed: bytes, words: _Words) -> np.ndarray:
        return np.sort(shingles(word_hashes(zlib.decompress(packed).decode("utf-8"), words)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts = _Words(), np.zeros(COUNTERS, np.int64)
        for batch in by_rows(batches, 1024):
            for packed in batch.column(1).to_pylist():
                np.add.at(counts, (bag(packed, words) % np.uint64(COUNTERS)).astype(np.int64), 1)
        slots = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(counts[slots])], names=["slot", "n"])

    found = map_arrow(texts, count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()  # COUNTERS rows at most
    frequency = np.zeros(COUNTERS, np.int64)
    frequency[found["slot"].to_numpy()] = found["n"].to_numpy()
    shared = texts.sparkSession.sparkContext.broadcast(frequency)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts = _Words(), shared.value
        for batch in by_rows(batches, 64):
            out = []
            for node, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                elements = bag(packed, words)
                n = len(elements)
                nth = np.arange(n) - np.searchsorted(elements, elements)
                tokens = mix64(elements + GOLDEN * nth.astype(np.uint64))
                order = np.lexsort((tokens, counts[(elements % np.uint64(COUNTERS)).astype(np.int64)]))
                first = tokens[order[:n - math.ceil(similarity * n - 1e-6) + 1]].view(np.int64)
                out.append((np.full(len(first), node), first, np.full(len(first), n), np.arange(len(first))))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], names=["node", "token", "size", "place"])

    return map_arrow(texts, run, "node long, token long, size long, place long")


def prefix_pairs(tokens: DataFrame, similarity: float) -> DataFrame:
    """``a, b``: the texts of different classes that share a token and can reach the similarity, from
    ``node, token, size, place, label``.

    One side of a pair is outside the token's commonest class, so a class of near
    copies, however large, isn't compared with itself."""
    classes = tokens.groupBy("token", "label").agg(F.count("*").alias("n")).groupBy("token").agg(F.max(F.struct("n", "label")).alias("main"), F.count("*").alias("classes"))
    rows = materialise(tokens.join(classes.where("classes > 1").select("token", F.col("main.label").alias("main")), "token"), "tokens")
    x, y = rows.where("label <> main").alias("x"), rows.alias("y")
    rest = F.least(F.col("x.size") - F.col("x.place"), F.col("y.size") - F.col("y.place"))  # right at the first token that both have
    reach = rest >= similarity / (1 + similarity) * (F.col("x.size") + F.col("y.size")) - 1e-6
    pairs = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.label") != F.col("y.label")) & reach)
    return pairs.select(F.greatest("x.node", "y.node").alias("a"), F.least("x.node", "y.node").alias("b")).distinct()


def near_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8, rounds: int = 3) -> DataFrame:
    """``<id_col>, class_id, is_first, mark``, one row for each input row.

    class_id is the smallest id of the row's class: exact copies (equal words,
    white space and case aside) and all documents linked, directly or in turn,
    by a weighted Jaccard similarity of at least ``similarity`` of their
    multisets of five-word shingles.  Shorter texts have one shingle, all their
    words.  Texts without words (null, empty, blank) are classes of their own.
    Rows that repeat an id with other texts stand for one document when it is
    the smallest id of each.  A null id has a null class and takes no part.  No
    rows give no rows.  ``id_col`` must hold whole numbers.  ``mark``
    (``common.row_mark`` of the text) tells rows of one id apart.

    Every pair of different texts at 0.8 shares one of the 24 bands of 4 with a
    probability of 0.999997.  A bucket compares its members with hubs in
    ``rounds`` rounds; members that are still of several classes then are compared
    by ``prefix_pairs``, which loses no link.
    """
    rows = materialise(signature_rows(df, id_col, text_col), "signatures")
    worded = rows.where("print is not null and id is not null")
    nodes = materialise(worded.groupBy("print").agg(F.min("id").alias("node"), F.any_value("keys").alias("keys")), "nodes")
    members = nodes.select("node", F.explode("keys").alias("key")).distinct()
    shared = materialise(members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    buckets = materialise(members.join(shared, "key"), "members")
    degrees = materialise(buckets.groupBy("node").agg(F.sum("n").alias("degree")), "degrees")
    buckets = materialise(buckets.join(degrees, "node").select("key", "node", "degree"), "members")
    texts = materialise(pack_texts(df, degrees.select("node"), id_col, text_col), "texts")
    tried, past, labels = None, None, None
    add = lambda all_rows, new: new if all_rows is None else all_rows.unionByName(new)
    for _ in range(rounds):
        members, hubs = choose_hubs(buckets, labels, past)
        past = add(past, hubs.select("key", "hub"))
        pairs = hub_pairs(members, hubs)
        pairs = materialise(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        if pairs.isEmpty():
            break
        tried = add(tried, pairs)
        labels = merge_links(labels, materialise(verify(pairs, texts, similarity), "links"))
    if labels is not None:
        left = materialise(left_over(buckets, labels, past), "left")
        tokens = prefixes(texts.join(left, "node", "left_semi"), similarity).join(left, "node")
        pairs = materialise(prefix_pairs(tokens, similarity).join(tried, ["a", "b"], "left_anti"), "pairs")
        if not pairs.isEmpty():
            labels = merge_links(labels, materialise(verify(pairs, texts, similarity), "links"))
    classes = nodes.select("print", "node")
    if labels is not None:
        classes = classes.join(labels, "node", "left").select("print", F.coalesce("label", "node").alias("node"))
    classes = materialise(classes.withColumnRenamed("node", "class"), "classes")
    joined = rows.select("id", "mark", "print").join(classes, "print", "left")
    class_id = F.when(F.col("id").isNotNull(), F.coalesce("class", "id"))
    return joined.select(F.col("id").alias(id_col), class_id.alias("class_id"), (class_id == F.col("id")).alias("is_first"), "mark")
