"""Secret scans in whole texts, with DataFrame functions only.

Known kinds come from patterns.  Besides, candidate strings (long runs of the
characters of a class) are scanned with a sliding window: a fold over the
string keeps the count of every character in the window, adds the character
that enters, takes off the one that leaves, and updates the sum of c log2 c
from these two counts alone.  A candidate whose best window reaches the
entropy of its class is a secret unless the allow list knows it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import as_text, let

#: base kinds in the order that breaks ties of the start: pattern, and the check a match must pass
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
SPAN = "array<struct<start:int,kind_order:int,end:int,kind:string>>"
#: c log2 c is kept as an integer number of these parts of a bit, so that the running sum is exact
PARTS = 1 << 20


@dataclass(frozen=True)
class EntropyClass:
    """A class of candidate strings: its runs, alphabet, window, least entropy in bits, and
    what a string must hold to be scanned."""

    kind: str
    pattern: str
    alphabet: str
    window: int
    bits: float
    needs: tuple[str, ...]


_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
ENTROPY_CLASSES = (
    EntropyClass("entropy_hex", r"(?<![0-9A-Za-z])[0-9A-Fa-f]{20,}(?![0-9A-Za-z])", _DIGITS + "abcdef", 20, 3.0, ("[0-9]", "[A-Fa-f]")),
    EntropyClass("entropy_base64", r"[A-Za-z0-9+/_-]{24,}={0,2}", _DIGITS + _LOWER + _LOWER.upper() + "+/_-=", 24, 4.0, ("[0-9]", "[a-z]", "[A-Z]")),
)
#: candidates that are no secrets: UUIDs, placeholders, one character or a short unit repeated, counting runs, paths
ALLOW = (
    r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$",
    r"(?i)example|sample|dummy|placeholder|changeme|your[-_]|xxxx|0123456789|abcdefgh",
    r"^(.{1,4})\1{4,}.{0,3}$",
    r"^(sha(256|384|512)-)",
    r"^/?([A-Za-z0-9_-]{1,15}/){3,}",
)


def _running_sums(lengths: Column, block: int = 256) -> Column:
    """The sum of the array up to each element: within blocks first, then each block is moved by the total of those before.

    A fold that appends copies its array at each step, so none here gets longer
    than a block or than the number of blocks."""
    last = lambda a: F.coalesce(F.get(a, F.size(a) - 1), F.lit(0))
    upto = lambda a: F.aggregate(a, F.array().cast("array<int>"), lambda s, x: F.array_append(s, last(s) + x))

    def joined(blocks: Column) -> Column:
        return let(upto(F.transform(blocks, last)), lambda ends: F.flatten(F.transform(blocks, lambda b, i: F.transform(b, lambda x: x + F.coalesce(F.get(ends, i - 1), F.lit(0))))))

    def cut(steps: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / block).cast("int"))
        return let(F.transform(starts, lambda i: upto(F.slice(steps, i * block + 1, F.lit(block)))), joined)

    return let(lengths, cut)


def _spans(text: Column, hits: Column, pattern: str, kind: str, order: int) -> Column:
    """Place the matches: the pieces between them give the gaps, a running sum the positions."""
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits))
    ends = _running_sums(F.zip_with(gaps, hits, lambda gap, hit: F.length(gap) + F.length(hit)))

    def span(end: Column, hit: Column) -> Column:
        return F.struct((end - F.length(hit)).alias("start"), F.lit(order).alias("kind_order"), end.alias("end"), F.lit(kind).alias("kind"), hit.alias("hit"))

    return F.when(F.size(hits) > 0, F.zip_with(ends, hits, span))


def window_bits(candidate: Column, alphabet: str, window: int) -> Column:
    """The highest Shannon entropy, in bits, of any ``window`` characters of the candidate.

    Characters are told apart by their place in ``alphabet`` (all others count
    as one); a shorter candidate has one window, itself.
    """
    table = F.array(*(F.lit(round(PARTS * c * math.log2(c)) if c else 0).cast("long") for c in range(window + 2)))
    weight = lambda c: F.element_at(table, c + 1)
    none = F.lit(-1)

    def best(places: Column) -> Column:
        least_window = F.least(F.lit(window), F.size(places))
        leaving = F.slice(F.concat(F.array_repeat(none, window), places), F.lit(1), F.size(places))
        steps = F.zip_with(places, leaving, lambda enters, leaves: F.struct(enters.alias("enters"), leaves.alias("leaves")))
        zero = F.struct(F.array_repeat(F.lit(0), len(alphabet) + 1).alias("counts"), F.lit(0).cast("long").alias("sum"),
                        F.lit(0).alias("n"), F.lit(None).cast("long").alias("least"))

        def step(s: Column, x: Column) -> Column:
            same, falls = x["leaves"] == x["enters"], x["leaves"] != none
            into, out = F.get(s["counts"], x["enters"]), F.get(s["counts"], F.greatest(x["leaves"], F.lit(0)))
            counts = F.transform(s["counts"], lambda c, j: F.when(j == x["enters"], c + 1).when(j == x["leaves"], c - 1).otherwise(c))
            change = weight(into + 1) - weight(into) + F.when(falls, weight(out - 1) - weight(out)).otherwise(F.lit(0).cast("long"))
            total = s["sum"] + F.when(same, F.lit(0).cast("long")).otherwise(change)
            least = F.when(s["n"] + 1 >= least_window, F.least(s["least"], total)).otherwise(s["least"])
            return F.struct(F.when(same, s["counts"]).otherwise(counts).alias("counts"), total.alias("sum"), (s["n"] + 1).alias("n"), least.alias("least"))

        n = least_window.cast("double")
        return F.log2(n) - F.aggregate(steps, zero, step)["least"] / PARTS / n

    return let(F.transform(F.split(candidate, ""), lambda c: F.instr(F.lit(alphabet), c)), best)


def _judge(c: EntropyClass, allow: tuple[str, ...]) -> Callable[[Column], Column]:
    """Is a candidate of the class a secret."""
    def odd(s: Column) -> Column:
        hit = s["hit"]
        asked = F.lit(True)
        for need in c.needs:
            asked &= hit.rlike(need)
        for known in allow:
            asked &= ~hit.rlike(known)
        folded = hit if c.alphabet != c.alphabet.lower() else F.lower(hit)
        return F.when(asked, window_bits(folded, c.alphabet, c.window) >= c.bits).otherwise(False)

    return odd


def scan(df: DataFrame, text_col: str = "text", classes: tuple[EntropyClass, ...] = ENTROPY_CLASSES, allow: tuple[str, ...] = ALLOW,
         spans_col: str = "secret_spans") -> DataFrame:
    """All columns of ``df`` plus ``spans_col``, the spans found in the whole text.

    Spans are structs (start, kind_order, end, kind) in code points, end
    exclusive, sorted by start and then by kind.  Base kinds (assign, access,
    hex) are always kept; entropy kinds are added unless an ``allow`` pattern
    finds the candidate.  A null or empty text has no spans.  Rows are judged
    alone: repeated rows get equal spans, no rows give no rows.  An input column
    named like ``spans_col`` is replaced; others may have any name.
    """
    names = [c for c in df.columns if c != spans_col]
    patterns = [("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), *((c.kind, c.pattern) for c in classes)]
    rows = df.select(F.struct(*(df[c] for c in names)).alias("row"), as_text(text_col).alias("text"))
    hits = rows.withColumns({f"hits_{kind}": F.regexp_extract_all("text", F.lit(pattern), F.lit(0)) for kind, pattern in patterns})
    placed = hits.withColumns({f"found_{kind}": _spans(F.col("text"), F.col(f"hits_{kind}"), pattern, kind, i) for i, (kind, pattern) in enumerate(patterns)})
    found = [F.filter("found_assign", lambda s: F.length(F.regexp_extract(s["hit"], ASSIGN, 1)) >= 6), F.col("found_access"), F.col("found_hex")]
    found += [F.filter(f"found_{c.kind}", _judge(c, allow)) for c in classes]
    none = F.array().cast(SPAN)
    slim = [F.coalesce(F.transform(f, lambda s: F.struct(s["start"].alias("start"), s["kind_order"].alias("kind_order"), s["end"].alias("end"), s["kind"].alias("kind"))), none) for f in found]
    return placed.select("row.*", F.array_sort(F.concat(*slim)).alias(spans_col))


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(df: DataFrame, text_col: str = "text", placeholder: str = "[REDACTED]", spans_col: str = "secret_spans") -> DataFrame:
    """Replace every span of ``scan`` in the text with the placeholder; overlapping spans make one.

    Returns the columns of ``df`` without the spans.  Texts without spans,
    null ones too, stay as they are.
    """
    text, spans = F.col(text_col), F.col(spans_col)
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(state: Column, s: Column) -> Column:
        piece = F.concat(F.substring(text, state["at"] + 1, s["start"] - state["at"]), F.lit(placeholder))
        fresh = F.struct(s["end"].alias("at"), F.array_append(state["parts"], piece).alias("parts"))
        longer = F.struct(F.greatest(state["at"], s["end"]).alias("at"), state["parts"].alias("parts"))
        return F.when((s["start"] < state["at"]) & (F.size(state["parts"]) > 0), longer).otherwise(fresh)

    cut = F.aggregate(spans, zero, step, lambda s: F.concat(F.array_join(s["parts"], ""), F.substring(text, s["at"] + 1, F.length(text))))
    return df.withColumn(text_col, F.when(F.size(spans) > 0, cut).otherwise(text)).drop(spans_col)
