"""Periodic runs of words by internal pattern matching (operator 12).

A run is a longest stretch of words with smallest period q (words q apart are
equal) of at least LEAST words and POWER periods.

Whole texts are put together to pieces of about PIECE words, never cut.  In a task:

1. The suffixes of a piece are put in order by prefix doubling.  Equal words of
   two texts are different symbols, so nothing matches across texts, and a
   suffix without an equal in its text leaves the sorting early.
2. A run holds a dyadic block (of 2^k words, at a multiple of 2^k) that spans
   one to two of its periods, and the block occurs again one period further on,
   in the next or the previous neighbouring window.  The block's occurrences are
   an interval of the suffix array.  The range successor and predecessor of the
   block's place in that interval come from a wavelet tree over the array; the
   occurrences near the block form a progression whose difference, if it lies
   in (2^(k-1), 2^k], is a candidate period.
3. The ranks of the doubling give longest common extensions in both directions,
   exactly; a candidate that extends to a run is kept, once.

All comparisons are exact (ranks, not hashes).  No row is shuffled.

Defined results: a null, empty or blank text has no words and no runs; repeated
rows each come back; a null id stays null; very long texts are pieces of their
own, in memory that grows with the longest text alone; an empty table gives no
rows; columns other than the id and the text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablepipe.llm.texts import pieces, words

LEAST = 6
POWER = 4
# Bytes of text that a task looks at together, if a single text is not longer.
PIECE = 1 << 20


class Runs(NamedTuple):
    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


class WaveletTree:
    """Values in array order; counts and order statistics of any interval of it."""

    def __init__(self, values: np.ndarray):
        self.bits = max(int(values.max(initial=0)).bit_length(), 1)
        self.ones, self.zeros = [], []
        for bit in range(self.bits - 1, -1, -1):
            one = (values >> bit) & 1
            sums = np.zeros(len(values) + 1, np.int32)
            np.cumsum(one, out=sums[1:])
            self.ones.append(sums)
            self.zeros.append(len(values) - int(sums[-1]))
            values = np.concatenate([values[one == 0], values[one == 1]])

    def below(self, low: np.ndarray, high: np.ndarray, value: np.ndarray) -> np.ndarray:
        """How many of array[low:high] are smaller than ``value``."""
        low, high, count = low.copy(), high.copy(), np.zeros(len(low), np.int64)
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            one_low, one_high = ones[low], ones[high]
            right = (value >> (self.bits - 1 - level)) & 1 == 1
            count += np.where(right, (high - one_high) - (low - one_low), 0)
            low = np.where(right, zeros + one_low, low - one_low)
            high = np.where(right, zeros + one_high, high - one_high)
        return count

    def smallest(self, low: np.ndarray, high: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The value at ``place`` (from 0) of the sorted array[low:high]."""
        low, high, place, value = low.copy(), high.copy(), place.copy(), np.zeros(len(low), np.int64)
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            one_low, one_high = ones[low], ones[high]
            left = (high - one_high) - (low - one_low)
            right = place >= left
            place -= np.where(right, left, 0)
            value += np.where(right, 1 << (self.bits - 1 - level), 0)
            low = np.where(right, zeros + one_low, low - one_low)
            high = np.where(right, zeros + one_high, high - one_high)
        return value


def suffix_ranks(symbols: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """ranks[k][i]: how many suffixes are smaller than that at i in their first
    2^k symbols, so that equal pieces of 2^k symbols share a rank.  ``ends[i]`` is
    where the text of i ends; symbols of different texts differ.  The last level
    has no ties."""
    n = len(symbols)
    _, inverse, counts = np.unique(symbols, return_inverse=True, return_counts=True)
    rank = (np.cumsum(counts) - counts)[inverse].astype(np.int32)
    live, step, out = np.flatnonzero(counts[inverse] > 1), 1, []
    while True:
        out.append(rank)
        if not len(live):
            return out
        rank = rank.copy()
        after = np.where(live + step < ends[live], out[-1][np.minimum(live + step, n - 1)], -1)
        order = np.lexsort((after, rank[live]))
        live, after = live[order], after[order]
        head = rank[live]
        new_head = np.concatenate([[True], head[1:] != head[:-1]])
        new = new_head | np.concatenate([[True], after[1:] != after[:-1]])
        index = np.arange(len(live))
        starts = np.maximum.accumulate(np.where(new_head, index, 0))
        here = np.maximum.accumulate(np.where(new, index, 0))
        rank[live] = head + here - starts
        sizes = np.diff(np.append(np.flatnonzero(new), len(live)))
        live = live[np.repeat(sizes, sizes) > 1]
        step *= 2


def runs(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray, least: int = LEAST, power: int = POWER) -> Runs:
    """The runs of texts laid end to end; ``starts`` and ``ends``: of each symbol's
    text.  By start, then period."""
    none = Runs(*np.zeros((3, 0), np.int64))
    if len(symbols) < least:
        return none
    ranks = suffix_ranks(symbols, ends)
    array = np.empty(len(symbols), np.int64)
    array[ranks[-1]] = np.arange(len(symbols))
    tree, found_at, found_period = WaveletTree(array), [], []
    longest = int((ends - starts).max())
    for k, rank in enumerate(ranks):
        block = 1 << k
        if block >= 2 * longest // power:
            break
        at = np.arange(0, len(symbols), block)
        size = np.bincount(rank, minlength=len(symbols))
        at = at[size[rank[at]] > 1]
        low = rank[at].astype(np.int64)
        high = low + size[rank[at]]
        mine = tree.below(low, high, at)
        for side in (1, -1):
            there = (mine + side >= 0) & (mine + side < high - low)
            here = at[there]
            other = tree.smallest(low[there], high[there], mine[there] + side)
            period = np.abs(other - here)
            fits = (period <= block) & (2 * period > block)
            found_at.append(np.minimum(here, other)[fits])
            found_period.append(period[fits])
    at, period = np.concatenate(found_at), np.concatenate(found_period)
    if not len(at):
        return none
    # Longest common extensions of (at, at + period), to the right and to the left.
    right, left = at.copy(), at.copy()
    for k in range(len(ranks) - 1, -1, -1):
        rank, reach = ranks[k], 1 << k
        other = right + period
        same = other < ends[at]
        same &= rank[np.where(same, right, 0)] == rank[np.where(same, other, 0)]
        right = np.where(same, right + reach, right)
        before = left - reach
        same = before >= starts[at]
        same &= rank[np.where(same, before, 0)] == rank[np.where(same, before + period, 0)]
        left = np.where(same, before, left)
    length = right + period - left
    keep = length >= np.maximum(least, power * period)
    unique = np.unique(np.stack([left[keep], period[keep], length[keep]], axis=1), axis=0)
    return Runs(unique[:, 0], unique[:, 2], unique[:, 1])


def planted(counts: np.ndarray, hashes: list[int | None]) -> np.ndarray:
    """For each word of the texts which original word stands there: of every tenth
    text by its hash, the words from some place on repeat a stretch of it."""
    out = np.arange(int(counts.sum()))
    first = np.cumsum(counts) - counts
    for j, h in enumerate(hashes):
        n = int(counts[j])
        if h is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            at = int(first[j])
            out[at + a : at + n] = at + a + np.arange(n - a) % p
    return out


def collapse_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hashes: Column | None = None, least: int = LEAST, power: int = POWER) -> DataFrame:
    """doc_id, words (of the text as searched), runs (start, length, period of each,
    by start and period) and collapsed (the words left when every run keeps its
    first period, joined by a space) of each row.

    ``hashes``: a long column; texts of every tenth value get a periodic tail
    (see ``planted``), others and nulls stay as they are."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), (F.lit(None) if hashes is None else hashes).cast("long").alias("h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, 1, PIECE):
            found, counts = words(b.column(1))
            place = planted(counts, b.column(2).to_pylist())
            bounds = np.concatenate([[0], np.cumsum(counts)])
            text = np.repeat(np.arange(len(counts)), counts)
            codes = found.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)[place]
            got = runs(text << 32 | codes, bounds[text], bounds[text + 1], least, power)
            turn = np.zeros(len(place) + 1, np.int64)
            np.add.at(turn, got.start + got.period, 1)
            np.add.at(turn, got.start + got.length, -1)
            stays = np.cumsum(turn)[:-1] == 0
            left = np.concatenate([[0], np.cumsum(stays)])[bounds]
            kept = pa.LargeListArray.from_arrays(pa.array(left, pa.int64()), found.take(pa.array(place[stays])))
            joined = pc.binary_join(kept, pa.scalar(b" ", pa.large_binary())).cast(pa.binary())
            of = text[got.start] if len(text) else np.zeros(0, np.int64)
            lists = pa.StructArray.from_arrays([pa.array(got.start - bounds[of]), pa.array(got.length), pa.array(got.period)], names=["start", "length", "period"])
            ends = np.searchsorted(of, np.arange(len(counts) + 1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts.astype(np.int64)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), lists), joined], names=["doc_id", "words", "runs", "collapsed"])

    return rows.mapInArrow(run, f"doc_id {kind}, words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary")


def digest(found: DataFrame) -> DataFrame:
    """The columns of the result table: the number of runs, the run of the greatest
    exponent, and checksums of all runs and of the collapsed text."""
    kind = found.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            count, best, lines = [], [], []
            for row in b.column(1).to_pylist():
                count.append(len(row))
                top = max(row, key=lambda r: (Fraction(r["length"], r["period"]), -r["start"], -r["period"]), default=None)
                best.append((top["start"], top["length"], top["period"], 1000 * top["length"] // top["period"]) if top else (None,) * 4)
                lines.append(hashlib.sha256("".join(f"{r['start']},{r['length']},{r['period']}\n" for r in row).encode()).hexdigest())
            longs = [pa.array([x[j] for x in best], pa.int64()) for j in range(4)]
            whole = [hashlib.sha256(x.as_buffer()).hexdigest() for x in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(count, pa.int64()), *longs, pa.array(lines), pa.array(whole)], names=["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"])

    return found.select("doc_id", "runs", "collapsed").mapInArrow(run, f"doc_id {kind}, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string")
