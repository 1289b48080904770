"""Periodic runs of words, found online by dyadic square catching.

Words are appended to a stream. Level k has the completed blocks of 2^k words; the block that starts at i is the catcher of all squares
whose period q lies in [2^k, 2^(k+1)) (level FIRST: in [1, 2^(k+1))) and whose first half holds the block: they repeat it at
i + q. So at each appended word a level compares one suffix of 2^k words with one catcher (two at level FIRST), by hashes that double
from level to level. A hash that agrees reports a new square; reports of a stretch that is known already, or of a
multiple of its period, merge into it, any other is compared word by word in both directions, and a stretch that reaches
the end of the stream goes on as words come. Every run of at least three periods and 24 words holds such a block, so none is missed, and the
comparison of words makes every report exact.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilelake.llm.common import column, documents, free_names

#: The smallest block has 2^FIRST words: a run of 24 words or more, three periods or more, repeats an aligned block of 8.
FIRST = 3
MIN_LENGTH, MIN_PERIODS = 24, 3
#: Words appended at a time; short texts share a stream of as many, kept apart by words of their own.
SEGMENT = 1 << 16


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finishing steps of the splitmix64 generator (fixed constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class SquareCatcher:
    """Runs of a stream of ``size`` word numbers: at least ``min_length`` words (24 or more) and three periods.

    No run is longer than ``longest``. Of the hashes only what later words can need is kept.
    """

    def __init__(self, size: int, longest: int, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS):
        if min_length < MIN_LENGTH or min_periods < MIN_PERIODS:
            raise ValueError("shorter runs need not hold a block")
        self.min_length, self.min_periods = min_length, min_periods
        self.words, self.n = np.empty(size, np.int64), 0
        # a period is at most a third of the longest text, so larger blocks can catch nothing
        top = max(FIRST + 1, (longest // min_periods).bit_length())
        self.hashes = [np.zeros(0, np.uint64) for _ in range(top)]
        self.base = [0] * top  # the place of each level's first hash that is kept
        self.runs: dict[int, list[list[int]]] = {}  # period: [start, end] by start
        self.open: dict[tuple[int, int], int] = {}  # (period, start) of stretches that reach the last word: their end
        self.last: dict[int, tuple[int, int]] = {}  # period: the last stretch seen, run or not

    def append(self, words: np.ndarray) -> None:
        self.words[self.n : self.n + len(words)] = words
        self.n += len(words)
        for (period, start), end in sorted(self.open.items()):
            self._settle(period, start, self._right(end - period, period) + period)
        for k in range(len(self.hashes)):
            seen, upto = self.base[k] + len(self.hashes[k]), max(self.n - (1 << k) + 1, 0)
            if upto <= seen:
                break
            if k == 0:
                new = _mixed(words.astype(np.uint64))
            else:
                lower, at, half = self.hashes[k - 1], seen - self.base[k - 1], 1 << (k - 1)
                new = lower[at : at + upto - seen] * np.uint64(0x9E3779B97F4A7C15) + lower[at + half : at + half + upto - seen]
                new = _mixed(new)
            self.hashes[k] = np.concatenate([self.hashes[k], new])
            if k >= FIRST:
                self._catch(k, seen, upto)
        for k in range(len(self.hashes)):
            needed = max(self.n - (4 << k), self.base[k])
            self.hashes[k], self.base[k] = self.hashes[k][needed - self.base[k] :], needed

    def _catch(self, level: int, seen: int, upto: int) -> None:
        """Compare the suffixes of 2^level words that begin at seen..upto-1 with their catchers."""
        hashes, base, size = self.hashes[level], self.base[level], 1 << level
        at = np.arange(seen, upto)
        own = at >> level << level
        blocks, places = [], []
        for block in (own - size, own) if level == FIRST else (own - size,):
            fits = (block >= 0) & (block < at)
            hit = np.flatnonzero(fits & (hashes[np.maximum(block - base, 0)] == hashes[at - base]))
            blocks.append(block[hit])
            places.append(at[hit])
        block, place = np.concatenate(blocks), np.concatenate(places)
        if not len(block):
            return
        period = place - block
        order = np.lexsort((block, period))
        block, period = block[order], period[order]
        fresh = np.ones(len(block), bool)
        periods = np.unique(period)
        for q in sorted(self.runs):
            fresh &= ~self._inside(q, block, period, size)
        for q in periods:
            mine = slice(*np.searchsorted(period, [q, q + 1]))
            left = block[mine][fresh[mine]]
            if level == FIRST and len(left):
                for d in [d for d in self.runs if d < q and q % d == 0]:
                    left = left[~self._inside(d, left, np.full(len(left), q), size)]
            self._report(int(q), left.tolist(), size)

    def _inside(self, known: int, block: np.ndarray, period: np.ndarray, size: int) -> np.ndarray:
        """Which reports lie in a known run whose period divides theirs: they tell nothing new."""
        spans = np.array(self.runs[known])
        at = np.searchsorted(spans[:, 0], block, side="right") - 1
        return (period % known == 0) & (at >= 0) & (block + period + size <= spans[np.maximum(at, 0), 1])

    def _report(self, period: int, blocks: list[int], size: int) -> None:
        """Squares of one period, first to last: each outside the stretch before it starts a stretch of its own."""
        start, end = self.last.get(period, (0, 0))
        for block in blocks:
            if start <= block and block + size + period <= end:
                continue
            start, end = self._left(block, period), self._right(block, period) + period
            self._settle(period, start, end)

    def _right(self, at: int, period: int) -> int:
        """The first place from ``at`` on whose word does not come again ``period`` later, as far as words are known."""
        words, last, step = self.words, self.n - period, 64
        while at < last:
            stop = min(at + step, last)
            apart = words[at:stop] != words[at + period : stop + period]
            if apart.any():
                return at + int(apart.argmax())
            at, step = stop, step * 2
        return at

    def _left(self, at: int, period: int) -> int:
        """The smallest start of a stretch before ``at`` in which every word comes again ``period`` later."""
        words, step = self.words, 64
        while at > 0:
            stop = max(at - step, 0)
            apart = words[stop:at] != words[stop + period : at + period]
            if apart.any():
                return at - int(apart[::-1].argmax())
            at, step = stop, step * 2
        return 0

    def _settle(self, period: int, start: int, end: int) -> None:
        """Keep a stretch: as a run if it is long enough, and for later words if it reaches the last one."""
        self.last[period] = (start, end)
        if end == self.n:
            self.open[period, start] = end
        else:
            self.open.pop((period, start), None)
        if end - start >= max(self.min_length, self.min_periods * period) and not self._repeats(period, start, end):
            spans = self.runs.setdefault(period, [])
            place = bisect_right(spans, start, key=lambda span: span[0])
            if place and spans[place - 1][0] == start:
                spans[place - 1][1] = end
            else:
                spans.insert(place, [start, end])

    def _repeats(self, period: int, start: int, end: int) -> bool:
        """Whether a stretch is a run of a smaller period; that one is settled first."""
        for known, spans in self.runs.items():
            if known < period and period % known == 0:
                place = bisect_right(spans, start, key=lambda span: span[0])
                if place and spans[place - 1][1] >= end:
                    return True
        return False

    def found(self) -> list[tuple[int, int, int]]:
        """(start, length, period) by start, then period."""
        return sorted((s, e - s, q) for q, spans in self.runs.items() for s, e in spans)


def runs_of(texts: list[np.ndarray], min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of each text's runs by start, then period; texts are arrays of word numbers from 0 on.

    All are one stream, in which each text ends with a word that stands nowhere else.
    """
    ends = np.cumsum([len(t) + 1 for t in texts])
    stream, first = np.empty(int(ends[-1]) if len(texts) else 0, np.int64), 0
    for i, words in enumerate(texts):
        stream[first : first + len(words)] = words
        first = int(ends[i])
        stream[first - 1] = -1 - i
    catcher = SquareCatcher(len(stream), max(map(len, texts), default=0), min_length, min_periods)
    for at in range(0, len(stream), SEGMENT):
        catcher.append(stream[at : at + SEGMENT])
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, length, period in catcher.found():
        text = int(np.searchsorted(ends, start, side="right"))
        out[text].append((start - (int(ends[text - 1]) if text else 0), length, period))
    return out


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of most periods, compared as exact fractions; ties go to the smaller start, then period."""
    best = None
    for run in runs:
        # runs come by start and period, so an equal one never wins
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words but for those that a run holds after its first period, joined by spaces."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(keep)])


_RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])


def _found(text: str, result: pa.Schema, rewrite, min_length: int, min_periods: int):
    run_type = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])
    types = [pa.int64(), pa.list_(run_type), run_type, pa.string()]

    def answered(rows: list[tuple], kept: list[str]) -> pa.RecordBatch:
        numbers: dict[bytes, int] = {}
        words = [r[1] for r in rows]
        found = runs_of([np.fromiter((numbers.setdefault(w, len(numbers)) for w in ws), np.int64, len(ws)) for ws in words], min_length, min_periods)
        named = lambda run: None if run is None else dict(zip(("start", "length", "period"), run))
        columns = [
            pa.array(list(map(len, words)), types[0]),
            pa.array([list(map(named, runs)) for runs in found], types[1]),
            pa.array([named(strongest(runs)) for runs in found], types[2]),
            pa.array([collapsed(ws, runs).decode("utf-8", "surrogatepass") for ws, runs in zip(words, found)], types[3]),
        ]
        carried = pa.concat_tables([r[0] for r in rows]).combine_chunks() if kept else None
        before = [carried.column(c).combine_chunks() for c in kept] if kept else []
        names = [*kept, *result]
        return pa.RecordBatch.from_arrays([*before, *columns], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, n = [], 0
        for batch in batches:
            kept = [c for c in batch.schema.names if c not in (text, "_rewrite_id")]
            whole = pa.Table.from_batches([batch]).select(kept)
            ids = batch.column("_rewrite_id").to_pylist() if rewrite else None
            for i in range(batch.num_rows):
                value = batch.column(text)[i].as_py()
                words = value.encode("utf-8", "surrogatepass").split() if value else []
                if rewrite:
                    words = rewrite(words, ids[i])
                rows.append((whole.slice(i, 1), words))
                n += len(words)
                if n >= SEGMENT:
                    yield answered(rows, kept)
                    rows, n = [], 0
            if rows:
                yield answered(rows, kept)
                rows, n = [], 0

    return run


def find(
    docs: DataFrame,
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_periods: int = MIN_PERIODS,
    rewrite: Callable[[list[bytes], str | None], list[bytes]] | None = None,
    id_col: str = "doc_id",
) -> DataFrame:
    """``docs`` without their text, with n_words, runs, strongest_run and collapsed_text.

    ``runs`` are (start, length, period) of every stretch of words with that smallest period, as long as it goes, of at least
    ``min_length`` words and ``min_periods`` periods, by start and then period. ``strongest_run`` has most periods (ties: smaller start, then period) and is
    null without runs; ``collapsed_text`` has the words that no run holds after its first period, joined by single spaces. A word is what stands between
    white space of ASCII, compared as it is written. ``rewrite`` may change a row's words, given its id as text.

    A null or empty text has no words and no run. Rows repeat as they are; an empty table gives an empty result. Columns named as a
    result are replaced.
    """
    results = ["n_words", "runs", "strongest_run", "collapsed_text"]
    kept = [f for f in docs.schema.fields if f.name.lower() not in {*results, text_col.lower()}]
    plain = free_names(docs, *(f"_c{i}" for i in range(len(kept))), "_text")
    rows = docs.select(
        *(column(f.name).alias(a) for f, a in zip(kept, plain)),
        column(text_col).cast("string").alias(plain[-1]),
        *([column(id_col).cast("string").alias("_rewrite_id")] if rewrite else []),
    )
    schema = T.StructType(
        [T.StructField(a, f.dataType) for f, a in zip(kept, plain)]
        + [T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(_RUN)), T.StructField("strongest_run", _RUN), T.StructField("collapsed_text", T.StringType())]
    )
    found = rows.mapInArrow(_found(plain[-1], results, rewrite, min_length, min_periods), schema)
    return found.select(*(F.col(a).alias(f.name) for f, a in zip(kept, plain)), *results)


def planted(words: list[bytes], doc_id: str | None) -> list[bytes]:
    """The contract's periodic tail: with h the crc32 of the id, a tenth of the documents repeats a stretch of its words to the end.

    A row without an id stays as it is.
    """
    import zlib

    h = zlib.crc32(doc_id.encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def op12(spark, sf_dir) -> DataFrame:
    found = find(documents(spark, sf_dir).select("doc_id", "text"), rewrite=planted)
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.col("strongest_run")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("1000 * strongest_run.length div strongest_run.period").alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed_text", 256).alias("collapsed_sha256"),
    )
