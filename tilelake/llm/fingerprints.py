"""Document fingerprints by consistent weighted sampling.

A text is a bag of words weighted by their counts. For each of SAMPLES samples and each word, three random numbers are
drawn from the word's hash alone: r and c from Gamma(2, 1), b uniform. With t = floor(ln(weight) / r + b) the word gets
the value ln(c) - r (t - b) - r, and the sample is the word of least value with its t. Two texts agree in a
sample with a probability equal to the generalised Jaccard similarity of their bags.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilelake.llm.common import documents, partitions

SAMPLES = 128
#: Words that a task keeps: with their value at one occurrence, and with all their random numbers (words that a text repeats).
KEPT_WORDS, KEPT_REPEATED = 180_000, 20_000
#: Words of a text that are weighed at a time, and words whose numbers are drawn at a time, so that their arrays stay in a core's cache.
AT_ONCE, DRAWN = 4096, 32
_EMPTY = "0" * (8 * SAMPLES)


def _mix(x: np.ndarray, shifted: np.ndarray) -> np.ndarray:
    """The finishing steps of the splitmix64 generator (fixed constants), in place; ``shifted`` is room for one step."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, None)):
        np.right_shift(x, np.uint64(shift), out=shifted)
        np.bitwise_xor(x, shifted, out=x)
        if factor is not None:
            np.multiply(x, np.uint64(factor), out=x)
    return x


class _Kept:
    """Arrays with a row for each of the last words, at most ``size`` of them."""

    def __init__(self, size: int, samples: int, tables: int):
        self.places: dict[bytes, int] = {}
        self.tables = [np.empty((size, samples), np.float32) for _ in range(tables)]
        self.ids = np.empty(size, np.uint64)

    def rows(self, words: list[bytes]) -> tuple[np.ndarray, int, list[bytes]]:
        """The words' rows, the first of the new ones among these, and the words that they are for."""
        rows = np.fromiter(map(self.places.get, words, repeat(-1)), np.intp, len(words))
        unknown = np.flatnonzero(rows < 0)
        if len(self.places) + len(unknown) > len(self.ids):
            self.places.clear()
            unknown = np.arange(len(words))
        start, new = len(self.places), [words[i] for i in unknown.tolist()]
        rows[unknown] = np.arange(start, start + len(new))
        self.places.update(zip(new, range(start, start + len(new))))
        return rows, start, new


class Sampler:
    """Signatures of bags of words, with the random numbers of recent words kept."""

    def __init__(self, samples: int = SAMPLES):
        self.steps = np.arange(1, 5 * samples + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        self.every, self.none = np.arange(samples), np.zeros(samples, np.int64)
        self.once, self.often = _Kept(KEPT_WORDS, samples, 1), _Kept(KEPT_REPEATED, samples, 3)
        # room for the steps of a draw, which stays in a core's cache
        self.mixed, self.shifted = (np.empty((DRAWN, 5 * samples), np.uint64) for _ in range(2))
        self.uniform = np.empty((DRAWN, 5, samples))
        self.numbers = [np.empty((DRAWN, samples), np.float32) for _ in range(3)]

    def _draw(self, ids: np.ndarray) -> list[np.ndarray]:
        """r, b and ln(c) of at most DRAWN words, in arrays that the next draw overwrites."""
        n = len(ids)
        x, uniform, (r, b, c) = self.mixed[:n], self.uniform[:n], (a[:n] for a in self.numbers)
        np.add(ids[:, None], self.steps, out=x)
        _mix(x, self.shifted[:n])
        np.right_shift(x, np.uint64(11), out=x)
        # 53 bits, which signed integers and doubles hold as well
        uniform[...] = x.view(np.int64).reshape(uniform.shape)
        uniform += 1.0
        uniform *= 2.0**-53 * (1 - 2.0**-20)
        for gamma, first in ((r, 0), (c, 2)):
            np.multiply(uniform[:, first], uniform[:, first + 1], out=gamma, casting="same_kind")
            np.log(gamma, out=gamma)
            np.negative(gamma, out=gamma)
        np.log(c, out=c)
        b[...] = uniform[:, 4]
        return [r, b, c]

    def _learn(self, words: list[bytes], repeated: bool) -> tuple[_Kept, np.ndarray]:
        """Where the words are kept, and their rows there."""
        kept = self.often if repeated else self.once
        rows, start, new = kept.rows(words)
        if new:
            kept.ids[start : start + len(new)] = np.fromiter(map(xxhash.xxh64_intdigest, new, repeat(7)), np.uint64, len(new))
        for first in range(start, start + len(new), DRAWN):
            some = slice(first, min(first + DRAWN, start + len(new)))
            r, b, c = numbers = self._draw(kept.ids[some])
            if repeated:
                for table, drawn in zip(kept.tables, numbers):
                    table[some] = drawn
            else:
                # a word that occurs once has t = 0
                np.multiply(r, b, out=b)
                np.add(c, b, out=c)
                np.subtract(c, r, out=kept.tables[0][some])
        return kept, rows

    def signature(self, bag: dict[bytes, int]) -> np.ndarray | None:
        """One 32-bit number per sample; None for an empty bag."""
        if not bag:
            return None
        often = [w for w, n in bag.items() if n > 1]
        once = [w for w, n in bag.items() if n == 1] if often else list(bag)
        least = word = step = None
        for words, repeated in ((once, False), (often, True)):
            for i in range(0, len(words), AT_ONCE):
                some = words[i : i + AT_ONCE]
                kept, rows = self._learn(some, repeated)
                values = kept.tables[0].take(rows, axis=0)
                if repeated:
                    weight = np.log(np.fromiter(map(bag.__getitem__, some), np.float32, len(some)))
                    b, c = (table.take(rows, axis=0) for table in kept.tables[1:])
                    t = np.floor(weight[:, None] / values + b)
                    values = c - values * (t - b) - values
                at = values.argmin(axis=0)
                lower, ids = values[at, self.every], kept.ids[rows[at]]
                steps = t[at, self.every].astype(np.int64) if repeated else self.none
                if least is None:
                    least, word, step = lower, ids, steps
                    continue
                # an exact tie goes to the smaller word hash
                wins = (lower < least) | ((lower == least) & (ids < word))
                least, word, step = np.where(wins, lower, least), np.where(wins, ids, word), np.where(wins, steps, step)
        mixed = _mix(word + step.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), np.empty_like(word))
        return (mixed >> np.uint64(32)).astype(np.uint32)


def bag_of(text: str) -> Counter:
    return Counter(text.encode("utf-8", "surrogatepass").split())


def likeness(a: np.ndarray | None, b: np.ndarray | None) -> float:
    """The share of equal samples; two empty texts are alike, an empty one is unlike any other."""
    if a is None or b is None:
        return float(a is b)
    return float((a == b).mean())


def hex_of(signature: np.ndarray | None) -> str:
    return _EMPTY if signature is None else signature.astype(">u4").tobytes().hex()


def edited_text(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much (or all) of the start of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by bucket, each row followed by the next document of its bucket; a guest only ends its bucket."""
    sampler, held, names = Sampler(), None, [f.split()[0] for f in _RESULT.split(", ")]
    schema = pa.schema([(n, pa.int64() if n in ("doc_id", "n_chars") else pa.float64() if n.startswith("near") else pa.string()) for n in names])
    for batch in batches:
        out = []
        for row in zip(*(batch.column(n).to_pylist() for n in ("bucket", "doc_id", "text", "guest"))):
            bucket, _, text, _ = row
            signature = sampler.signature(bag_of(text))
            if held is not None and held[0][0] == bucket and not held[0][3]:
                (_, doc_id, before, _), own = held
                edited = edited_text(before, text)
                changed = own if edited == before else sampler.signature(bag_of(edited))
                digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
                out.append((doc_id, len(before), digest, hex_of(own), hex_of(changed), likeness(own, changed), likeness(own, signature)))
            held = (row, signature)
            if len(out) >= 256:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text; see the contract columns in ``_RESULT``.

    The next document is the one of next smaller id; after the smallest comes the largest. Null ids
    come last and keep their null. Rows of equal id come in order of their text. Null texts count as empty; an empty text has the
    fingerprint of zeros. A table of one row is its own next document; an empty table gives an empty result.
    Other columns are not read.

    Ids are cut into ranges at quantiles, one range a bucket; each bucket is sorted in its task and ends with a copy of the
    next bucket's first row, so that no row needs another task's.
    """
    spark = docs.sparkSession
    lowest = -(2**63)
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(lowest)).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    n = partitions(spark)
    shares = [i / (4 * n) for i in range(1, 4 * n)]
    cuts = rows.agg(F.percentile_approx("id", shares, 10_000).alias("cuts")).first()["cuts"]
    cuts = sorted(set(cuts or []))
    edges = F.array(*(F.lit(c) for c in cuts)) if cuts else F.array().cast("array<bigint>")
    # bucket 0 has the largest ids: the number of cuts that are larger than the id
    bucket = F.size(F.filter(edges, lambda c: c > F.col("id")))
    dealt = rows.select(bucket.alias("bucket"), "id", "text")
    tops = {r["bucket"]: r["id"] for r in dealt.groupBy("bucket").agg(F.max("id").alias("id")).collect()}
    # one row a range comes back: each range's largest id goes, as a guest, to the end of the range before it
    order = sorted(tops)
    before = {tops[b]: order[i - 1] for i, b in enumerate(order)}
    goes = F.element_at(F.create_map(*(F.lit(x) for pair in before.items() for x in pair)), F.col("id")) if before else F.lit(None).cast("int")
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("guest"))
    guest = F.struct(goes.alias("bucket"), F.lit(True).alias("guest"))
    twice = dealt.select("id", "text", F.explode(F.when(goes.isNull(), F.array(own)).otherwise(F.array(own, guest))).alias("to"))
    placed = twice.select("to.bucket", "to.guest", "id", "text").repartition(max(n, 1), "bucket")
    placed = placed.sortWithinPartitions("bucket", "guest", F.desc("id"), "text")
    placed = placed.select("bucket", F.nullif("id", F.lit(lowest)).alias("doc_id"), "text", "guest")
    return placed.mapInArrow(_fingerprints, _RESULT)


def op10(spark, sf_dir) -> DataFrame:
    return fingerprint(documents(spark, sf_dir))
