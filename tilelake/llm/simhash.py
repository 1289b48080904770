"""SimHash near-duplicates: a Gray-order hierarchical index, joined with itself.

Fingerprints are made distinct and cut into m bit blocks: two that differ in at most ``distance`` bits agree in at least
m - ``distance`` of them, so each is dealt by every such choice of blocks. Within a choice's value the fingerprints are sorted by Gray rank and packed into
nodes of FAN consecutive entries, nodes into nodes, each with the bits that all below it share. Pairs of
nodes are walked from the top: shared bits that differ are a lower bound of the distance and prune the whole pair of groups; if even
all other bits cannot exceed the distance, the two groups are linked by one edge; else their children are
compared, where the parents' difference is carried down and only newly shared bits are added. The walk gives
a spanning forest of each key's links, never all pairs. Edges are joined into components by star contraction.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilelake.llm.common import documents, free_names, partitions, words_of
from tilelake.runtime import checkpointed

#: Children of a node, node pairs compared at a time, fingerprints of one key in a chunk, and wanted under one key on average.
FAN, AT_ONCE, CHUNK, PER_KEY = 8, 1 << 18, 2048, 256


def fingerprint_of(text: str | None, shingle: int = 4) -> int:
    """64-bit SimHash over the XXH64 (seed 42) of all word shingles, repeats included; 0 without words."""
    words = words_of(text)
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes) - 1
    starts = (ends - sizes + 1).tolist()
    last = ends[min(shingle, len(words)) - 1 :].tolist()
    digest, ones, n = xxhash.xxh64_intdigest, np.zeros(64, np.int64), len(last)
    for i in range(0, n, 65536):
        hashes = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts[i : i + 65536], last[i : i + 65536])), np.uint64)
        ones += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n).view(">u8")[0])


def _signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64).view(np.int64)


def with_fingerprints(docs: DataFrame, out: str, text_col: str, shingle: int) -> DataFrame:
    @F.pandas_udf("long")
    def simhash(texts):
        import pandas as pd

        return pd.Series(_signed(np.fromiter((fingerprint_of(t, shingle) for t in texts), np.uint64, len(texts))))

    return docs.withColumn(out, simhash(F.col(text_col)))


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each 64-bit code in the reflected Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class _Forest:
    """Union by smallest index."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def roots(self, x: np.ndarray) -> np.ndarray:
        found = self.up[x]
        while True:
            higher = self.up[found]
            if (higher == found).all():
                return found
            found = higher

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.roots(a), self.roots(b)
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.up, np.maximum(ra, rb), np.minimum(ra, rb))
            if len(a):
                self.up = self.up[self.up]


def _levels(codes: np.ndarray, groups: np.ndarray) -> list[dict]:
    """Nodes from leaves up: first and last child, group, shared bits and whether a parent has them."""
    n = len(codes)
    level = {"first": np.arange(n), "end": np.arange(n) + 1, "group": groups, "mask": np.full(n, ~np.uint64(0)), "bits": codes, "low": np.arange(n)}
    levels = [level]
    while len(level["group"]) > 1:
        group = level["group"]
        heads = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        place = np.arange(len(group)) - np.repeat(heads, np.diff(np.r_[heads, len(group)]))
        first = np.flatnonzero(place % FAN == 0)
        if len(first) == len(group):
            break
        every = np.bitwise_and.reduceat(level["bits"], first)
        some = np.bitwise_or.reduceat(level["bits"], first)
        mask = np.bitwise_and.reduceat(level["mask"], first) & ~(every ^ some)
        level = {"first": first, "end": np.r_[first[1:], len(group)], "group": group[first], "mask": mask, "bits": every & mask, "low": level["low"][first]}
        levels.append(level)
    return levels


def _expand(level: dict, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All children of ``nodes``, and which of ``nodes`` each belongs to."""
    counts = level["end"][nodes] - level["first"][nodes]
    owner = np.repeat(np.arange(len(nodes)), counts)
    start = np.cumsum(counts) - counts
    return level["first"][nodes][owner] + np.arange(len(owner)) - start[owner], owner


def links(codes: np.ndarray, groups: np.ndarray, distance: int) -> np.ndarray:
    """For each code, the index of the smallest-index code of its group that a chain of links reaches.

    ``codes`` are in order of (group, Gray rank). Pairs at ``distance`` or less are linked.
    """
    levels = _levels(codes, groups)
    forest = _Forest(len(codes))
    top = levels[-1]
    # at the top every group is one node, to be compared with itself
    tops = np.arange(len(top["group"]))
    stack = [(len(levels) - 1, tops, tops, np.zeros(len(tops), np.int64), np.zeros(len(tops), np.uint64))]
    while stack:
        depth, a, b, carried, seen = stack.pop()
        level = levels[depth]
        if len(a) > AT_ONCE:
            stack += [(depth, a[i : i + AT_ONCE], b[i : i + AT_ONCE], carried[i : i + AT_ONCE], seen[i : i + AT_ONCE]) for i in range(0, len(a), AT_ONCE)]
            continue
        shared = level["mask"][a] & level["mask"][b]
        # bits of ``seen`` were counted by the parents: only the residual pattern is added
        differ = carried + np.bitwise_count((level["bits"][a] ^ level["bits"][b]) & shared & ~seen)
        loose = 64 - np.bitwise_count(shared).astype(np.int64)
        alive = differ <= distance
        if depth:
            # nodes that link as a whole need no comparison of their children
            whole = alive & (differ + loose <= distance)
            for x in (a[whole], b[whole]):
                leaves, owner = x, np.arange(len(x))
                for d in range(depth, 0, -1):
                    children, own = _expand(levels[d], leaves)
                    leaves, owner = children, owner[own]
                forest.link(leaves, levels[depth]["low"][a[whole]][owner])
            alive &= ~whole
        else:
            linked = alive & (a != b)
            forest.link(a[linked], b[linked])
            continue
        a, b, carried, seen = a[alive], b[alive], differ[alive], shared[alive]
        step = max(1, AT_ONCE // (FAN * FAN))
        for i in range(0, len(a), step):
            left, owner = _expand(level, a[i : i + step])
            right, pair = _expand(level, b[i : i + step][owner])
            left, owner = left[pair], owner[pair]
            keep = left <= right  # the other half comes from the mirrored pair of one node with itself
            keep |= (a[i : i + step] != b[i : i + step])[owner]
            stack.append((depth - 1, left[keep], right[keep], carried[i : i + step][owner[keep]], seen[i : i + step][owner[keep]]))
    return forest.roots(np.arange(len(codes)))


def _local_edges(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by key; whole keys are joined together, some AT_ONCE rows at a time."""
        held: list[tuple[np.ndarray, ...]] = []
        n = 0

        def joined(upto_end: bool):
            nonlocal held, n
            key, fp = (np.concatenate(x) for x in zip(*held))
            cut = len(key) if upto_end else int(np.searchsorted(key, key[-1]))
            held, n = ([(key[cut:], fp[cut:])], len(key) - cut) if cut < len(key) else ([], 0)
            key, codes = key[:cut], fp[:cut].view(np.uint64)
            if not len(codes):
                return None
            order = np.lexsort((gray_rank(codes), key))
            key, codes = key[order], codes[order]
            root = links(codes, key, distance)
            apart = root != np.arange(len(root))
            a, b = codes[apart].view(np.int64), codes[root[apart]].view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], names=["a", "b"])

        limit = AT_ONCE
        for batch in batches:
            if batch.num_rows:
                held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
                n += batch.num_rows
            if n >= limit:
                out = joined(False)
                limit = max(AT_ONCE, 2 * n)
                if out is not None:
                    yield out
        if held:
            out = joined(True)
            if out is not None:
                yield out

    return run


def near_edges(fingerprints: DataFrame, distance: int) -> DataFrame:
    """Edges (a > b) that join distinct fingerprints ``fp`` into the components of their links.

    A key with more than CHUNK fingerprints is cut into chunks by hash, and each pair of chunks is joined in a task
    of its own, so a hot key spreads over as many tasks as its pairs of chunks.
    """
    n, total = partitions(fingerprints.sparkSession), fingerprints.count()
    m = distance + 1
    while total >> round(64 * (m - distance) / m) > PER_KEY and m < 2 * distance + 2:
        m += 1
    cuts = [round(i * 64 / m) for i in range(m + 1)]
    keys = []
    for k, choice in enumerate(combinations(range(m), m - distance)):
        mask = sum(((1 << (cuts[i + 1] - cuts[i])) - 1) << cuts[i] for i in choice)
        keys.append(F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long"))))
    keyed = fingerprints.select("fp", F.explode(F.array(*keys)).alias("key"))
    hot = keyed.groupBy("key").count().filter(F.col("count") > CHUNK).select("key", F.ceil(F.col("count") / CHUNK).cast("int").alias("chunks"))
    # a key is hot from CHUNK rows on, so hot keys are few against the rows; adaptive execution chooses the join
    marked = keyed.join(hot, "key", "left")
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    others = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda o: F.least(o, own) * F.col("chunks") + F.greatest(o, own))
    spread = marked.select("fp", "key", F.explode(F.when(F.col("chunks").isNull(), F.array(F.lit(0))).otherwise(others)).alias("pair"))
    deal = F.xxhash64("key", "pair")
    rows = spread.select(deal.alias("task"), "fp").repartition(n, "task").sortWithinPartitions("task")
    return rows.mapInArrow(_local_edges(distance), "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node of ``edges`` (a, b) with the smallest node it is joined to.

    Star contraction: each round points the larger neighbours of a node at its smallest neighbour, then the
    smaller ones; minima are summed before the shuffle, so a node with very many edges is no hot spot.
    """
    edges = checkpointed(edges.distinct())
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = checkpointed(large.distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        new = checkpointed(small.select("e.a", "e.b").filter(F.col("a") > F.col("b")).distinct())
        n_old, n_new = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first(), new.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        edges = new
        if n_old == n_new:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(
    docs: DataFrame, shingle: int = 4, distance: int = 4, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = True, group_col: str | None = None
) -> DataFrame:
    """``docs`` with fingerprint (16 hex digits) and component_id, the smallest id of its component.

    Fingerprints that differ in at most ``distance`` bits are linked and links chain. Null and empty texts have the
    fingerprint zero, linked like any other. A null id takes part in links, but is no component's id unless the
    component has no other. Repeated rows stay, each with the same result. An empty table gives an empty result. Result columns
    replace input columns of the same name. Without ``keep_text`` the texts are read once and not carried along.
    ``group_col`` names a further column that tells components apart, those without any id as well.
    """
    kept = [c for c in docs.columns if c.lower() not in {"fingerprint", "component_id", (group_col or "fingerprint").lower()}]
    fp, root, least, id_, group = free_names(docs, "_fp", "_root", "_least", "_id", "_group")
    marked = with_fingerprints(docs.select(*kept, F.col(id_col).alias(id_)), fp, text_col, shingle)
    if keep_text:
        ids = checkpointed(marked.select(fp, id_))
    else:
        kept.remove(text_col)
        ids = marked = checkpointed(marked.select(*kept, fp, id_))
    distinct = checkpointed(ids.groupBy(F.col(fp).alias("fp")).agg(F.min(id_).alias("id")))
    roots = components(near_edges(distinct.select("fp"), distance))
    placed = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "id", F.coalesce("root", "fp").alias("root"))
    smallest = placed.groupBy("root").agg(F.min("id").alias("least"))
    members = placed.select("fp", "root").join(smallest, "root").select(F.col("fp").alias(root), F.col("least").alias(least), F.col("root").alias(group))
    out = marked.join(checkpointed(members), F.col(fp) == F.col(root))
    more = [F.col(group).alias(group_col)] if group_col else []
    return out.select(*kept, F.lower(F.lpad(F.hex(fp), 16, "0")).alias("fingerprint"), F.col(least).alias("component_id"), *more)


def op1(spark, sf_dir) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return near_duplicates(docs, keep_text=False).select("doc_id", "fingerprint", "component_id")
