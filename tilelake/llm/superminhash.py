"""Near-duplicates by SuperMinHash signatures, banding, verification on whole sets and union-find.

Each shingle of a text draws a random permutation of the registers step by step: at step j it swaps a later register to place j and offers it
j + a random fraction. A register keeps its least offer. Steps are taken by all shingles of a text together, and a text stops when every
register holds less than the next step could offer: after about registers x ln(registers) / shingles steps. The permutations correlate the registers of
one text, which makes the share of equal registers a better estimate than independent minima.

Texts are made distinct by a digest of their lower-cased text. Registers are cut into bands; texts that agree in a band share a
bucket. In each bucket all texts are compared with one centre, on their whole sets; the links are joined into components. Buckets
in which texts other than the centre still lie in different components are compared in full, those that share most of their texts
as one, in tasks that hold one pair of bounded chunks and give back a spanning forest of the new links. So every pair of a bucket is either joined by links or has been
compared, and no pair list of a group is ever written.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilelake.llm.common import column, documents, free_names, lower_ascii, partitions, words_of
from tilelake.llm.simhash import components
from tilelake.operators.skew import salted_join
from tilelake.runtime import checkpointed

#: Bands of so many registers: at a similarity of 0.8 two texts agree in none with a probability of 1.2e-7.
BANDS, BAND_ROWS = 40, 5
#: Shingles drawn at a time, and words a task remembers the hash of.
AT_ONCE, KEPT_WORDS = 1 << 15, 1 << 20
#: Texts compared with one copy of a centre; texts and shingles of a chunk of a bucket; columns of a product at a time.
PER_CENTRE, CHUNK, CHUNK_SHINGLES, COLUMNS = 256, 512, 1 << 20, 4096
#: Digests that may be broadcast to pick the texts that are needed; beyond it they are joined.
BROADCAST_ROWS = 1_000_000
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finishing steps of the splitmix64 generator (fixed constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signatures(elements: np.ndarray, owner: np.ndarray, texts: int, registers: int) -> np.ndarray:
    """One row of registers for each text; ``elements`` are hashes of the distinct shingles of text ``owner``, in its order.

    A register holds step * 2^32 + a 32-bit fraction; all ones without any shingle.
    """
    out = np.full(texts * registers, _FULL)
    steps = np.arange(1, registers + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for first in range(0, len(elements), AT_ONCE):
        x, own = elements[first : first + AT_ONCE], owner[first : first + AT_ONCE].astype(np.int64)
        at = np.broadcast_to(np.arange(registers, dtype=np.uint16), (len(x), registers)).copy()
        for j in range(registers):
            # only texts with a register that this step or a later one could still lower go on
            unfinished = (out.reshape(texts, registers) >> np.uint64(32)).max(axis=1) >= j
            alive = unfinished[own]
            if not alive.all():
                x, own, at = x[alive], own[alive], at[alive]
            if not len(x):
                break
            drawn = _mixed(x + steps[j])
            k = j + ((drawn & np.uint64(0xFFFFFFFF)) * np.uint64(registers - j) >> np.uint64(32)).astype(np.int64)
            row = np.arange(len(x))
            chosen = at[row, k].astype(np.int64)
            at[row, k] = at[:, j]
            np.minimum.at(out, own * registers + chosen, np.uint64(j << 32) | (drawn >> np.uint64(32)))
    return out.reshape(texts, registers)


def band_keys(registers: np.ndarray, bands: int) -> np.ndarray:
    """A 64-bit key for each band of each row, different from band to band."""
    cut = registers.reshape(len(registers), bands, -1)
    key = np.broadcast_to(_mixed(np.arange(1, bands + 1, dtype=np.uint64)), cut.shape[:2]).copy()
    for i in range(cut.shape[2]):
        key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + cut[:, :, i])
    return key.view(np.int64)


class _Shingles:
    """Distinct shingles of texts as hashes of the words' hashes; words are told apart exactly while they are counted."""

    def __init__(self, shingle: int):
        self.shingle = shingle
        self.numbers: dict[bytes, int] = {}
        self.hashes = np.zeros(0, np.uint64)

    def of(self, texts: list) -> list[np.ndarray]:
        """The hashes of each text's distinct shingles."""
        if len(self.numbers) > KEPT_WORDS:
            self.numbers, self.hashes = {}, np.zeros(0, np.uint64)
        known, numbers = len(self.numbers), self.numbers
        words = [words_of(t) for t in texts]
        each = [np.fromiter((numbers.setdefault(w, len(numbers)) for w in ws), np.int64, len(ws)) for ws in words]
        if len(numbers) > known:
            if len(numbers) > len(self.hashes):
                self.hashes = np.concatenate([self.hashes, np.zeros(len(numbers), np.uint64)])
            for ws, ids in zip(words, each):
                new, first = np.unique(ids, return_index=True)
                first = first[new >= known]
                self.hashes[ids[first]] = np.fromiter((xxhash.xxh64_intdigest(ws[i], 11) for i in first), np.uint64, len(first))
        return [self._distinct(x) for x in each]

    def _distinct(self, words: np.ndarray) -> np.ndarray:
        if not len(words):
            return np.zeros(0, np.uint64)
        size = min(self.shingle, len(words))
        code = words[: len(words) - size + 1]
        for i in range(1, size):
            if i > 1:  # two numbers fit one code exactly; more are renumbered first
                code = np.unique(code, return_inverse=True)[1]
            code = code << 31 | words[i : len(words) - size + 1 + i]
        first = np.unique(code, return_index=True)[1]
        key = np.full(len(first), np.uint64(size))
        for i in range(size):
            key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + self.hashes[words[first + i]])
        return key


def _signed(shingle: int, bands: int, band_rows: int, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = _Shingles(shingle)
        for batch in batches:
            kept = [c for c in batch.schema.names if c != text]
            texts, at = batch.column(text), 0
            lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False)
            while at < batch.num_rows:
                stop, n = at, 0
                while stop < batch.num_rows and n < 6 * AT_ONCE:
                    n += lengths[stop]
                    stop += 1
                found = shingles.of(texts.slice(at, stop - at).to_pylist())
                sizes = np.array([len(f) for f in found], np.int64)
                registers = signatures(np.concatenate(found), np.repeat(np.arange(len(found)), sizes), len(found), bands * band_rows)
                keys = band_keys(registers, bands)[sizes > 0]
                ends = np.cumsum(np.r_[0, np.where(sizes > 0, bands, 0)])
                part = batch.slice(at, stop - at)
                columns = [part.column(c) for c in kept]
                columns += [pa.array(sizes), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys.ravel()))]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, "_size", "_bands"])
                at = stop

    return run


def _codes(words: list[bytes], numbers: dict[bytes, int], shingle: int, learn: bool) -> np.ndarray:
    """Distinct shingles as exact numbers; words that ``numbers`` lacks are learnt, or their shingles left out."""
    size = min(shingle, len(words))
    if not size:
        return np.zeros(0, np.int64)
    if shingle > 2:
        words, size = [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)], 1
    if learn:
        ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    else:
        ids = np.fromiter((numbers.get(w, -1) for w in words), np.int64, len(words))
    if size == 2:
        known = (ids[:-1] >= 0) & (ids[1:] >= 0)
        return np.unique((ids[:-1] << 31 | ids[1:])[known])
    # in a set of pairs, a single word is told apart from every pair
    return np.unique(-1 - ids[ids >= 0])


_EDGES = "a binary, b binary"


def _edges(pairs: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([max(p) for p in pairs], pa.binary()), pa.array([min(p) for p in pairs], pa.binary())], names=["a", "b"])


def _like_centre(shingle: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by (centre, part), the centre's own text first."""
        key, numbers, base = None, {}, None
        for batch in batches:
            out = []
            for centre, part, member, text, digest, size in zip(*(batch.column(c).to_pylist() for c in ("centre", "part", "is_member", "text", "digest", "size"))):
                if not member:
                    key, numbers = (centre, part), {}
                    base = _codes(words_of(text), numbers, shingle, True)
                    continue
                assert key == (centre, part), "a centre's text is missing"
                own = _codes(words_of(text), numbers, shingle, False)
                both = int(np.isin(own, base, assume_unique=True).sum())
                if 100 * both >= percent * (len(base) + size - both):
                    out.append((centre, digest))
            if out:
                yield _edges(out)

    return run


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every left with every right set, by products of columns of shingles."""
    a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
    common = np.intersect1d(a, b)
    out = np.zeros((len(left), len(right)), np.float64)
    rows = [np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (left, right)]
    picked = []
    for values, row in zip((a, b), rows):
        place = np.searchsorted(common, values)
        found = (place < len(common)) & (common[np.minimum(place, max(len(common) - 1, 0))] == values) if len(common) else np.zeros(len(values), bool)
        order = np.argsort(place[found], kind="stable")
        picked.append((place[found][order], row[found][order]))
    for first in range(0, len(common), COLUMNS):
        tile = []
        for (place, row), n in zip(picked, (len(left), len(right))):
            s, e = np.searchsorted(place, [first, first + COLUMNS])
            matrix = np.zeros((n, min(COLUMNS, len(common) - first)), np.float32)
            matrix[row[s:e], place[s:e] - first] = 1
            tile.append(matrix)
        out += tile[0] @ tile[1].T
    return np.rint(out).astype(np.int64)


def _compared(shingle: int, percent: int):
    def links(rows: list[tuple]) -> list[tuple[bytes, bytes]]:
        """A spanning forest of the links between the sides of one task, beyond the components they are in."""
        numbers: dict[bytes, int] = {}
        sides = [[r for r in rows if r[0]], [r for r in rows if not r[0]]]
        if not sides[1]:
            sides[1] = sides[0]
        sets = [[_codes(words_of(r[1]), numbers, shingle, True) for r in side] for side in sides]
        both = _shared(*sets)
        sizes = [np.array([len(s) for s in side]) for side in sets]
        near = 100 * both >= percent * (sizes[0][:, None] + sizes[1][None, :] - both)
        up: dict[bytes, bytes] = {}

        def root(x: bytes) -> bytes:
            while (y := up.setdefault(x, x)) != x:
                up[x] = up[y] if y in up else y
                x = y
            return x

        out = []
        for i, j in zip(*np.nonzero(near)):
            a, b = root(sides[0][i][3]), root(sides[1][j][3])
            if a != b:
                up[max(a, b)] = min(a, b)
                out.append((sides[0][i][2], sides[1][j][2]))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            out = []
            for k, chunk, *row in zip(*(batch.column(c).to_pylist() for c in ("key", "pair", "first", "text", "digest", "root"))):
                if (k, chunk) != key:
                    out += links(held) if held else []
                    key, held = (k, chunk), []
                held.append(tuple(row))
            if out:
                yield _edges(out)
        if held and (out := links(held)):
            yield _edges(out)

    return run


def _texts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(digest, text) of the ``wanted`` digests, once each. Few digests are broadcast, so that other texts stay where they are."""
    wanted = checkpointed(wanted.select("digest").distinct())
    wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted
    return rows.join(wanted, "digest", "left_semi").groupBy("digest").agg(F.min("text").alias("text"))


def similar_edges(rows: DataFrame, sets: DataFrame, shingle: int = 2, percent: int = 80) -> DataFrame:
    """Edges (a > b) between digests that join distinct texts into the components of their links.

    ``rows`` has digest and text of every row, ``sets`` digest, size and bands of each distinct text.
    """
    n = partitions(rows.sparkSession)
    buckets = sets.select("digest", "size", F.explode("bands").alias("key"))
    # of texts of like size only: the smaller set must have at least ``percent`` of the larger one's size
    centres = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("texts"), F.min(F.struct("digest", "size")).alias("centre"))
    shared = checkpointed(buckets.join(centres.filter(F.col("texts") > 1), "key").filter(F.col("digest") != F.col("centre.digest")))
    fits = 100 * F.least("size", "centre.size") >= percent * F.greatest("size", "centre.size")
    pairs = checkpointed(shared.filter(fits).select(F.col("centre.digest").alias("centre"), "digest", "size").distinct())
    parts = pairs.groupBy("centre").agg(F.ceil(F.count(F.lit(1)) / PER_CENTRE).cast("int").alias("parts"))
    parts = checkpointed(parts)
    many = parts.filter(F.col("parts") > 1)
    spread = pairs.join(many, "centre", "left")
    members = spread.select("centre", F.coalesce(F.pmod(F.xxhash64("digest"), F.col("parts")), F.lit(0)).cast("int").alias("part"), F.lit(True).alias("is_member"), "digest", "size")
    own = parts.select("centre", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    routes = members.unionByName(own.select("centre", "part", F.lit(False).alias("is_member"), F.col("centre").alias("digest"), F.lit(0).cast("long").alias("size")))
    routed = _texts(rows, routes).join(routes, "digest").repartition(n, "centre", "part").sortWithinPartitions("centre", "part", "is_member")
    edges = checkpointed(routed.mapInArrow(_like_centre(shingle, percent), _EDGES).distinct())

    # pairs without the centre: open where they lie in different components
    roots = components(edges)
    placed = shared.filter(F.col("texts") > 2).join(roots, F.col("digest") == F.col("node"), "left")
    placed = checkpointed(placed.select("key", "digest", "size", F.coalesce("root", "digest").alias("root")))
    inside = placed.groupBy("key").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("members"), F.sum("size").alias("shingles"),
        F.sum(F.xxhash64("digest").cast("decimal(20,0)")).alias("same"),
    )
    # bands often hold the same texts: one of them is enough
    again = inside.filter(F.col("low") != F.col("high")).groupBy("members", "shingles", "same").agg(F.min("key").alias("key"))
    left = checkpointed(placed.join(again.select("key", "members"), "key"))
    # and much the same: a bucket joins the largest one that half of its texts are in, and their union is compared once
    best = left.groupBy("digest").agg(F.max(F.struct("members", "key")).alias("best"))
    chosen = checkpointed(left.join(best, "digest").select("key", "digest", "size", "root", F.col("best").alias("best")))
    leaders = chosen.groupBy("key").agg(F.max("best").alias("leader"))
    agreed = chosen.join(leaders, "key").groupBy("key").agg(
        F.first("leader.key").alias("leader"), F.count(F.lit(1)).alias("n"), F.count_if(F.col("best") == F.col("leader")).alias("same")
    )
    group = F.when(2 * F.col("same") >= F.col("n"), F.col("leader")).otherwise(F.col("key"))
    left = checkpointed(chosen.join(agreed.select("key", group.alias("group")), "key").select(F.col("group").alias("key"), "digest", "size", "root").distinct())
    sizes = left.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.sum("size").alias("shingles"))
    chunks = F.ceil(F.greatest(F.col("members") / CHUNK, F.col("shingles") / CHUNK_SHINGLES)).cast("int")
    left = left.join(sizes.select("key", chunks.alias("chunks")), "key")
    mine = F.pmod(F.xxhash64("digest"), F.col("chunks")).cast("int")
    left = checkpointed(left.select("key", "digest", "root", "chunks", mine.alias("chunk")))
    others = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda o: F.least(o, F.col("chunk")) * F.col("chunks") + F.greatest(o, F.col("chunk")))
    tasks = left.select("key", "digest", "root", "chunk", "chunks", F.explode(others).alias("pair"))
    tasks = tasks.select("key", "pair", "digest", "root", (F.col("chunk") == F.floor(F.col("pair") / F.col("chunks"))).alias("first"))
    dealt = _texts(rows, left).join(tasks, "digest").repartition(n, "key", "pair").sortWithinPartitions("key", "pair", "digest")
    return edges.unionByName(dealt.mapInArrow(_compared(shingle, percent), _EDGES)).distinct()


def near_duplicates(
    docs: DataFrame, shingle: int = 2, percent: int = 80, bands: int = BANDS, band_rows: int = BAND_ROWS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` without their text, with n_shingles, component_id (the smallest id of its component) and kept.

    A text's set are its distinct shingles of ``shingle`` lower-cased words (a shorter text is one shingle). Texts whose
    sets' intersection is at least ``percent`` hundredths of their union are linked, checked on the whole sets, and links chain. A text without words (also
    null or empty) is linked with nothing and is its own component. A null id takes part in links, but is no component's id
    unless the component has no other; ``kept`` says whether the row's id is its component's. Repeated rows stay, each with the same
    result. Columns named as a result are replaced; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    kept = [f for f in docs.schema.fields if f.name.lower() not in {"n_shingles", "component_id", "kept", text_col.lower()}]
    plain = free_names(docs, *(f"_c{i}" for i in range(len(kept))))
    text = F.coalesce(column(text_col).cast("string"), F.lit(""))
    digest = F.unhex(F.md5(lower_ascii(text).cast("binary")))
    rows = docs.select(digest.alias("digest"), text.alias("text"))
    columns = [T.StructField(a, f.dataType) for f, a in zip(kept, plain)] + [T.StructField("_id", docs.schema[id_col].dataType), T.StructField("_digest", T.BinaryType())]
    given = docs.select(*(column(f.name).alias(a) for f, a in zip(kept, plain)), column(id_col).alias("_id"), digest.alias("_digest"), text.alias("_text"))
    marked = T.StructType([*columns, T.StructField("_size", T.LongType()), T.StructField("_bands", T.ArrayType(T.LongType()))])
    signed = checkpointed(given.mapInArrow(_signed(shingle, bands, band_rows, "_text"), marked))
    filled = signed.filter(F.col("_size") > 0)
    least = filled.groupBy("_digest").agg(F.min("_id").alias("id"))
    sets = filled.select(F.col("_digest").alias("digest"), F.col("_size").alias("size"), F.col("_bands").alias("bands")).dropDuplicates(["digest"])
    edges = similar_edges(rows, checkpointed(sets), shingle, percent)
    roots = components(edges)
    placed = checkpointed(least.join(roots, F.col("_digest") == F.col("node"), "left").select("_digest", "id", F.coalesce("root", "_digest").alias("root")))
    by_root = checkpointed(placed.groupBy("root").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("rows")))
    # only components of several texts need their smallest id; a giant one is dealt over several tasks
    joined = by_root.filter(F.col("rows") > 1)
    members = salted_join(placed, joined.select("root", "least"), ["root"], joined.select("root", "rows"))
    members = checkpointed(members.select("_digest", F.when(F.col("least").isNotNull(), F.col("least")).otherwise(F.col("id")).alias("_least")))
    copies = checkpointed(filled.groupBy("_digest").agg(F.count(F.lit(1)).alias("rows")))
    found = salted_join(signed.drop("_bands"), members, ["_digest"], copies)
    component = F.when(F.col("_size") > 0, F.col("_least")).otherwise(F.col("_id"))
    return found.select(
        *(F.col(a).alias(f.name) for f, a in zip(kept, plain)), F.col("_size").alias("n_shingles"),
        component.alias("component_id"), F.col("_id").eqNullSafe(component).alias("kept"),
    )


def op13(spark, sf_dir) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir).select("doc_id", "text"))


#: The same in DuckDB: every pair of texts that share a shingle, counted, and their links followed to the smallest id.
SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
),
d AS (
  SELECT doc_id, CASE WHEN len(ws) < 2 THEN ws ELSE list_distinct([ws[i] || ' ' || ws[i + 1] FOR i IN range(1, len(ws))]) END AS shingles FROM w
),
g AS MATERIALIZED (SELECT shingles, list_sort(shingles) AS k, len(shingles) AS n, min(doc_id) AS rep FROM d WHERE len(shingles) > 0 GROUP BY ALL),
s AS MATERIALIZED (SELECT rep, n, unnest(shingles) AS x FROM (SELECT k AS shingles, n, min(rep) AS rep FROM g GROUP BY k, n)),
c AS MATERIALIZED (SELECT x, count(*) AS df FROM s GROUP BY x),
o AS MATERIALIZED (
  SELECT rep, n, x, row_number() OVER (PARTITION BY rep ORDER BY df, x) AS place FROM s JOIN c USING (x)
),
-- two sets that share 0.8 of their union share one of the rarest fifth of their shingles
p AS MATERIALIZED (SELECT rep, n, x FROM o WHERE place <= n - (80 * n + 99) // 100 + 1),
q AS MATERIALIZED (
  SELECT DISTINCT a.rep AS a, b.rep AS b, a.n AS an, b.n AS bn FROM p AS a JOIN p AS b ON a.x = b.x AND a.rep < b.rep
  WHERE 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
),
l AS MATERIALIZED (
  SELECT q.a, q.b FROM q JOIN s AS y ON y.rep = q.a JOIN s AS z ON z.rep = q.b AND z.x = y.x
  GROUP BY q.a, q.b, q.an, q.bn HAVING 100 * count(*) >= 80 * (q.an + q.bn - count(*))
),
e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT rep AS a, rep AS b FROM s GROUP BY rep UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
m AS (SELECT a, min(b) AS least FROM r GROUP BY a),
u AS (SELECT k, min(rep) AS rep FROM g GROUP BY k)
SELECT d.doc_id, len(d.shingles)::BIGINT AS n_shingles, coalesce(m.least, d.doc_id) AS component_id, d.doc_id = coalesce(m.least, d.doc_id) AS kept
FROM d LEFT JOIN u ON len(d.shingles) > 0 AND u.k = list_sort(d.shingles) LEFT JOIN m ON m.a = u.rep
"""
