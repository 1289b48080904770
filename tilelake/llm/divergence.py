"""How far the term distributions of a language's sources lie from each other and from the language.

Texts become term counts inside Arrow: ``ascii_lower``, ``split_pattern_regex``, ``dictionary_encode`` and a hash ``group_by``
give each task's counts by language, source and term. They meet by (language, term), where rare terms go. The kept counts
are dealt in columnar shards by (language, hash of the term), each with one row for every source of its language;
a shard is a matrix of terms by sources, from which every pair of sources gets its part of the sum and every source its best
terms. Sources beyond BLOCK a language are cut into blocks and each pair of blocks is a shard of its own, so no task holds
more than BLOCK x BLOCK sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tilelake.llm.common import column, documents, partitions
from tilelake.runtime import checkpointed

#: What separates terms: everything of ASCII but its letters.
BREAK = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes of text counted at a time, count rows a task gathers before it merges them, and matrix cells at a time.
SLICE_BYTES, GATHERED, CELLS = 8 << 20, 400_000, 1 << 21
#: Sources of one language in a block, and kept counts wanted in a shard: each shard gives a row for every pair of sources.
BLOCK, SHARD_ROWS = 512, 16_384

_COUNTED = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """``batch`` in pieces of about SLICE_BYTES of text; one text is never cut."""
    ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + SLICE_BYTES, side="right")))
        yield batch.slice(at, stop - at)
        at = stop


def _counted(part: pa.RecordBatch) -> pa.Table:
    """Occurrences and documents of each (lang, source, term) of some rows."""
    split = pc.split_pattern_regex(pc.ascii_lower(part.column("text")), pattern=BREAK)
    found = pa.table({"row": pc.list_parent_indices(split), "term": pc.list_flatten(split)})
    found = found.filter(pc.not_equal(found["term"], ""))
    terms = found["term"].combine_chunks().dictionary_encode()
    by_row = pa.table({"row": found["row"], "code": terms.indices}).group_by(["row", "code"]).aggregate([([], "count_all")])
    groups: dict[tuple, int] = {}
    own = [groups.setdefault(g, len(groups)) for g in zip(part.column("lang").to_pylist(), part.column("source").to_pylist())]
    by_row = by_row.append_column("group", pa.array(own, pa.int64()).take(by_row["row"].combine_chunks()))
    summed = by_row.group_by(["group", "code"]).aggregate([("count_all", "sum"), ("count_all", "count")])
    langs, sources = (pa.array([g[i] for g in groups], pa.string()) for i in (0, 1))
    return pa.table(
        [
            langs.take(summed["group"].combine_chunks()),
            sources.take(summed["group"].combine_chunks()),
            terms.dictionary.take(summed["code"].combine_chunks()),
            summed["count_all_sum"],
            summed["count_all_count"],
        ],
        schema=_COUNTED,
    )


def _merged(tables: list[pa.Table]) -> pa.Table:
    summed = pa.concat_tables(tables).group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
    return summed.rename_columns(_COUNTED.names).select(_COUNTED.names).cast(_COUNTED)


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's rows, merged as they come; what stays large after a merge is handed on."""
    held, n = [], 0
    for batch in batches:
        for part in _slices(batch):
            held.append(_counted(part))
            n += held[-1].num_rows
            if n > GATHERED:
                held = [_merged(held)]
                n = held[0].num_rows
                if n > GATHERED // 2:
                    yield from held[0].to_batches(max_chunksize=50_000)
                    held, n = [], 0
    if held:
        yield from _merged(held).to_batches(max_chunksize=50_000)


def _share(count: np.ndarray, total: np.ndarray, smooth: int) -> np.ndarray:
    """1 + floor(10^9 * count / total) for 0 <= count <= total, by long division, so that no step leaves 64 bits."""
    if total.size and int(total.max()) > (2**63 - 1) // 1000:
        raise OverflowError("more than 9.2 * 10^15 terms in one language")
    quotient, rest = np.zeros(np.broadcast(count, total).shape, np.int64), count
    for _ in range(3):
        rest = rest * 1000
        quotient = quotient * 1000 + rest // total
        rest = rest % total
    return quotient + 1


class _Shard:
    """The sums and best terms of one (lang, shard, tile)."""

    def __init__(self, rows: dict, tile: tuple, first: bool, smooth: int, top: int):
        self.smooth, self.top, self.diagonal = smooth, top, tile[0] == tile[1]
        order = sorted(range(len(rows["source"])), key=lambda i: rows["block"][i] != tile[0])
        self.names = [rows["source"][i] for i in order]
        self.place = {s: i for i, s in enumerate(self.names)}
        self.left = sum(b == tile[0] for b in rows["block"])
        added = smooth * rows["vocabulary"][0]
        self.totals = np.array([rows["total"][i] for i in order], np.int64) + added
        self.whole = np.array([rows["lang_total"][0] + added], np.int64)
        self.best = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, object)]
        # a term that no source of the tile has does not come here: the language's first shard counts all
        # terms as unseen, and each shard puts the terms it sees in their place
        self.unseen = _share(np.full(len(self.names), smooth), self.totals, smooth) if added else np.zeros(len(self.names), np.int64)
        right = self.unseen if self.diagonal else self.unseen[self.left :]
        self.apart = np.abs(self.unseen[: self.left, None] - right[None, :])
        self.sums = self.apart * (rows["vocabulary"][0] if first else 0)

    def add(self, terms: list, sources: list, counts: list, in_lang: list) -> None:
        """Rows of some whole terms, in order of the term."""
        names = np.array(terms, object)
        heads = np.r_[True, names[1:] != names[:-1]]
        code = np.cumsum(heads) - 1
        col = np.fromiter(map(self.place.__getitem__, sources), np.int64, len(sources))
        own = _share(np.array(counts, np.int64) + self.smooth, self.totals[col], self.smooth)
        self.sums -= self.apart * (int(code[-1]) + 1)
        step = max(1, CELLS // len(self.names))
        for first in range(0, int(code[-1]) + 1, step):
            a, b = np.searchsorted(code, [first, first + step])
            shares = np.repeat(self.unseen[:, None], code[b - 1] - first + 1, axis=1)
            shares[col[a:b], code[a:b] - first] = own[a:b]
            right = shares if self.diagonal else shares[self.left :]
            for i in range(self.left):
                self.sums[i] += np.abs(right - shares[i]).sum(axis=1)
        if self.diagonal:
            above = own - _share(np.array(in_lang, np.int64) + self.smooth, self.whole, self.smooth)
            some = np.flatnonzero(above > 0)
            col, value, names = (np.concatenate(x) for x in zip(self.best, (col[some], above[some], names[some])))
            order = np.lexsort((np.arange(len(col)), -value, col))  # of equal values the term that came first is the smaller
            col, value, names = col[order], value[order], names[order]
            heads = np.flatnonzero(np.r_[True, col[1:] != col[:-1]]) if len(col) else np.zeros(0, np.int64)
            rank = np.arange(len(col)) - np.repeat(heads, np.diff(np.r_[heads, len(col)]))
            keep = rank < self.top
            # back to the order of terms, so that later ties still go to the smaller one
            col, value, names, order = col[keep], value[keep], names[keep], order[keep]
            again = np.argsort(order, kind="stable")
            self.best = [col[again], value[again], names[again]]

    def rows(self) -> Iterator[tuple]:
        right = self.names if self.diagonal else self.names[self.left :]
        for i in range(self.left):
            for j, other in enumerate(right):
                if not self.diagonal:
                    yield self.names[i], "pair", other, int(self.sums[i, j])
                    yield other, "pair", self.names[i], int(self.sums[i, j])
                elif i != j:
                    yield self.names[i], "pair", other, int(self.sums[i, j])
        for col, value, name in zip(*self.best):
            yield self.names[col], "term", name, int(value)


_FOUND = "lang string, source string, part string, item string, value long"
_COLUMNS = ["lang", "shard", "tile", "is_term", "source", "block", "term", "n", "lang_n", "total", "lang_total", "vocabulary"]


def _divergences(blocks: int, smooth: int, top: int):
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())])

    def batches_of(lang: str, shard: _Shard) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for row in shard.rows():
            out.append((lang, *row))
            if len(out) == 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Shards come one after another, each with its sources first and then its terms in order."""
        key, shard, heads, terms = None, None, None, None

        def filled(upto_end: bool) -> None:
            nonlocal terms
            if not terms["term"]:
                return
            last, cut = terms["term"][-1], len(terms["term"])
            while not upto_end and cut and terms["term"][cut - 1] == last:
                cut -= 1
            if cut:
                shard.add(*(terms[c][:cut] for c in ("term", "source", "n", "lang_n")))
                terms = {c: v[cut:] for c, v in terms.items()}

        def opened() -> None:
            nonlocal shard
            if shard is None:
                shard = _Shard(heads, divmod(key[2], blocks), key[1] == 0, smooth, top)

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = {c: batch.column(c).to_pylist() for c in _COLUMNS}
            keys = list(zip(rows["lang"], rows["shard"], rows["tile"]))
            at = 0
            while at < len(keys):
                if keys[at] != key:
                    if key is not None:
                        opened()
                        filled(True)
                        yield from batches_of(key[0], shard)
                    key, shard = keys[at], None
                    heads, terms = {c: [] for c in _COLUMNS}, {c: [] for c in ("term", "source", "n", "lang_n")}
                stop = at
                while stop < len(keys) and keys[stop] == key and rows["is_term"][stop] == rows["is_term"][at]:
                    stop += 1
                if rows["is_term"][at]:
                    opened()
                    for c in terms:
                        terms[c] += rows[c][at:stop]
                    if len(terms["term"]) >= GATHERED:
                        filled(False)
                else:
                    for c in heads:
                        heads[c] += rows[c][at:stop]
                at = stop
        if key is not None:
            opened()
            filled(True)
            yield from batches_of(key[0], shard)

    return run


def divergences(
    docs: DataFrame,
    min_docs: int = 30,
    smooth: int = 5,
    top: int = 50,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """lang, source, part, item, value, rank: how far each source of a language lies from the others, and its own terms.

    A language keeps the terms that stand in at least ``min_docs`` of its rows. With V kept terms and N occurrences of them, a term
    of a source or language has the share p = 1 + floor(10^9 (count + ``smooth``) / (N + ``smooth`` V)), in exact integers.
    Part ``pair`` has for every other source of the language the sum of |p - q| over all kept terms (0 without any);
    part ``term`` the ``top`` terms that stand in the source with a larger share than in the language, and by how much. Ranks
    go from the largest value down, ties to the smaller item by its UTF-8.

    A null text, language or source counts as ''. Every row is a document, repeated rows too; other columns are not read. A language
    of one source has no pairs; an empty table gives an empty result. The result has a row for each pair of sources of a language,
    so its size follows the square of their number.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    texts = docs.select(*(F.coalesce(column(c).cast("string"), F.lit("")).alias(a) for c, a in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))))
    counted = texts.mapInArrow(_partial_counts, "lang string, source string, term string, n long, docs long")
    # dealt once by (lang, term): the sums by source and the language's own sums need no other shuffle
    merged = counted.repartition(n, "lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_lang = Window.partitionBy("lang", "term")
    whole = merged.select(
        "lang", "term", "source", "n", F.sum("n").over(of_lang).alias("lang_n"), F.sum("docs").over(of_lang).alias("lang_docs"),
        (F.min("source").over(of_lang) == F.col("source")).cast("long").alias("leads"),
    )
    kept = checkpointed(whole.filter(F.col("lang_docs") >= min_docs).drop("lang_docs"))
    langs = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.sum("leads").alias("vocabulary"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = texts.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = checkpointed(groups.fillna(0, ["total", "lang_total", "vocabulary"]))
    most = groups.groupBy("lang").count().agg(F.max("count")).first()[0]
    blocks = max(1, -(-(most or 1) // BLOCK))
    # block b of a source is needed by every tile (i, j), i <= j, of which it is a side
    block = F.pmod(F.xxhash64("source"), F.lit(blocks)).cast("int")
    tiles = F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda o: F.least(o, F.col("block")) * blocks + F.greatest(o, F.col("block")))
    shards_of_lang = max(1, -(-kept.count() // SHARD_ROWS))
    shard = F.pmod(F.xxhash64("term"), F.lit(shards_of_lang)).cast("int")
    none = lambda t: F.lit(None).cast(t)
    terms = kept.select(
        "lang", shard.alias("shard"), F.lit(True).alias("is_term"), "source", block.alias("block"), "term", "n", "lang_n",
        none("long").alias("total"), none("long").alias("lang_total"), none("long").alias("vocabulary"),
    )
    # every shard that has terms, and one of each language that has none, gets a row for each source
    shards = terms.select("lang", "shard").unionByName(groups.select("lang", F.lit(0).alias("shard"))).distinct()
    heads = shards.join(groups, "lang").select(
        "lang", "shard", F.lit(False).alias("is_term"), "source", block.alias("block"), none("string").alias("term"),
        none("long").alias("n"), none("long").alias("lang_n"), "total", "lang_total", "vocabulary",
    )
    dealt = terms.unionByName(heads).withColumn("tile", F.explode(tiles)).select(*_COLUMNS)
    dealt = dealt.repartition(n, "lang", "shard", "tile").sortWithinPartitions("lang", "shard", "tile", "is_term", "term")
    found = dealt.mapInArrow(_divergences(blocks, smooth, top), _FOUND)
    summed = found.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    best = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = summed.withColumn("rank", F.row_number().over(best))
    return ranked.filter((F.col("part") == "pair") | (F.col("rank") <= top))


def op11(spark, sf_dir) -> DataFrame:
    return divergences(documents(spark, sf_dir))


#: The same in DuckDB: every source's share of every kept term, compared in pairs.
SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
),
t AS (SELECT rid, lang, source, unnest(terms) AS term FROM d),
k AS (SELECT lang, term, count(*) AS lang_n FROM t GROUP BY lang, term HAVING count(DISTINCT rid) >= 30),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL),
l AS (SELECT lang, sum(lang_n) AS lang_total, count(*) AS v FROM k GROUP BY lang),
g AS (
  SELECT lang, source, coalesce(sum(n), 0) AS total FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source)
  GROUP BY lang, source
),
s AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (total + 5 * v) AS p,
    1 + (1000000000::HUGEINT * (lang_n + 5)) // (lang_total + 5 * v) AS q
  FROM g JOIN k ON g.lang = k.lang JOIN l ON g.lang = l.lang
    LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
),
f AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0) AS value
  FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN s AS x ON x.lang = a.lang AND x.source = a.source
    LEFT JOIN s AS y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY a.lang, a.source, b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM s WHERE n > 0 AND p > q
),
r AS (
  SELECT lang, source, part, item, value::BIGINT AS value,
    row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM f
)
SELECT * FROM r WHERE part = 'pair' OR rank <= 50
"""
