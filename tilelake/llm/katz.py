"""Katz backoff bigram model: Good-Turing discounts and exactly normalised backoff weights.

P(w|v) = d(c) c / c(v) for a seen bigram with count c, else weight(v) P(w); weight(v) is what the discounts leave in context
v over what P leaves to words not seen after v. P(w) = d(c) c / N, and one unknown word has what is left. Counts to K
have Good-Turing discounts, larger ones keep KEEP, so that every context leaves something.

Texts are read in chunks whose bigrams, with the documents they stand in, are packed by the hash of their last word and
shuffled once: the reducer of a hash range counts bigrams and words and answers every document of every chunk there. Because a
document's score is linear in the logarithms of the discounts, answers are sums and numbers of tokens by count, so no second pass
over the bigrams is needed once the counts of counts are known. What contexts need for their weights is summed on the way,
written in tables by the hash range of the context, and looked up for the unseen bigrams only. A word with more than a share of all tokens is
spread over all ranges by its bigrams, with its count sent along.
"""

from __future__ import annotations

import pickle
from collections import defaultdict
from collections.abc import Iterator
from itertools import count
from math import log10

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from tilelake.llm.common import documents, partitions, remainder, words_of
from tilelake.runtime import new_table_path

#: Largest discounted count, what larger counts keep, tokens of a chunk.
K, KEEP, CHUNK_TOKENS = 5, 0.999, 800_000
_BEGIN, _END = b"\n<", b"\n>"  # no word holds white space
_ROWS = "kind int, key long, blob binary"
_DOCS, _CONTEXTS, _ASKED, _COUNTS, _META = range(5)


def _hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


def _pack(*values) -> bytes:
    return zstandard.compress(pickle.dumps(values, protocol=5), 1)


def _unpack(blob: bytes) -> tuple:
    return pickle.loads(zstandard.decompress(blob))


def _small(x: np.ndarray) -> np.ndarray:
    """The same whole numbers in the fewest bytes."""
    top = int(x.max(initial=0))
    return x.astype(np.uint8 if top < 256 else np.uint16 if top < 65536 else np.uint32 if top < 1 << 32 else np.uint64)


def _record(rows: list[tuple]) -> pa.RecordBatch:
    kinds, keys, blobs = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(keys, pa.int64()), pa.array(blobs, pa.binary())], names=["kind", "key", "blob"])


def discounts(counts: list[int]) -> list[float]:
    """d(1) to d(K) from the counts of counts 1 to K + 1; half a count is taken where these give none between 0 and 1."""
    n = [0, *counts]
    over = (K + 1) * n[K + 1] / n[1] if n[1] else 1.0
    out = []
    for r in range(1, K + 1):
        d = ((r + 1) * n[r + 1] / (r * n[r]) - over) / (1 - over) if n[r] and over != 1 else 0.0
        out.append(d if 0 < d < 1 else (r - 0.5) / r)
    return out


class Unigrams:
    """P of a word by its count."""

    def __init__(self, total: int, counts: list[int], larger: int):
        """``larger``: occurrences of words that occur more than K times."""
        self.total = max(1, total)
        self.d = [0.0, *discounts(counts)]
        used = sum(self.d[r] * r * counts[r - 1] for r in range(1, K + 1)) + KEEP * larger
        self.unknown = max(1e-12, 1 - used / self.total)

    def p(self, c: np.ndarray) -> np.ndarray:
        d = np.where(c > K, KEEP, np.array(self.d)[np.minimum(c, K).astype(np.int64)])
        return np.where(c > 0, d * c / self.total, self.unknown)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash, occurrences in training texts), summed over some batches."""
    counts: dict[bytes, int] = defaultdict(int)

    def out():
        h = np.fromiter(map(_hash, counts), np.uint64, len(counts)).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(h), pa.array(np.fromiter(counts.values(), np.int64, len(counts)))], names=["h", "n"])

    for batch in batches:
        for text, held in zip(batch.column(0), batch.column(1).to_pylist()):
            if not held:
                for w in words_of(text.as_py()):
                    counts[w] += 1
                counts[_END] += 1
            if len(counts) > 200_000:
                yield out()
                counts.clear()
    if counts:
        yield out()


def _chunks(parts: int, hot: dict[int, int]):
    hot_hashes = np.array(sorted(hot), np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = count(TaskContext.get().partitionId() << 32)
        ids: dict[bytes, int] = defaultdict(count().__next__)
        tokens, sizes, meta = [], [], []

        def flush() -> pa.RecordBatch:
            nonlocal ids, tokens, sizes, meta
            chunk = next(number)
            begin = ids[_BEGIN]
            hashes = np.fromiter(map(_hash, ids), np.uint64, len(ids))
            n = np.array(sizes)
            w = np.concatenate(tokens)
            doc = np.repeat(np.arange(len(n)), n)
            v = np.r_[0, w[:-1]]
            v[np.cumsum(n) - n] = begin
            bits, doc_bits = max(1, int(len(ids)).bit_length()), max(1, len(n).bit_length())
            if 2 * bits + doc_bits < 64:
                code = np.sort((w.astype(np.uint64) << np.uint64(bits + doc_bits)) | (v.astype(np.uint64) << np.uint64(doc_bits)) | doc.astype(np.uint64))
                heads = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
                code = code[heads]
                w, v, doc = ((code >> np.uint64(s)) & np.uint64((1 << b) - 1) for s, b in ((bits + doc_bits, bits), (doc_bits, bits), (0, doc_bits)))
                w, v, doc, repeats = w.astype(np.int64), v.astype(np.int64), doc.astype(np.int64), np.diff(np.r_[heads, len(tokens) and sum(n)])
            else:
                order = np.lexsort((doc, v, w))
                w, v, doc = w[order], v[order], doc[order]
                heads = np.flatnonzero(np.r_[True, (w[1:] != w[:-1]) | (v[1:] != v[:-1]) | (doc[1:] != doc[:-1])])
                w, v, doc, repeats = w[heads], v[heads], doc[heads], np.diff(np.r_[heads, len(order)])
            to = hashes % np.uint64(parts)
            is_hot = np.isin(hashes, hot_hashes)
            part = np.where(is_hot[w], (hashes[w] ^ (hashes[v] * np.uint64(0x9E3779B97F4A7C15))) % np.uint64(parts), to[w]).astype(np.int64)
            order = np.argsort(part, kind="stable")
            w, v, doc, repeats, part = w[order], v[order], doc[order], repeats[order], part[order]
            learns = np.array([not held for _, held in meta])
            rows = [(_META, chunk, _pack([i for i, _ in meta], [h for _, h in meta], n))]
            edges = np.searchsorted(part, np.arange(parts + 1))
            for p in range(parts):
                a, b = edges[p], edges[p + 1]
                if a < b:
                    ww, vv = w[a:b], v[a:b]
                    new_pair = np.r_[True, (ww[1:] != ww[:-1]) | (vv[1:] != vv[:-1])]
                    pairs = np.flatnonzero(new_pair)
                    pw = ww[pairs]
                    words = np.flatnonzero(np.r_[True, pw[1:] != pw[:-1]])
                    rows.append((_DOCS, p, _pack(
                        chunk, learns, hashes[pw[words]], _small(np.diff(np.r_[words, len(pw)])), hashes[vv[pairs]],
                        _small(np.diff(np.r_[pairs, b - a])), _small(doc[a:b]), _small(repeats[a:b]),
                    )))
            ids, tokens, sizes, meta = defaultdict(count().__next__), [], [], []
            return _record(rows)

        held_tokens = 0
        for batch in batches:
            for text, doc_id, held in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = words_of(text.as_py())
                words.append(_END)
                tokens.append(np.fromiter(map(ids.__getitem__, words), np.int64, len(words)))
                sizes.append(len(words))
                meta.append((doc_id, held))
                held_tokens += len(words)
                if held_tokens >= CHUNK_TOKENS:
                    yield flush()
                    held_tokens = 0
        if meta:
            yield flush()

    return run


def _grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, at = np.unique(keys, return_inverse=True)
    return found, at


def _counted(ranges: int, hot: dict[int, int], unigrams: Unigrams):
    hot_hashes, hot_counts = np.array(sorted(hot), np.uint64), np.array([hot[h] for h in sorted(hot)], np.int64)
    end = np.uint64(_hash(_END))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        kind, part = key[0].as_py(), key[1].as_py()
        if kind == _META:
            return table.select(["kind", "key", "blob"])
        blobs = [_unpack(b.as_py()) for b in table["blob"]]
        chunk_of, w, v, learnt, sizes = [], [], [], [], []
        for chunk, learns, words, runs, before, docs_of, doc, n in blobs:
            owner = np.repeat(np.arange(len(before)), docs_of)
            learnt.append(np.bincount(owner, weights=n * learns[doc], minlength=len(before)).astype(np.int64))
            w.append(np.repeat(words, runs))
            v.append(before)
            chunk_of.append(chunk)
            sizes.append(len(before))
        w, v, learnt = np.concatenate(w), np.concatenate(v), np.concatenate(learnt)
        pair_codes = w * np.uint64(0xD6E8FEB86659FD93) ^ (v + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xFF51AFD7ED558CCD)
        pair_codes ^= pair_codes >> np.uint64(32)
        pairs, at = _grouped(pair_codes)
        del pair_codes
        c_pair = np.bincount(at, weights=learnt, minlength=len(pairs)).astype(np.int64)
        words, w_at = _grouped(w)
        c_word = np.bincount(w_at, weights=learnt, minlength=len(words)).astype(np.int64)
        if len(hot_hashes):
            place = np.minimum(np.searchsorted(hot_hashes, words), len(hot_hashes) - 1)
            c_word = np.where(hot_hashes[place] == words, hot_counts[place], c_word)
        p_word = unigrams.p(c_word)
        first = np.full(len(pairs), -1)
        first[at[::-1]] = np.arange(len(at))[::-1]
        seen = c_pair > 0
        rows = [(_COUNTS, 0, _pack(np.bincount(c_pair[seen & (c_pair <= K + 1)], minlength=K + 2)))]
        # what contexts need: how many bigrams of each small count, the sum of the larger counts, and P of their words
        f = first[seen]
        context, cv, pw = v[f], c_pair[seen], p_word[w_at[f]]
        some, where = _grouped(context)
        fields = [np.bincount(where, weights=cv == r, minlength=len(some)) for r in range(1, K + 1)]
        fields.append(np.bincount(where, weights=np.where(cv > K, cv, 0), minlength=len(some)))
        heard = np.bincount(where, weights=pw, minlength=len(some))
        to = (some % np.uint64(ranges)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        edges = np.searchsorted(to[order], np.arange(ranges + 1))
        for q in range(ranges):
            own = order[edges[q] : edges[q + 1]]
            if len(own):
                rows.append((_CONTEXTS, q, _pack(some[own], [_small(x[own]) for x in fields], heard[own].astype(np.float32))))
        # answers to the documents of every chunk
        base_w, known_w = np.log10(c_word + 0.1), c_word > 0
        context_w = np.where(known_w & (words != end), np.log10(np.maximum(c_word, 1)), 0.0)
        c_of, log_p = c_pair[at], np.log10(p_word)
        start, asked = 0, defaultdict(list)
        for (chunk, learns, _, _, before, docs_of, doc, n), size in zip(blobs, sizes):
            owner = np.repeat(np.arange(start, start + size), docs_of)
            start += size
            wi, c = w_at[owner], c_of[owner]
            score = np.where(c > K, np.log10(KEEP * np.maximum(c, 1)), np.where(c == 0, log_p[wi], 0.0)) - context_w[wi]
            docs, d = _grouped(doc)
            total = lambda x: np.bincount(d, weights=x * n, minlength=len(docs))  # noqa: E731, B023
            rows.append((_DOCS, chunk, _pack(
                _small(docs), total(base_w[wi]), total(score), _small(total(known_w[wi])), [_small(total(c == r)) for r in range(1, K + 1)]
            )))
            missing = np.flatnonzero(c == 0)
            if len(missing):
                m_v, m_doc, m_n = v[owner[missing]], doc[missing], n[missing]
                to = (m_v % np.uint64(ranges)).astype(np.int64)
                order = np.argsort(to, kind="stable")
                edges = np.searchsorted(to[order], np.arange(ranges + 1))
                for q in np.flatnonzero(np.diff(edges)):
                    own = order[edges[q] : edges[q + 1]]
                    asked[int(q)].append((chunk, m_v[own], m_doc[own], m_n[own]))
        rows += [(_ASKED, q, _pack(x)) for q, x in asked.items()]
        return pa.Table.from_batches([_record(rows)])

    return run


def _weights(d: list[float]):
    d = np.array(d)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        kinds = table["kind"].to_pylist()
        contexts = [_unpack(b.as_py()) for k, b in zip(kinds, table["blob"]) if k == _CONTEXTS]
        asked = [x for k, b in zip(kinds, table["blob"]) if k == _ASKED for x in _unpack(b.as_py())[0]]
        rows = []
        if contexts and asked:
            v, at = _grouped(np.concatenate([c[0] for c in contexts]))
            total = lambda x: np.bincount(at, weights=x, minlength=len(v))
            small = [total(np.concatenate([c[1][r] for c in contexts])) for r in range(K)]
            larger = total(np.concatenate([c[1][K] for c in contexts]))
            heard = total(np.concatenate([c[2] for c in contexts]).astype(np.float64))
            left = sum(small[r - 1] * r * (1 - d[r - 1]) for r in range(1, K + 1)) + larger * (1 - KEEP)
            weight = np.log10(left / np.maximum(1 - heard, 1e-9))
            by_chunk = defaultdict(list)
            for chunk, av, doc, n in asked:
                place = np.minimum(np.searchsorted(v, av), len(v) - 1)
                known = v[place] == av
                by_chunk[chunk].append((doc[known], (weight[place] * n)[known]))
            for chunk, found in by_chunk.items():
                doc, x = (np.concatenate(y) for y in zip(*found))
                docs, i = _grouped(doc)
                rows.append((_ASKED, chunk, _pack(docs, np.bincount(i, weights=x, minlength=len(docs)))))
        return pa.Table.from_batches([_record(rows)])

    return run


_RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _assembled(d: list[float], total: int, vocabulary: int, train_docs: int):
    log_d = [log10(x * r) for r, x in enumerate(d, 1)]
    types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]

    def run(key: tuple, table: pa.Table) -> pa.Table:
        rows = [(k, _unpack(b.as_py())) for k, b in zip(table["kind"].to_pylist(), table["blob"])]
        ids, held, n = next(r for k, r in rows if k == _META)
        base, score, known = np.zeros(len(n)), np.zeros(len(n)), np.zeros(len(n), np.int64)
        for kind, r in rows:
            if kind == _DOCS:
                docs, b, s, k, small = r
                base[docs] += b
                score[docs] += s + sum(x * y for x, y in zip(small, log_d))
                known[docs] += k
            elif kind == _ASKED:
                score[r[0]] += r[1]
        base -= n * log10(total + 0.1 * (vocabulary + 1))
        score -= log10(train_docs) if train_docs else 0.0
        columns = [ids, held, n, known, np.full(len(n), total), base, score]
        names = [f.split()[0] for f in _RESULT.split(", ")]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return run


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the columns of ``_RESULT``.

    Texts whose id has a crc32 remainder of 0 by 10 are held out, all others are learned from. Null and empty texts are
    one end token. Repeated rows are learned and scored each. An empty table gives an empty result; without training texts
    every token is unknown. Other columns are not read.
    """
    spark: SparkSession = docs.sparkSession
    rows = docs.select(F.col(text_col).alias("text"), F.col(id_col).cast("long").alias("doc_id"), (remainder(F.col(id_col), 10) == 0).alias("held"))
    # hash ranges of last words, and of contexts: what is kept of contexts is a small part of the whole
    parts = 2 * partitions(spark)
    ranges = -(-parts // 4)
    words = rows.select("text", "held").mapInArrow(_word_counts, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    place = new_table_path(spark, "katz-words")
    words.write.parquet(place)
    words = spark.read.parquet(place)
    small = [F.count_if(F.col("n") == r) for r in range(1, K + 2)]
    found = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1)), F.coalesce(F.sum(F.when(F.col("n") > K, F.col("n"))), F.lit(0)), *small).first()
    total, vocabulary, larger, counts = found[0], found[1], found[2], list(found[3:])
    # more than a share of 1 / (4 parts) of all tokens: at most 4 parts such words
    hot = {r["h"] % (1 << 64): r["n"] for r in words.filter(F.col("n") > total / (4 * parts)).collect()}
    end = np.uint64(_hash(_END)).astype(np.int64)
    train_docs = words.filter(F.col("h") == int(end)).agg(F.sum("n")).first()[0] or 0
    shuffled = rows.select("text", "doc_id", "held").mapInArrow(_chunks(parts, hot), _ROWS).groupBy("kind", "key")
    tables = new_table_path(spark, "katz-tables")
    counted = shuffled.applyInArrow(_counted(ranges, hot, Unigrams(total, counts, larger)), _ROWS)
    counted.write.partitionBy("kind").parquet(tables)
    stored = spark.read.schema("key long, blob binary, kind int").parquet(tables).select("kind", "key", "blob")
    pairs = np.zeros(K + 2, np.int64)
    for r in stored.filter(F.col("kind") == _COUNTS).select("blob").toLocalIterator():
        pairs += _unpack(r["blob"])[0]
    d = discounts([int(x) for x in pairs[1 : K + 2]])
    weights = stored.filter(F.col("kind").isin(_CONTEXTS, _ASKED)).groupBy("key").applyInArrow(_weights(d), _ROWS)
    answers = stored.filter(F.col("kind").isin(_DOCS, _META)).unionByName(weights)
    return answers.groupBy("key").applyInArrow(_assembled(d, total, vocabulary, train_docs), _RESULT)


def op2(spark, sf_dir) -> DataFrame:
    return score(documents(spark, sf_dir))
