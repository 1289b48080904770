"""Source divergence, periodic runs and SuperMinHash against brute force."""

from __future__ import annotations

import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.data import bag, frame, prose, rows
from tilelake.llm import divergence, runs, superminhash


# --- periodic runs ---------------------------------------------------------------


def _all_runs(words, least=24):
    """Every stretch of every period, kept if no smaller period fits it."""
    found = {}
    for q in range(1, len(words) // 3 + 1):
        at = 0
        while at < len(words) - q:
            if words[at] != words[at + q]:
                at += 1
                continue
            start = at
            while at < len(words) - q and words[at] == words[at + q]:
                at += 1
            length = at + q - start
            if length >= max(least, 3 * q) and (start, length) not in found:
                found[start, length] = q
    return sorted((s, n, q) for (s, n), q in found.items())


def _periodic(rng, letters, parts):
    words = []
    for _ in range(parts):
        if rng.random() < 0.5:
            block = [rng.randrange(letters) for _ in range(rng.choice([1, 2, 3, 5, 7, 8, 9, 12, 15, 16, 17, 31, 32, 33, 60]))]
            if rng.random() < 0.3:
                block = block * 2 + block[: rng.randrange(len(block))]
            words += (block * 9)[: rng.randrange(8, 5 * len(block) + 30)]
        else:
            words += [rng.randrange(letters) for _ in range(rng.randrange(1, 40))]
    return words


@pytest.mark.parametrize("seed", range(30))
def test_runs_equal_brute_force(seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(runs, "SEGMENT", rng.choice([7, 64, 100, 1 << 16]))
    texts = [_periodic(rng, rng.choice([2, 3, 50]), rng.randrange(0, 9)) for _ in range(12)] + [[], [1] * 300, [1] * 23, [1] * 24]
    found = runs.runs_of([np.array(t, np.int64) for t in texts])
    assert found == [_all_runs(t) for t in texts]


def test_long_runs():
    assert runs.runs_of([np.zeros(200_000, np.int64)]) == [[(0, 200_000, 1)]]
    block = np.arange(50_000)
    assert runs.runs_of([np.concatenate([[-5 + 70_000], np.tile(block, 4), [70_001]])]) == [[(1, 200_000, 50_000)]]


def test_runs_of_documents(spark):
    given = rows() + [(900 + i, " ".join(map(str, _periodic(random.Random(i), 3, 6))), None, None, None, None, None, None) for i in range(20)]
    df = frame(spark, given).withColumnRenamed("score", "a score.x").withColumn("runs", F.lit(1))
    found = runs.find(df, rewrite=runs.planted)
    assert [c for c in df.columns if c not in ("text", "runs")] == found.columns[:-4]
    expected = []
    for r in given:
        words = (r[1] or "").encode().split()
        h = 1 if r[0] is None else zlib.crc32(str(r[0]).encode())
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        each = _all_runs(words)
        best = min(each, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2])) if each else None
        dropped = {i for s, n, q in each for i in range(s + q, s + n)}
        expected.append((r[0], len(words), each, best, b" ".join(w for i, w in enumerate(words) if i not in dropped).decode()))
    got = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["strongest_run"] and tuple(r["strongest_run"]), r["collapsed_text"]) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert any(e[2] for e in expected) and runs.find(frame(spark, [])).count() == 0


# --- SuperMinHash ----------------------------------------------------------------


def _one_by_one(elements, registers):
    """The published loop: one element after another, each through all its steps."""
    held = [2**64 - 1] * registers
    mask = 2**64 - 1

    def mixed(x):
        x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & mask
        x = (x ^ (x >> 27)) * 0x94D049BB133111EB & mask
        return x ^ (x >> 31)

    for e in elements:
        order = list(range(registers))
        for j in range(registers):
            drawn = mixed((e + (j + 1) * 0x9E3779B97F4A7C15) & mask)
            k = j + ((drawn & 0xFFFFFFFF) * (registers - j) >> 32)
            order[j], order[k] = order[k], order[j]
            held[order[j]] = min(held[order[j]], j << 32 | drawn >> 32)
    return held


def test_signatures_equal_the_loop(monkeypatch):
    rng = np.random.default_rng(5)
    sets = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (0, 1, 2, 7, 60, 900)]
    expected = [_one_by_one(s.tolist(), 40) for s in sets]
    for at_once in (50, 1 << 15):
        monkeypatch.setattr(superminhash, "AT_ONCE", at_once)
        found = superminhash.signatures(np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets]), len(sets), 40)
        assert found.tolist() == expected


def _shingles(text, size=2):
    words = (text or "").encode().lower().split()
    size = min(size, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def _linked(texts, size=2, percent=80):
    sets, label = [_shingles(t, size) for t in texts], list(range(len(texts)))
    near = [[j for j, b in enumerate(sets) if a and b and 100 * len(a & b) >= percent * len(a | b)] for a in sets]
    while True:
        new = [min([label[i], *(label[j] for j in near[i])]) for i in range(len(texts))]
        if new == label:
            return sets, label
        label = new


def _near_texts():
    """Chains in which neighbours are alike and ends are not, a template that many share below the threshold, and copies."""
    out = []
    for chain in range(3):
        words = prose(100 + chain, 60).split()
        for step in range(25):
            out.append(" ".join(words))
            words[(7 * step) % 60 : (7 * step) % 60 + 2] = [f"c{chain}s{step}"]
    shared = prose(200, 60)
    out += [f"{shared} {prose(300 + i, 25)}" for i in range(40)] + [shared] * 5 + [shared.upper()]
    return out + ["one", "ONE", "one two", "two one", "", None]


@pytest.mark.parametrize("size", [2, 3])
def test_superminhash_equals_brute_force(spark, monkeypatch, size):
    for name, value in (("PER_CENTRE", 3), ("CHUNK", 8), ("COLUMNS", 64)):
        monkeypatch.setattr(superminhash, name, value)
    given = rows() + [(1000 - i, t, None, None, None, None, None, None) for i, t in enumerate(_near_texts())]
    texts, ids = [r[1] for r in given], [r[0] for r in given]
    sets, label = _linked(texts, size)
    least = {x: min((i for i, y in zip(ids, label) if y == x and i is not None), default=None) for x in set(label)}
    expected = [(i, len(s), least[x] if s else i, i == (least[x] if s else i)) for i, s, x in zip(ids, sets, label)]
    df = frame(spark, given).withColumnRenamed("score", "a.b c").withColumn("kept", F.lit("x"))
    found = superminhash.near_duplicates(df, shingle=size)
    assert found.columns == ["doc_id", "lang", "source", "n_chars", "a.b c", "Size", "key", "n_shingles", "component_id", "kept"]
    assert bag(found, "doc_id", "n_shingles", "component_id", "kept") == sorted(expected, key=repr)


def test_buckets_without_their_centre(spark):
    """Texts that no centre is like are still linked with each other."""
    base = prose(7, 80).split()
    texts = [" ".join(base), *(" ".join([*base[:55], *prose(50 + i // 4, 25).split()[: 25 - i % 2]]) for i in range(40))]
    df = frame(spark, [(i, t, None, None, None, None, None, None) for i, t in enumerate(texts)])
    # one band of one register: nearly everything shares buckets, few centres are alike
    found = {r["doc_id"]: r["component_id"] for r in superminhash.near_duplicates(df, bands=200, band_rows=1).collect()}
    assert [found[i] for i in range(len(texts))] == _linked(texts)[1]
    assert superminhash.near_duplicates(frame(spark, [])).count() == 0


# --- source divergence -----------------------------------------------------------


def _divergences(given, least, top):
    import re
    from collections import Counter, defaultdict

    docs = [(r[2] or "", r[3] or "", Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or "")))) for r in given]
    counts, in_lang, df = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in docs:
        counts[lang, source].update(terms)
        in_lang[lang].update(terms)
        df[lang].update(dict.fromkeys(terms, 1))
    out = []
    for lang in {g[0] for g in counts}:
        kept = [t for t, n in df[lang].items() if n >= least]
        share = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c[x] for x in kept) + 5 * len(kept)) for t in kept}
        own = {s: share(c) for (x, s), c in counts.items() if x == lang}
        whole = share(in_lang[lang])
        for s, p in own.items():
            pairs = [(o, sum(abs(p[t] - q[t]) for t in kept)) for o, q in own.items() if o != s]
            terms = [(t, p[t] - whole[t]) for t in kept if counts[lang, s][t] and p[t] > whole[t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda f: (-f[1], f[0].encode()))[:limit]
                out += [(lang, s, part, item, value, rank) for rank, (item, value) in enumerate(ranked, 1)]
    return sorted(out)


@pytest.mark.parametrize("sizes", [(512, 16_384, 1 << 21, 400_000), (3, 9, 16, 5)])
def test_divergences(spark, monkeypatch, sizes):
    for name, value in zip(("BLOCK", "SHARD_ROWS", "CELLS"), sizes):
        monkeypatch.setattr(divergence, name, value)
    given = rows() * 2 + [(i, prose(i, 30) + " Ähnlich été it's x-ray", "de", f"only{i % 8}", None, None, None, None) for i in range(30)]
    df = frame(spark, given)
    found = bag(divergence.divergences(df, min_docs=4, top=5), "lang", "source", "part", "item", "value", "rank")
    assert found == _divergences(given, 4, 5) and {r[2] for r in found} == {"pair", "term"}
    assert divergence.divergences(frame(spark, [])).count() == 0
    none = divergence.divergences(df, min_docs=1000).collect()
    assert none and all(r["part"] == "pair" and r["value"] == 0 for r in none)


def test_shares_are_exact():
    count, total = np.array([0, 5, 10**15 - 1, 9 * 10**15]), np.array([7, 5, 10**15, 9 * 10**15 + 1])
    assert divergence._share(count, total, 5).tolist() == [1 + 10**9 * int(c) // int(t) for c, t in zip(count, total)]
    with pytest.raises(OverflowError):
        divergence._share(np.array([1]), np.array([10**16]), 5)
