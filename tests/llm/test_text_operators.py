"""Fingerprints, personal data, toxicity, language model, encoding and page texts on small tables."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.data import frame, prose, rows
from tilelake.llm import bpe, fingerprints, katz, lstm_crf, pages, pii, simhash, toxicity
from tilelake.llm.common import words_of


# --- SimHash ---------------------------------------------------------------------


def _components(codes: np.ndarray, distance: int) -> np.ndarray:
    near = np.bitwise_count(codes[:, None] ^ codes[None, :]) <= distance
    label = np.arange(len(codes))
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            return label
        label = new


@pytest.mark.parametrize("seed", range(4))
def test_gray_index_equals_brute_force(seed):
    rng = np.random.default_rng(seed)
    codes = [rng.integers(0, 2**63, 150).astype(np.uint64)]
    for _ in range(6):
        code = codes[rng.integers(len(codes))].copy()
        for _ in range(rng.integers(0, 5)):
            code ^= np.uint64(1) << rng.integers(0, 64, len(code)).astype(np.uint64)
        codes.append(code)
    codes = np.unique(np.concatenate(codes))
    codes = codes[np.argsort(simhash.gray_rank(codes))]
    found = simhash.links(codes, np.zeros(len(codes), np.int64), 4)
    assert (found == _components(codes, 4)).all()


def test_near_duplicates(spark):
    found = simhash.near_duplicates(frame(spark)).collect()
    assert len(found) == len(rows())
    codes = np.array([simhash.fingerprint_of(r["text"]) for r in found], np.uint64)
    assert [r["fingerprint"] for r in found] == [f"{int(c):016x}" for c in codes]
    label = _components(codes, 4)
    ids = [r["doc_id"] for r in found]
    least = {x: min((i for i, y in zip(ids, label) if y == x and i is not None), default=None) for x in set(label)}
    assert [r["component_id"] for r in found] == [least[x] for x in label]
    assert simhash.near_duplicates(frame(spark, [])).count() == 0


# --- consistent weighted sampling ----------------------------------------------------


def _jaccard(a: str, b: str) -> float:
    a, b = Counter(a.split()), Counter(b.split())
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def test_samples_agree_as_often_as_weights_do():
    sampler = fingerprints.Sampler(2048)
    pairs = [(prose(1, 300), prose(2, 300)), (prose(3, 50), prose(3, 50) + " and"), ("a a a a b", "a b b b")]
    for a, b in pairs:
        found = fingerprints.likeness(*(sampler.signature(fingerprints.bag_of(x)) for x in (a, b)))
        assert found == pytest.approx(_jaccard(a, b), abs=0.05)


def test_recent_words_are_drawn_once(monkeypatch):
    """Words come back within the reach of what is kept, and signatures do not depend on what is."""
    sampler, hashed = fingerprints.Sampler(8), []
    digest = fingerprints.xxhash.xxh64_intdigest

    class Counted:
        xxh64_intdigest = staticmethod(lambda *a: hashed.append(a[0]) or digest(*a))

    monkeypatch.setattr(fingerprints, "xxhash", Counted)
    bags = [{b"%d" % w: 1 for w in range(i, i + 5000)} for i in range(0, 100_000, 5000)]
    bags.append({b"%d" % w: 1 + w % 3 for w in range(33)})
    first = [sampler.signature(bag) for bag in bags]
    assert all((sampler.signature(bag) == s).all() for bag, s in zip(bags, first))
    # the 22 words that a bag repeats are drawn with all their numbers as well
    assert len(hashed) == 100_022
    for bag, s in zip(bags, first):
        assert (fingerprints.Sampler(8).signature(dict(reversed(bag.items()))) == s).all()


def test_fingerprint(spark):
    given = [r for r in rows() if r[0] is not None]
    found = fingerprints.fingerprint(frame(spark, given)).collect()
    order = sorted(given, key=lambda r: (-r[0], r[1] or ""))
    texts = [r[1] or "" for r in order]
    found.sort(key=lambda r: -r["doc_id"])
    assert [(r["doc_id"], r["n_chars"]) for r in found] == [(r[0], len(t)) for r, t in zip(order, texts)]
    import hashlib

    edited = [fingerprints.edited_text(t, texts[(i + 1) % len(texts)]) for i, t in enumerate(texts)]
    assert [r["edited_sha256"] for r in found] == [hashlib.sha256(e.encode()).hexdigest() for e in edited]
    by_text = {}
    for r, t in zip(found, texts):
        assert by_text.setdefault(" ".join(t.split()), r["fingerprint"]) == r["fingerprint"]
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert fingerprints.fingerprint(frame(spark, [])).count() == 0
    assert fingerprints.fingerprint(frame(spark, [given[5]])).first()["near_next"] == 1.0


# --- personal data -------------------------------------------------------------------


def test_base_patterns_match_plain_ones():
    rng = random.Random(4)
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    for _ in range(3000):
        text = "".join(rng.choice("a1.@-+ 2é%") for _ in range(rng.randrange(40)))
        base = pii.base_spans(text)
        assert [(a, b) for k, a, b in base if k == 0] == [m.span() for m in email.finditer(text)]
        found = [m.span() for m in ip.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
        assert [(a, b) for k, a, b in base if k == 1] == found


def test_gradients_of_the_tagger():
    rng = np.random.default_rng(0)
    symbols, tags = rng.integers(0, 9, (3, 6)), rng.integers(0, 3, (3, 6))
    barred = np.zeros((3, 3), bool)
    p = lstm_crf.new_parameters(9, 3)
    _, g = lstm_crf.loss_and_gradients(p, symbols, tags, barred)
    for name in p:
        at = tuple(rng.integers(0, n) for n in p[name].shape)
        kept, losses = p[name][at], []
        for step in (1e-5, -1e-5):
            p[name][at] = kept + step
            losses.append(lstm_crf.loss_and_gradients(p, symbols, tags, barred)[0])
        p[name][at] = kept
        assert g[name][at] == pytest.approx((losses[0] - losses[1]) / 2e-5, abs=1e-5)


def test_find_and_redact(spark):
    found = {r["doc_id"]: r for r in pii.find(frame(spark), rounds=30).collect()}
    row = next(r for r in found.values() if r["n_email"])
    assert (row["n_email"], row["n_ip"], row["n_card"], row["n_phone"]) == (1, 1, 0, 1)
    assert row["spans"].startswith("email:29:46,ip:48:62") and "text" not in row.asDict()
    clean = {r["doc_id"]: r for r in pii.find(frame(spark), redact=True, rounds=30).collect()}
    assert "<EMAIL>" in clean[row["doc_id"]]["text"] and clean[40]["text"] is None
    assert all(r["text"] is None or r["n_chars"] == len(r["text"]) for r in clean.values())
    assert pii.find(frame(spark, [])).count() == 0
    odd = frame(spark).withColumn("a.b c", F.lit(1))
    assert "a.b c" in pii.find(odd, rounds=1).columns
    assert pii.redacted("ab cd ef", [(0, 0, 2), (1, 1, 5), (2, 6, 8)]) == "<EMAIL> <PHONE>".replace("PHONE", "CARD")


def _personal(rng: random.Random, kind: int) -> str:
    if kind == 0:
        return "".join(rng.choice("abcdehlmnorst") for _ in range(6)) + f"{rng.randrange(99)}@mail{rng.randrange(99)}.example.org"
    if kind == 1:
        return ".".join(str(rng.randrange(1, 256)) for _ in range(4))
    if kind == 2:
        digits = "4" + "".join(rng.choice("0123456789") for _ in range(14))
        return next(f"{d[:4]} {d[4:8]} {d[8:12]} {d[12:]}" for x in range(10) if pii._luhn(d := f"{digits}{x}"))
    return f"+1 {rng.randrange(200, 999)} {rng.randrange(200, 999)} {rng.randrange(1000, 9999)}"


def test_model_finds_each_kind_beside_copies_and_years(spark):
    """A span follows a year by far; two groups of copies alone would fill the sample."""
    rng = random.Random(3)
    copies = [f"copied in {year} " + prose(year, 30) for year in (1987, 2004)]
    texts = [copies[i % 2] for i in range(3000)] + [f"in {1900 + i % 120} {prose(i, 40)}" for i in range(1000)]
    texts += [f"since {1950 + i % 70} {prose(i, 60)} {_personal(rng, i % 4)} {prose(i + 1, 9)}" for i in range(200)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(7)
    sample = pii._sample(docs, "text")
    assert {k: sum(r[0] == k for r in sample) for k in range(5)} == {0: 50, 1: 50, 2: 50, 3: 50, 4: pii.SHARE}
    assert len(set(sample)) == len({r[2] for r in sample}) == len(sample)
    assert sample == pii._sample(docs.repartition(3), "text")
    model = pii.train_model(sample)
    number = lambda *sizes: [str(rng.randrange(10 ** (n - 1), 10**n)) for n in sizes]
    user = lambda: rng.choice(["rita", "paul.lang", "m_okafor", "x7", "vera.holm"]) + rng.choice(["", "", "31", "4"])
    host = lambda: rng.choice(["uni", "corp-mail", "department.law", "gruen", "post.kvk9"]) + rng.choice([".edu", ".net", ".ac.uk", ".org", ".fr"])
    unseen = {  # no host, user or number of the table
        0: [lambda: f"{user()} @ {host()}", lambda: f"{user()}(@){host()}", lambda: f"{user()} [at] {host()}", lambda: f"{user()}@{host()}".replace(".", " . "),
            lambda: f"{user()} at {host()}".replace(".", " dot ")],
        1: [lambda: " . ".join(str(rng.randrange(256)) for _ in range(4)), lambda: "-".join(str(rng.randrange(256)) for _ in range(4))],
        2: [lambda: _personal(rng, 2).replace(" ", "."), lambda: _personal(rng, 2).replace(" ", "  ")],
        3: [lambda: "({}) {}-{}".format(*number(3, 3, 4)), lambda: "00{} {} {}".format(*number(2, 3, 6)), lambda: "({}) {}-{}".format(*number(3, 3, 4)).translate({48 + d: 0xFF10 + d for d in range(10)})],
    }
    for kind, forms in unseen.items():
        spans = [forms[i % len(forms)]() for i in range(60)]
        given = [f"from {1950 + i} {prose(500 + i, 30)} {s} {prose(700 + i, 9)}" for i, s in enumerate(spans)]
        found = [b for _, b in pii.all_spans(given, model)]
        right = sum((kind, t.index(s), t.index(s) + len(s)) in f for t, s, f in zip(given, spans, found))
        assert right >= 54, (pii.KINDS[kind], right)
    assert sum(map(len, pii.model_spans(model, [f"in {1900 + i} {prose(900 + i, 30)}" for i in range(100)]))) <= 2


# --- toxicity ------------------------------------------------------------------------


def test_toxicity_learns_and_scores(spark):
    rng = random.Random(1)
    texts = [prose(i, 60) + (" you " + rng.choice(["blorp", "snark"]) + " fool " if i % 4 == 0 else "") for i in range(400)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(900, None, None), (901, "", None), (None, "a", None)], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(300)] + [(1, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    found = toxicity.classify(docs, labels).collect()
    assert len(found) == 403 and all(0 <= r["score"] <= 1 for r in found)
    fresh = [r for r in found if r["doc_id"] is not None and 300 <= r["doc_id"] < 400]
    assert all(r["predicted"] == (r["doc_id"] % 4 == 0) for r in fresh)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found if r["doc_id"] is not None)
    assert {r["predicted"] for r in toxicity.classify(docs, labels.limit(0)).collect()} == {0}
    assert toxicity.classify(docs.limit(0), labels).count() == 0


def _kneser_ney(texts, other):
    """The probability of a word after another by the definition, from dictionaries only."""
    count = lambda ts: Counter(p for t in dict.fromkeys(ts) for p in zip([b"\n", *words_of(t)], words_of(t)))
    own, both = count(texts), count(texts).keys() | count(other).keys()
    vocabulary = {w for p in both for w in p} | {b"\n"}
    d = toxicity.DISCOUNT

    def shared(w):
        spare = d * len({b for _, b in both}) / len(both)
        return max(sum(b == w for _, b in both) - d, 0) / len(both) + spare / (len(vocabulary) + 1)

    def word(w):
        left = d * len({b for _, b in own}) / len(own)
        return max(sum(b == w for _, b in own) - d, 0) / len(own) + left * shared(w)

    def pair(v, w):
        after = {b: n for (a, b), n in own.items() if a == v}
        n = sum(after.values())
        return max(after.get(w, 0) - d, 0) / n + d * len(after) / n * word(w) if n else word(w)

    return pair


def test_toxicity_difference_is_that_of_two_kneser_ney_models():
    toxic, ordinary = ["you fool you", "a fool of the worst", "you you", "you you"], ["the words of a text", "a text of words", "", "you"]
    model = toxicity.Model(toxic, ordinary)
    p = _kneser_ney(toxic, ordinary), _kneser_ney(ordinary, toxic)
    for text in [*toxic, *ordinary, "text you fool the a", "worst the worst you", "fool a"]:
        tokens = words_of(text)
        expected = sum(math.log(p[0](v, w) / p[1](v, w)) for v, w in zip([b"\n", *tokens], tokens)) / max(1, len(tokens))
        assert abs(model.features(text)[1] - expected) < 1e-9, text
    assert model.features(None) == model.features(" \n") == [1.0] + [0.0] * (len(model.curve) - 1)
    assert abs(model.features("new newer")[1] - model.unseen - model.contexts[0] / 2) < 1.0


@pytest.mark.parametrize("marks", [20, 300])
def test_toxicity_by_many_rare_expressions(spark, marks):
    """Toxic documents hold two of many expressions, so that each is seen in a few documents only."""
    rng = random.Random(marks)
    given = []
    for i in range(4000):
        text, bad = [f"w{rng.randrange(3000)}" for _ in range(80)], int(rng.random() < 0.5)
        for _ in range(2 * bad):
            text[rng.randrange(80)] = f"mark{rng.randrange(marks)}"
        given.append((i, " ".join(text), bad))
    df = spark.createDataFrame(given, "doc_id long, text string, toxic int")
    found = toxicity.classify(df, df.select("doc_id", "toxic")).filter("held_out").collect()
    bad = [r["predicted"] for r in found if r["toxic"]]
    assert sum(bad) >= 0.9 * len(bad) and sum(r["predicted"] for r in found if not r["toxic"]) <= 0.02 * len(found)


def test_toxicity_of_odd_columns_and_very_long_texts(spark):
    given = [(i, ("fool " if i % 2 else "fine ") * 40, ("x",), 0.5) for i in range(40)] + [(99, "word " * 200_000, None, None)]
    df = spark.createDataFrame(given, "doc_id long, `a.text` string, `s t` struct<`in side`: string>, Score double")
    found = toxicity.classify(df, df.selectExpr("doc_id", "cast(doc_id % 2 as int) toxic"), text_col="a.text")
    assert found.columns == ["doc_id", "a.text", "s t", "held_out", "score", "predicted"] and found.count() == 41


# --- Katz ----------------------------------------------------------------------------


def test_katz_equals_brute_force(spark):
    given = [r for r in rows() if r[0] is not None]
    found = {r["doc_id"]: r for r in katz.score(frame(spark, given)).collect()}
    tokens = [(r[0], words_of(r[1]) + [katz._END]) for r in given]
    held = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    words, pairs = Counter(), Counter()
    for i, w in tokens:
        if not held(i):
            words.update(w)
            pairs.update(zip([katz._BEGIN, *w], w))
    total, times = sum(words.values()), [Counter(c.values()) for c in (words, pairs)]
    unigrams = katz.Unigrams(total, [times[0][r] for r in range(1, 7)], sum(c for c in words.values() if c > 5))
    d = katz.discounts([times[1][r] for r in range(1, 7)])
    p = lambda w: float(unigrams.p(np.array([words[w]]))[0])
    context = Counter()
    for (v, _), c in pairs.items():
        context[v] += c
    kept = lambda c: c * (d[c - 1] if c <= 5 else katz.KEEP)

    def weight(v):
        seen = [(w, c) for (u, w), c in pairs.items() if u == v]
        return (1 - sum(kept(c) for _, c in seen) / context[v]) / (1 - sum(p(w) for w, _ in seen)) if seen else 1.0

    for i, w in tokens:
        base = sum(math.log10((words[x] + 0.1) / (total + 0.1 * (len(words) + 1))) for x in w)
        score = sum(
            math.log10(kept(pairs[v, x]) / context[v]) if pairs[v, x] else math.log10(weight(v) * p(x))
            for v, x in zip([katz._BEGIN, *w], w)
        )
        r = found[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held(i), len(w), sum(words[x] > 0 for x in w), total)
        assert r["base_score"] == pytest.approx(base) and r["score"] == pytest.approx(score)
    v = b"the"
    everything = sum(kept(c) / context[v] for (u, _), c in pairs.items() if u == v)
    everything += weight(v) * (sum(p(w) for w in words if not pairs[v, w]) + unigrams.unknown)
    assert everything == pytest.approx(1)
    assert katz.score(frame(spark, [])).count() == 0 and katz.score(frame(spark)).count() == len(rows())


# --- BPE -----------------------------------------------------------------------------


def test_automaton_encodes_as_the_library_does():
    from tokenizers import Tokenizer

    path = bpe.default_vocabulary()
    library, codec = Tokenizer.from_file(path), bpe.Codec(bpe.compile_vocabulary(path))
    rng = random.Random(2)
    signs = [chr(i) for i in range(0x250)] + list(" 　​﻿😀日́٠²Ⅷ")
    kinds = [
        lambda n: "".join(rng.choice(signs) for _ in range(n)),
        lambda n: "".join(rng.choice(" \t\n\r\x0b\x0c\x1c\x1f\x85\xa0 a1.'s") for _ in range(n)),
        lambda n: "".join(rng.choice(["<|endoftext|>", " ", "the", "'ll", "1"]) for _ in range(n)),
        lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz'") for _ in range(4 * n)),
        lambda n: rng.choice("a1 .\n-=") * n * 10,
    ]
    for i in range(3000):
        text = kinds[i % len(kinds)](rng.randrange(50))
        expected = library.encode(text, add_special_tokens=False).ids
        ids = codec.encode(text)
        assert list(ids) == expected, text
        assert codec.decode(ids) == library.decode(expected, skip_special_tokens=False)


def test_encode_frames(spark):
    found = bpe.encode(frame(spark)).collect()
    assert len(found) == len(rows()) and all(r["n_tokens"] == len(r["ids"]) for r in found)
    codec = bpe.Codec(bpe.compile_vocabulary(bpe.default_vocabulary()))
    texts = {r[0]: r[1] or "" for r in rows()}
    assert all(codec.decode(bpe.array("I", r["ids"])) == texts[r["doc_id"]] for r in found)
    assert bpe.encode(frame(spark, [])).count() == 0 and bpe.encode(frame(spark), digests=True).count() == len(rows())


# --- pages ---------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><a href="/">Home</a></header><nav><ul><li><a href="/a">the a</a></li></ul></nav><div class="cookie-notice">We use cookies
in the page and on the site.</div><div class="ad">Buy the new thing of the year.</div><!-- <p>no</p> -->
<main><article><h1>On the &amp; of</h1><p>Short.</p><p>The <b>main</b> text of  the&nbsp;page is here, and it is long enough to tell
that this is the text of an article and not of a menu.<br>It goes on.</p></article></main>
<aside>Read the other texts of the site.</aside><div id="comments"><p>I think that the text of the article is good and
that the author is right about most of the things in it.</p></div><form><p>Send the form to us.</p></form>
<footer>&copy; the site</footer></body></html>"""


def test_main_text(spark):
    expected = (
        "On the & of\n\nShort.\n\nThe main text of the page is here, and it is long enough to tell that this is the text of an article and "
        "not of a menu. It goes on."
    )
    assert pages.main_text(PAGE) == expected
    for broken in ("<p", "<", "<p class='a", "<script>x", "<!-- x", "a < b > c", "</div></div>", "<div" * 500, "\x00", "&#xZZ;&nosuch;"):
        assert isinstance(pages.main_text(broken), str)
    df = spark.createDataFrame([(1, "u", PAGE, "x"), (2, None, None, None), (None, "u", "", None), (1, "u", PAGE, "x")], "page_id long, url string, html string, text string")
    found = pages.extract(df).collect()
    assert sorted(r["n_chars"] for r in found) == [0, 0, len(expected), len(expected)]
    assert pages.extract(df.limit(0)).count() == 0


def test_layout_classes_do_not_hide_the_article():
    text = "The whole of the article is here and it is not a menu, as the words of this text are in it and on the page. " * 3
    body, alone = f"<p>{text}</p>", text.strip()
    for page in (
        f"<main class='content no-sidebar'>{body}</main>",
        f"<div class='has-sidebar'><article>{body}</article></div>",
        f"<article class='post comments-open'>{body}</article>",
        f"<div class='overflow-hidden'>{body}</div>",
        f"<div id='page' class='comments-open nav-fixed right-sidebar'>{body}</div>",
        f"<body class='sidebar-left modal-open'>{text}</body>",
        f"<body class='sidebar'><div class='social widget'><main id='search'><article class='share'>{body}</article></main></div></body>",
    ):
        assert pages.main_text(page) == alone, page
    for other in ("<div class='comments'>{0}</div>", "<div id='comments-list'><article class='comment'>{0}</article></div>", "<section class='related-posts x'>{0}</section>", "<div class='cookie-banner'>{0}</div>", "<div role='navigation'>{0}</div>", "<article class='ad'>{0}</article>", "<p class='ad'>Buy {1}</p>"):
        advert = other.format("<p>" + text.replace("article", "advert") + "</p>", text)
        assert pages.main_text(f"<article class='post'>{body}</article>{advert}") == alone, other
        assert pages.main_text(f"{advert}<main class='no-sidebar'>{body}</main>") == alone, other
    assert pages.main_text(f"<div style='display: none'><article>{body}</article></div>") == ""


def test_open_elements():
    assert pages.main_text("<head><title>t<p>a" ) == ""
    body = "<article><p>The text of the page and of the article</p></article>"
    assert pages.main_text(f"<html><head><meta><body>{body}") == pages.main_text(body) != ""
    assert pages.main_text(f"{body}<script>var a = 1; <p>the of and</p>") == pages.main_text(body)


def test_blocks_between_decided_ones():
    good = "<p>" + "the text of the page is in the block and " * 8 + "</p>"
    bad = "<p><a href='x'>link one</a> <a>link two</a></p>"
    kept = pages.main_text(f"{bad}<p>near bad</p>{bad}{good}<p>near good</p>{good}<p>also</p>")
    assert "near good" in kept and "near bad" not in kept and kept.endswith("also")
