"""Mixing, licence scan and top-k search against DuckDB and brute force; the pipeline's stages."""

from __future__ import annotations

import math
import os
import random
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline
from tests.compare import difference, duckdb_connection
from tests.llm.data import bag, frame, rows
from tilelake.llm import licenses, mixing, queries, simhash, topk

DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="the provided tables are not here")


@needs_data
@pytest.mark.parametrize("name", sorted(queries.STATEMENTS))
def test_query_equals_its_statement(spark, name):
    assert difference(driver.queries()[name](spark, DATA), duckdb_connection(DATA), queries.STATEMENTS[name]) == ""


# --- mixing --------------------------------------------------------------------------


def test_mix_meets_its_targets(spark):
    found = mixing.mix(frame(spark)).collect()
    assert len(found) == len(rows())
    sums, largest = {}, {}
    for r in found:
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 2
        sums[r["source"]] = sums.get(r["source"], 0) + r["taken"]
        largest[r["source"]] = max(largest.get(r["source"], 0), r["size"])
    targets = {r["source"]: (r["target"], r["source_size"]) for r in found}
    assert all(abs(sums[s] - t) <= 1.5 * largest[s] and t <= 2 * n for s, (t, n) in targets.items())
    assert sum(t for t, _ in targets.values()) == pytest.approx(1.5 * sum(n for _, n in targets.values()))
    again = mixing.mix(frame(spark).repartition(3))
    assert bag(again, "doc_id", "taken") == sorted(((r["doc_id"], r["taken"]) for r in found), key=repr)
    assert mixing.take(again).count() == sum(r["copies"] for r in found)


def test_mix_of_nothing(spark):
    assert mixing.mix(frame(spark, [])).count() == 0
    empty = [(1, None, None, None, None, None, None, None), (2, " ", None, "a", None, None, None, None)]
    assert bag(mixing.mix(frame(spark, empty)), "size", "target", "taken") == [(0, 0.0, 0)] * 2


def test_hash_ties_share_their_decision(spark):
    same = [(7, "a b c", "en", "s", 1, None, None, None)] * 9
    assert len({r["taken"] for r in mixing.mix(frame(spark, same)).collect()}) == 1


# --- licences ------------------------------------------------------------------------


def test_scan(spark):
    texts = [
        "Released under the MIT License.", "mit x license", "MIT-License: see the\nGeneral\nPublic License, apache license", None, "",
        "Licensed under the Apache License, Version 2.0.\nmore", "general public general public license mit license mit license",
        "This work is licensed under the GNU General Public License, version 3.",
    ]
    found = licenses.scan(frame(spark, [(i, t, None, None, None, "x", None, None) for i, t in enumerate(texts)])).orderBy("doc_id").collect()
    base = [(r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in found]
    assert base == [
        (1, 3, 3, "mit"), (0, None, None, ""), (3, 0, 7, "apache,gpl,mit"), (0, None, None, ""), (0, None, None, ""),
        (1, 3, 3, "apache"), (3, 2, 7, "gpl,mit"), (1, 7, 7, "gpl"),
    ]
    assert found[0]["labels"] == "mit,mit-notice" and found[5]["labels"] == "apache,apache-2.0" and found[7]["labels"] == "gpl,gpl-3.0"
    assert [r["score"] for r in found][:2] == [1.0, 0.0]
    assert licenses.scan(frame(spark)).count() == len(rows()) and licenses.scan(frame(spark, [])).count() == 0


_HEADERS = {
    "apache-2.0-text": "# Unless required by applicable law or agreed to in writing, software\n# distributed under the License is distributed on an AS IS basis",
    "gpl-text": " * This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU\n * General Public License as published",
    "lgpl": "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense",
    "agpl": "you can redistribute it and/or modify it under the terms of the\nGNU Affero General Public License",
    "bsd": "// Redistribution and use in source and binary forms, with or without\n// modification, are permitted provided",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted",
    "mit-text": "Permission is hereby granted, free of charge, to any person\nobtaining a copy of this software and",
    "bsd-notice": "Released under the BSD license",
    "mit-notice": "Released under the MIT license",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-nc-sa-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "cc-by-4.0": "Licensed under\nCC BY\n4.0",
    "mpl": "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
}


def _brute(text):
    """Labels of notices by every block of every document."""
    words = [w for w in re.split(licenses.SEPARATORS, (text or "").translate({i: i + 32 for i in range(65, 91)})) if w]
    out = set()
    for notice, label in licenses.NOTICES.items():
        wanted, width = set(notice.split()), math.ceil(licenses.BLOCK * len(notice.split()))
        for s in range(len(words)):
            block = words[s : s + width]
            line = f" {' '.join(block)} "
            if len(wanted & set(block)) >= math.ceil(len(wanted) * 0.8 - 1e-9) and all(f" {m} " in line for m in licenses.MUST[label].split(",")):
                out.add(label)
    return out


def test_scan_of_wrapped_headers_gives_one_notice_each(spark, monkeypatch):
    monkeypatch.setattr(licenses, "PIECE", 7)
    rng = random.Random(4)
    vocabulary = sorted({w for t in licenses.NOTICES for w in t.split()}) + ["x", "Äx", "w\u212a"]
    given = [(label, "word " * (n % 40) + text + " word" * 30) for n, (label, text) in enumerate(_HEADERS.items())]
    for n in range(60):  # parts of notices, with words left out, put in, and swapped
        words = rng.choice(sorted(licenses.NOTICES)).split()
        for _ in range(rng.randrange(5)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        given.append((None, rng.choice([" ", "\n", "-"]).join(words * rng.choice([1, 1, 2]) + rng.choices(vocabulary, k=20))))
    given += [(None, "licensed under the license of the software " * 3000), (None, "released under the mit"), (None, None)]
    df = spark.createDataFrame([(i, label, t) for i, (label, t) in enumerate(given)], "doc_id long, `the.label` string, text string")
    for r in licenses.scan(df).collect():
        extra = set(r["labels"].split(",")) - set(r["base_labels"].split(","))
        assert extra == _brute(given[r["doc_id"]][1]), given[r["doc_id"]]
        if r["the.label"]:
            assert extra == {r["the.label"]}


# --- top k ---------------------------------------------------------------------------


def test_top_k_with_ties_nulls_and_repeats(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1.0, 0.0], [1.0, 0.0], [0.5, 0.5], None, [nan, 1.0], [inf, 0.0], [None, 1.0], [0.25], [], [1.0, 0.0]]
    given = [(i, v, "x") for i, v in enumerate(vectors)] + [(0, [1.0, 0.0], "x"), (None, [1.0, 1.0], "x")]
    df = spark.createDataFrame(given, "vec_id long, embedding array<float>, score string")
    found = topk.top_k(df, F.col("vec_id") == 0, 5)
    lists = bag(found, "query_id", "rank", "vec_id", "score")
    one = [(0, 65536), (1, 65536), (9, 65536), (2, 32768), (7, 16384)]
    assert lists == sorted([(0, i, v, s) for i, (v, s) in enumerate(one, 1)] * 2, key=repr)
    assert topk.top_k(df.limit(0), F.col("vec_id") == 0).count() == 0 and topk.top_k(df, F.lit(False)).count() == 0


def test_many_tiles_and_rounds(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD", 3)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 2)
    monkeypatch.setattr(topk, "FAN_IN", 2)
    given = [(i, [float(i % 7), float(i % 3)]) for i in range(40)]
    df = spark.createDataFrame(given, "vec_id long, embedding array<double>")
    found = bag(topk.top_k(df, F.col("vec_id") % 9 == 0, 3), "query_id", "rank", "vec_id", "score")
    expected = []
    for q, v in given[::9]:
        scores = sorted((-int(65536 * (v[0] * w[0] + v[1] * w[1])), c) for c, w in given if c != q)[:3]
        expected += [(q, i, c, -s) for i, (s, c) in enumerate(scores, 1)]
    assert found == sorted(expected, key=repr)


# --- pipeline ------------------------------------------------------------------------


@needs_data
def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DATA)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        if name != "bpe":
            assert docs.columns == corpus_pipeline.COLUMNS
        sizes.append(docs.count())
    start, ordinary, distinct, redacted, mixed, encoded = sizes
    assert 0.5 * start < ordinary <= start and distinct <= ordinary and redacted == distinct and mixed == encoded > 0


def test_one_document_of_a_group_stays(spark):
    near = spark.createDataFrame([(5, "a b c d e", "en", "s", 9), (3, "a b c d e", "en", "s", 9), (3, "a b c d e", "en", "s", 9), (8, None, None, None, None), (9, "", None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    assert bag(corpus_pipeline.drop_near_duplicates(spark, near, DATA), "doc_id") == [(3,), (8,)]


def test_components_without_ids_and_texts_under_one_id(spark):
    one, other, third = (" ".join(f"{c}{i}" for i in range(60)) for c in "abc")
    given = [(None, one), (5, one), (None, other), (None, other), (7, third), (7, third.replace("c59", "z")), (7, third), (6, third)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in given], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, DATA)
    # one row of each component, the one of smallest id; without any id, one of its texts
    near = simhash.near_duplicates(docs.filter("doc_id is not null")).filter("doc_id = 7").select("component_id").distinct().count()
    assert bag(kept, "doc_id", "text")[:1] == [(5, one)] and (None, other) in bag(kept, "doc_id", "text")
    assert kept.count() == 3 + (near - 1) and kept.filter("doc_id is null").count() == 1
    assert corpus_pipeline.drop_near_duplicates(spark, docs.limit(0), DATA).count() == 0
