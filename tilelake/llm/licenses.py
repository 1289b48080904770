"""Licence scan by an exact set-similarity join. DataFrame functions only.

Templates are held against blocks of consecutive words of a document, whatever lines they stand on: a notice of m words
against every block of ``BLOCK`` * m words, at a containment of its distinct words of at least NOTICE_SHARE, a base phrase
against every block of as many words, at a containment of 1. Template words are ordered by how often the corpus has them, rarest
first. A block that contains enough of a template has one of the template's rarest words, so only the places of these
prefixes are joined with the templates. Of a place's surroundings count the words from its own on in the order, since a block with a
rarer word is found there; those too few for the template are dropped (length and positional filter), and every block around
what is left is verified: its containment, and that the words which tell templates apart (``MUST``) stand in it one
after another. So a block can meet the notices of one licence only, and a base phrase is found just where its words stand.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilelake.llm.common import column, documents, free_names, lower_ascii
from tilelake.runtime import checkpointed

#: What separates the words of a licence text, lower-cased; and what its words are made of, in either case.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LETTERS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
NOTICE_SHARE = 0.8
#: Words of a block for each word of a notice.
BLOCK = 1.5
#: Words of a piece, in which a document's places are looked at; blocks reach over its ends.
PIECE = 64
#: Base phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Usual notices and their labels.
NOTICES = {
    "released under the mit license": "mit-notice",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit-text",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "isc",
    "licensed under the apache license version 2 0": "apache-2.0",
    "unless required by applicable law or agreed to in writing software distributed under the license": "apache-2.0-text",
    "this work is licensed under the gnu general public license version 3": "gpl-3.0",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "gpl-text",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license": "lgpl",
    "you can redistribute it and or modify it under the terms of the gnu affero general public license": "agpl",
    "licensed under cc by nc sa 4 0": "cc-by-nc-sa-4.0",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "licensed under cc by 4 0": "cc-by-4.0",
    "licensed under cc by sa 4 0": "cc-by-sa-4.0",
    "released under the bsd license": "bsd-notice",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
    "this is free and unencumbered software released into the public domain": "unlicense",
}
#: The words of a notice that must stand one after another in a block, by label; several stretches are parted by a comma.
MUST = {
    "mit-notice": "mit license",
    "mit-text": "free of charge",
    "isc": "with or without fee",
    "apache-2.0": "apache license,2 0",
    "apache-2.0-text": "applicable law",
    "gpl-3.0": "gnu general public license,version 3",
    "gpl-text": "gnu general public license",
    "lgpl": "gnu lesser general public license",
    "agpl": "gnu affero general public license",
    "cc-by-nc-sa-4.0": "cc by nc sa 4 0",
    "cc-by-nc-4.0": "cc by nc 4 0",
    "cc-by-4.0": "cc by 4 0",
    "cc-by-sa-4.0": "cc by sa 4 0",
    "bsd-notice": "bsd license",
    "bsd": "source and binary forms",
    "mpl": "mozilla public license",
    "unlicense": "unencumbered software",
}


def _needed(words: int, share: float) -> int:
    return max(1, math.ceil(words * share - 1e-9))


def _templates(phrases: dict[str, str], notices: dict[str, str], must: dict[str, str], share: float) -> list[tuple]:
    """(template, label, base, distinct words, needed, words of a block, stretches that must stand in it)."""
    out = [(t, label, True, sorted(set(t.split())), len(set(t.split())), len(t.split()), [t]) for t, label in phrases.items()]
    for text, label in notices.items():
        distinct = sorted(set(text.split()))
        stretches = [m for m in must.get(label, "").split(",") if m]
        out.append((text, label, False, distinct, _needed(len(distinct), share), math.ceil(BLOCK * len(text.split())), stretches))
    return out


def _postings(templates: list[tuple], found: dict[str, int]) -> list[tuple]:
    """A row for each word of a template's prefix, with the template's words from it on in the corpus' order."""
    out = []
    for text, label, base, distinct, needed, width, stretches in templates:
        order = sorted(distinct, key=lambda w: (found.get(w, 0), w))
        for j, word in enumerate(order[: len(order) - needed + 1]):
            out.append((word, text, label, base, order[j:], len(order), needed, width, [f" {m} " for m in stretches]))
    return out


def _array(words: Iterable[str]) -> Column:
    return F.array(*(F.lit(w) for w in words))


def _frequencies(docs: DataFrame, words: list[str], text_col: str) -> dict[str, int]:
    """How often each template word occurs; at most one row per template word comes back.

    Counted as lower() has it: the order decides what is joined, not what is found.
    """
    every = docs.select(F.explode(F.split(F.lower(column(text_col)), SEPARATORS)).alias("word"))
    return {r["word"]: r["count"] for r in every.filter(F.col("word").isin(words)).groupBy("word").count().collect()}


def _all_in(stretches: str, block: Column) -> Column:
    text = F.concat(F.lit(" "), F.array_join(block, " "), F.lit(" "))
    return F.forall(stretches, lambda m: F.contains(text, m))


def _verified(table: DataFrame, postings: list[tuple]) -> DataFrame:
    """(key, label, base, start, containment) of the places whose blocks meet a template; ``start`` of the first such block."""
    spark = table.sparkSession
    rows = spark.createDataFrame(
        postings,
        "word string, template string, label string, base boolean, rest array<string>, t_size int, needed int, width int, stretches array<string>",
    )
    words = sorted({p[0] for p in postings})
    # a piece's words with `before` others in front; a place's surroundings are cut from it
    pieces = table.select("key", F.explode("pieces").alias("piece")).select("key", "piece.*")
    places = F.filter(
        F.transform("words", lambda w, i: F.struct(w.alias("word"), i.alias("i"))),
        lambda x: (x["i"] >= F.col("before")) & (x["i"] < F.col("before") + PIECE) & x["word"].isin(words),
    )
    probe = pieces.select("key", "at", "before", "words", F.explode(places).alias("x")).select("key", "at", "before", "words", "x.*")
    # the templates are parameters of the scan, so the broadcast table is as small as their list
    joined = probe.join(F.broadcast(rows), "word")
    low = F.greatest(F.lit(0), F.col("i") - F.col("width") + 1)
    near = joined.withColumn("low", low).withColumn("near", F.slice("words", F.col("low") + 1, F.col("i") - F.col("low") + F.col("width")))
    able = near.filter((F.size(F.array_intersect("rest", "near")) >= F.col("needed")) & _all_in("stretches", F.col("near")))
    # every block with the place in it, the word's first one there; fewer words than a block at a document's ends are one as well
    blocks = F.transform(F.sequence(F.lit(0), F.col("i") - F.col("low")), lambda s: F.struct(s.alias("s"), F.slice("near", s + 1, F.col("width")).alias("block")))
    blocks = F.filter(
        blocks,
        lambda b: (F.array_position(b["block"], F.col("word")) == F.col("i") - F.col("low") - b["s"] + 1)
        & (F.size(F.array_intersect(F.col("rest"), b["block"])) >= F.col("needed"))
        & _all_in("stretches", b["block"]),
    )
    met = able.withColumn("met", blocks).filter(F.size("met") > 0)
    best = F.array_max(F.transform("met", lambda b: F.size(F.array_intersect(F.col("rest"), b["block"]))))
    start = F.col("at") - F.col("before") + F.col("low") + F.col("met")[0]["s"]
    return met.select("key", "label", "base", start.cast("long").alias("start"), (best / F.col("t_size")).alias("containment"))


def scan(
    docs: DataFrame,
    phrases: dict[str, str] = PHRASES,
    notices: dict[str, str] = NOTICES,
    share: float = NOTICE_SHARE,
    text_col: str = "text",
    must: dict[str, str] = MUST,
) -> DataFrame:
    """``docs`` with n_words, n_base, first_word, last_word, base_labels, labels and score.

    Null and empty texts have no words and no labels. Repeated rows are scanned each by itself. An empty table gives
    an empty result. Result columns replace input columns of the same name. score is the highest containment of a
    template that was found, 1 for a base phrase, else 0. Long texts are cut to pieces, and places are counted by partial sums.
    """
    results = {"n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"}
    kept = [c for c in docs.columns if c.lower() not in results and c != text_col]
    templates = _templates(phrases, notices, must, share)
    reach = max(t[5] for t in templates) - 1
    postings = _postings(templates, _frequencies(docs, sorted({w for t in templates for w in t[3]}), text_col))
    prefix = sorted({p[0] for p in postings})
    text = F.coalesce(column(text_col), F.lit(""))
    words, = free_names(docs, "_words")

    # only texts with a word of some prefix are taken apart; their other pieces are left out at once
    able = text.rlike(f"(?i)(?<!{_LETTERS})({'|'.join(prefix)})(?!{_LETTERS})")
    carried = [f"_c{i}" for i in range(len(kept))]
    rows = docs.select(
        *(column(a).alias(b) for a, b in zip(kept, carried)),
        F.regexp_count(text, F.lit(f"{_LETTERS}+")).cast("long").alias("n_words"),
        F.when(able, F.array_remove(F.split(lower_ascii(text), SEPARATORS), "")).alias(words),
    )
    size = F.size(words)

    def piece(at: Column) -> Column:
        first = F.greatest(F.lit(0), at - reach)
        return F.struct(
            at.alias("at"), (at - first).alias("before"), F.slice(words, first + 1, at - first + PIECE + reach).alias("words"),
            F.slice(words, at + 1, PIECE).alias("own"),
        )

    cut = F.filter(F.transform(F.sequence(F.lit(0), size - 1, F.lit(PIECE)), piece), lambda p: F.arrays_overlap(p["own"], _array(prefix)))
    cut = F.transform(cut, lambda p: F.struct(p["at"].alias("at"), p["before"].alias("before"), p["words"].alias("words")))
    table = checkpointed(
        rows.select(*carried, "n_words", F.monotonically_increasing_id().alias("key"), F.when(size > 0, cut).alias("pieces"))
    )
    met = _verified(table.filter(F.size("pieces") > 0), postings)
    base = F.col("base")
    found = met.groupBy("key").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"),
        F.collect_set(F.when(base, F.col("label"))).alias("base"),
        F.collect_set("label").alias("all"),
        F.max("containment").alias("best"),
    )
    none = F.array().cast("array<string>")
    return table.join(found, "key", "left").select(
        *(F.col(b).alias(a) for a, b in zip(kept, carried)),
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.array_join(F.array_sort(F.coalesce("base", none)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.coalesce("all", none)), ",").alias("labels"),
        F.coalesce("best", F.lit(0.0)).alias("score"),
    )


def op8(spark, sf_dir) -> DataFrame:
    columns = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    return scan(documents(spark, sf_dir).select("doc_id", "text")).select(*columns)


def _sql() -> str:
    """The same rows without prefixes: every block around every place of a notice's first stretch."""
    split = r"list_filter(regexp_split_to_array(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"
    rows = [(t, label, MUST[label].split(","), math.ceil(BLOCK * len(t.split()))) for t, label in NOTICES.items()]
    notices = ", ".join(f"('{t}', '{label}', {must}, {width})" for t, label, must, width in rows)
    phrases = ", ".join(f"('{t}', '{label}')" for t, label in PHRASES.items())
    return f"""
WITH worded AS (SELECT row_number() OVER () AS k, doc_id, {split.format("coalesce(text, '')")} AS words FROM documents),
notices AS (
  SELECT list_distinct(string_split(t, ' ')) AS words, label, must, width, string_split(must[1], ' ') AS lead
  FROM (VALUES {notices}) x(t, label, must, width)),
phrases AS (SELECT string_split(t, ' ') AS words, label FROM (VALUES {phrases}) x(t, label)),
leads AS (SELECT DISTINCT lead[1] AS w FROM notices UNION SELECT words[1] FROM phrases),
placed AS (
  SELECT k, i, list_slice(words, i + 1, i + 9) AS ahead FROM (SELECT k, words, unnest(range(len(words))) AS i FROM worded)
  WHERE words[i + 1] IN (SELECT w FROM leads)),
starts AS (
  SELECT DISTINCT p.k, n.label, unnest(range(greatest(0, p.i + len(n.lead) - n.width), p.i + 1)) AS s
  FROM placed p JOIN notices n ON list_slice(p.ahead, 1, len(n.lead)) = n.lead),
blocks AS (
  SELECT k, label, n.words AS wanted, must, list_slice(w.words, s + 1, s + width) AS block
  FROM starts JOIN notices n USING (label) JOIN worded w USING (k)),
noticed AS (
  SELECT k, label, max(CAST(len(list_intersect(wanted, block)) AS DOUBLE) / len(wanted)) AS share FROM blocks
  WHERE len(list_intersect(wanted, block)) >= ceil(len(wanted) * {NOTICE_SHARE} - 1e-9)
    AND len(list_filter(must, lambda m: contains(' ' || array_to_string(block, ' ') || ' ', ' ' || m || ' '))) = len(must)
  GROUP BY k, label),
based AS (SELECT k, i, label FROM placed p JOIN phrases f ON list_slice(p.ahead, 1, len(f.words)) = f.words),
base AS (
  SELECT k, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list_sort(list(DISTINCT label)) AS labels FROM based GROUP BY k),
extra AS (SELECT k, list(DISTINCT label) AS labels, max(share) AS best FROM noticed GROUP BY k)
SELECT w.doc_id, CAST(len(w.words) AS BIGINT) AS n_words, coalesce(b.n_base, 0) AS n_base, b.first_word, b.last_word,
  coalesce(array_to_string(b.labels, ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(e.labels, [])))), ','), '') AS labels,
  CASE WHEN b.n_base > 0 THEN 1e0 ELSE coalesce(e.best, 0e0) END AS score
FROM worded w LEFT JOIN base b ON w.k = b.k LEFT JOIN extra e ON w.k = e.k
"""


SQL = _sql()
