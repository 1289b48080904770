"""Small documents with the cases every operator must handle."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, Size string, `key` string"
_WORDS = "the of and to in is that for was on thea ander erst inge tion ouer lich keit pour les des".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(_WORDS) + rng.choice(["", "", "s", "ed", "."]) for _ in range(n))


def rows() -> list[tuple]:
    """Nulls in every column, empty and long texts, exact and near copies, repeated rows, clashing names."""
    long = prose(1, 4000)
    near = prose(2, 400)
    texts = [prose(i, 20 + 7 * i) for i in range(40)] + [
        None, "", " \t\n", long, long, near, near.replace(" of ", " off ", 1), "x" * 5000, "Äöü ß 日本 😀 a b",
        "the mit LICENSE here", "call +1 284 555 2485 or mail a.b@c.example.org, 70.123.182.155",
    ]
    out = [(i, t, "en" if i % 3 else None, f"s{i % 4}" if i % 7 else None, i if i % 5 else None, "x", None, "k") for i, t in enumerate(texts)]
    out += [out[3], out[3], (None, "the null id text of the row", None, None, None, None, None, None)]
    return out


def frame(spark, given=None):
    return spark.createDataFrame(rows() if given is None else given, SCHEMA)


def bag(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)
