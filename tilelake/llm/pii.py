"""Personal data: base patterns, and a character-level BiLSTM-CRF that adds spans.

The model is trained in the driver from spans that the base patterns label in a bounded sample of windows (distinct
ones, as many of each kind, and as many without a span), and from rewritten forms of these spans that the patterns miss. Whole texts are then read in overlapping windows; each character takes its tag from the window
in whose middle it stands most, and spans are read from the joined tags. Windows without a cue (a digit of any script, an @,
an "at" in brackets or a "dot" written out) hold no span of any kind and are not computed.

The rewritten forms carry made-up users, hosts, digits and lengths besides those of the table, so that the model learns the
shape of a span and not the values it was shown.
"""

from __future__ import annotations

import hashlib
import random
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructType

from tilelake.llm import lstm_crf
from tilelake.llm.common import column, documents, partitions

KINDS = ("email", "ip", "card", "phone")
NONE = len(KINDS)
#: Characters of a window and between windows; windows computed at a time; windows of the training sample.
WIDTH, STRIDE, AT_ONCE, SAMPLE = 64, 32, 512, 1200
#: Of the sample, the part of each kind and of windows without a span; characters before and after a sampled place; tasks of the last round that merges samples.
SHARE, BEFORE, AFTER, MERGERS = SAMPLE // (len(KINDS) + 1), 3 * STRIDE, 2 * STRIDE, 8
#: Training windows of each kind, and of those without a span: addresses have the most forms.
SHOWN = (2400, 600, 600, 900, 300)
#: Steps of the training.
ROUNDS = 700
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# greedy digits end a match at the end of their run, so a match can start at the start of a run only
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SIGN = re.compile(r"[0-9@]")
# what a span that the model may find holds at least: see _cloaked()
_CUE = re.compile(r"[\d@]|\bdot\b|[\[({]at[\])}]", re.IGNORECASE)
_AT = re.compile(r"@|[\[({]at[\])}]|\sat\s", re.IGNORECASE)
_DOT = re.compile(r"\.|\bdot\b", re.IGNORECASE)
_NOT_DIGIT = re.compile(r"[^0-9]+")


def _luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2]) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        host = _HOST.match(text, at) if start < at else None
        if host:
            yield start, host.end()
            done = host.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of every match of the base patterns, by kind and start."""
    if not _SIGN.search(text):
        return []
    found = [(0, a, b) for a, b in _emails(text)]
    found += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group())
        if 16 <= len(digits) <= 19 and _luhn(digits):
            found.append((2, m.start(), m.end()))
    found += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_NOT_DIGIT.sub("", m.group())) <= 15]
    return found


# --- the model ---------------------------------------------------------------------

_TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind


def _barred() -> np.ndarray:
    """Moves that no tag path takes: to an inside tag from anything but its own begin or inside."""
    out = np.zeros((_TAGS, _TAGS), bool)
    for kind in range(len(KINDS)):
        begin, inside = 1 + 2 * kind, 2 + 2 * kind
        out[:, inside] = True
        out[[begin, inside], inside] = False
    return out


def _plain_digits(text: str) -> str:
    """``text`` with the digits of other scripts as ASCII ones."""
    return text if text.isascii() else "".join(str(unicodedata.decimal(c)) if c.isdecimal() else c for c in text)


def _symbols(text: str) -> np.ndarray:
    """One symbol a character: ASCII as it is but digits and letters' case told apart by class, others by kind."""
    codes = np.frombuffer(_plain_digits(text).encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.where(codes < 128, codes, 128).astype(np.int64)
    out[(codes >= 48) & (codes <= 57)] = 48
    upper = (codes >= 65) & (codes <= 90)
    out[upper] = 65
    return out


_N_SYMBOLS = 130  # 129 fills the last window


_LETTERS = "abcdefghijklmnopqrstuvwxyz"


def _name(rng: random.Random, least: int, most: int) -> str:
    """Letters, or vowels and consonants in turn, some with digits behind them or a capital."""
    size, sets = rng.randint(least, most), rng.choice([(_LETTERS, _LETTERS), ("bcdfghklmnprstvw", "aeiou")])
    name = "".join(rng.choice(sets[i % 2]) for i in range(size))
    name = name.capitalize() if rng.random() < 0.15 else name
    return name + (str(rng.randrange(10 ** rng.randint(1, 4))) if rng.random() < 0.25 else "")


def _address(rng: random.Random) -> str:
    """A made-up mail address of any common shape."""
    user = rng.choice(["", ".", "_", "-"]).join(_name(rng, 1, 9) for _ in range(rng.randint(1, 2)))
    host = [rng.choice(["", "-"]).join(_name(rng, 1, 10) for _ in range(rng.choice((1, 1, 1, 2)))) for _ in range(rng.choice((1, 1, 1, 2, 2, 3)))]
    return f"{user}@{'.'.join(host)}.{''.join(rng.choice(_LETTERS) for _ in range(rng.choice((2, 2, 3, 3, 3, 4, 5))))}"


def _cloaked(rng: random.Random, address: str) -> str:
    """An address with its @ or dots parted, bracketed or written out."""
    user, host = address.split("@")
    how = rng.randrange(9)
    if how < 3:
        return user + rng.choice([" @ ", "(@)", "[@]", " (@) ", "@ ", " @"]) + host
    if how < 5:
        return address.replace(".", " . ") if how == 3 else f"{user} @ {host.replace('.', ' . ')}"
    opened, closed = rng.choice(["[]", "()", "{}"])
    space = rng.choice(["", " "])
    at, dot = (f"{space}{opened}{w}{closed}{space}" for w in ("at", "dot"))
    if how == 5:
        return user + at + host
    if how == 6:
        return user + at + host.replace(".", dot)
    if how == 7:
        return f"{user} at {host.replace('.', ' dot ')}"
    return user.replace(".", " dot ") + " at " + host.replace(".", " dot ")


def _rewritten(rng: random.Random, kind: int, span: str) -> str:
    """A form of a span that people use to hide it, or to write it another way; most carry another value."""
    new = rng.random() < 0.75
    if kind == 0:
        address = _address(rng) if new else span
        return address if rng.random() < 0.12 else _cloaked(rng, address)
    if kind == 1:
        address = ".".join(str(rng.randrange(10 ** rng.randint(1, 3)) % 256) for _ in range(4)) if new else span
        return address.replace(".", rng.choice([".", " . ", "-", ". ", " - ", "[.]"]))
    digits = _NOT_DIGIT.sub("", span)
    if kind == 2:
        if new:
            digits = rng.choice("3456") + "".join(rng.choice("0123456789") for _ in range(rng.choice((14, 14, 14, 15, 16, 17))))
            digits += next(d for d in "0123456789" if _luhn(digits + d))
        return rng.choice([".", "  ", " ", "-", " - ", ""]).join(digits[i : i + 4] for i in range(0, len(digits), 4))
    if new:
        digits = str(rng.randrange(1, 99)) + "".join(rng.choice("0123456789") for _ in range(rng.choice((9, 10, 10, 10))))
    part = rng.choice(["-", " ", "."])
    return rng.choice([f"+{digits[:-9]} {digits[-9:-6]} {digits[-6:-3]} {digits[-3:]}", "00" + digits[:-9] + f" {digits[-9:-6]} {digits[-6:]}",
        f"00{digits[:-9]}{part}{digits[-9:-6]}{part}{digits[-6:-3]}{part}{digits[-3:]}", f"({digits[-10:-7]}) {digits[-7:-4]}{part}{digits[-4:]}",
        f"{digits[-10:-7]}{part}{digits[-7:-4]}{part}{digits[-4:]}"])


def _labelled(text: str) -> Iterator[tuple[int, str, int, str]]:
    """(kind, window, place in it, spans in it) of every base span, and as kind NONE of places with a sign but no span near."""
    spans: list[tuple[int, int, int]] = []
    for a, b, kind in sorted((a, b, k) for k, a, b in base_spans(text)):
        if not spans or a >= spans[-1][1]:
            spans.append((a, b, kind))
    for i, (a, b, kind) in enumerate(spans):
        start, end = max(0, a - BEFORE), min(len(text), a + BEFORE + AFTER, max(a + AFTER, b))
        first = last = i
        while first and spans[first - 1][0] >= start:
            first -= 1
        while last + 1 < len(spans) and spans[last + 1][1] <= end:
            last += 1
        # no other span is cut at an edge
        start = max(start, spans[first - 1][1]) if first else start
        end = min(end, spans[last + 1][0]) if last + 1 < len(spans) else end
        inside = ",".join(f"{x - start}:{min(y, end) - start}:{k}" for x, y, k in spans[first : last + 1])
        yield kind, text[start:end], a - start, inside
    at = i = 0
    while sign := _CUE.search(text, at):
        place = sign.start()
        while i < len(spans) and spans[i][1] <= place - BEFORE:
            i += 1
        if i < len(spans) and spans[i][0] < place + AFTER:
            at = max(place + 1, spans[i][1])
        else:
            start = max(0, place - BEFORE)
            yield NONE, text[start : place + AFTER], place - start, ""
            at = place + AFTER


def _least(rows: Iterable[tuple]) -> list[tuple]:
    """Of rows (kind, hash, window, place, spans) the distinct windows of least hash, at most SHARE of a kind."""
    found: dict[int, dict[str, tuple]] = {}
    bound: dict[int, int] = {}
    cut = lambda mine: sorted(mine.values())[:SHARE]
    for row in rows:
        kind, h, window = row[:3]
        if h > bound.get(kind, h):
            continue
        mine = found.setdefault(kind, {})
        mine[window] = min(row, mine.get(window, row))
        if len(mine) > 4 * SHARE:
            kept = cut(mine)
            found[kind], bound[kind] = {r[2]: r for r in kept}, kept[-1][1]
    return [r for kind in sorted(found) for r in cut(found[kind])]


def _sample(docs: DataFrame, text_col: str) -> list[tuple]:
    """Distinct windows around base spans, and some without any, those of least hash over all documents: SHARE a kind at most.

    Tasks pass on no more than the sample's size each; as such samples merge in any order, they are merged in rounds, each by a
    sixteenth of the tasks of the round before, so that no task reads more than some samples however many tasks there are.
    """
    types = (pa.int32(), pa.int64(), pa.string(), pa.int32(), pa.string())

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [[]] * len(types)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["kind", "h", "w", "place", "spans"])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = (value.as_py() or "" for batch in batches for value in batch.column(0))
        found = (x for text in texts for x in _labelled(text))
        yield batch_of(_least((k, xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) >> 1, w, at, s) for k, w, at, s in found))

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield batch_of(_least(row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns))))

    schema = "kind int, h long, w string, place int, spans string"
    found, tasks = docs.select(column(text_col).alias("text")).mapInArrow(windows, schema), max(MERGERS, partitions(docs.sparkSession))
    while True:
        found = found.repartition(tasks).mapInArrow(merged, schema)
        if tasks <= MERGERS:
            return _least(map(tuple, found.collect()))
        tasks = max(MERGERS, tasks // 16)


def train_model(sample: list[tuple], rounds: int = ROUNDS) -> dict | None:
    """A model from rows of _sample(); None without any. Kinds are shown by SHOWN, however often the table has them, each time written anew."""
    if not sample:
        return None
    rng, symbols, tags = random.Random(7), [], []
    strata: dict[int, list[tuple]] = {}
    for row in sample:
        strata.setdefault(row[0], []).append(row)
    for _, _, text, place, inside in (rows[i % len(rows)] for kind, rows in strata.items() for i in range(SHOWN[kind])):
        pieces, marks, at, focus = [], [], 0, place
        for a, b, kind in (map(int, s.split(":")) for s in inside.split(",") if s):
            span = _rewritten(rng, kind, text[a:b])
            # brackets and marks beside a span are not of it
            before, after = rng.choice([("", "")] * 4 + [("", "."), ("", ","), ("(", ")"), ("<", ">"), (": ", ";")])
            pieces += [text[at:a], before, span, after]
            marks += [0] * (a - at + len(before))
            if a == place:
                focus = len(marks)
            marks += [1 + 2 * kind] + [2 + 2 * kind] * (len(span) - 1) + [0] * len(after)
            at = b
        whole = "".join(pieces) + text[at:]
        marks += [0] * (len(whole) - len(marks))
        start = max(0, focus - rng.randrange(WIDTH // 2))
        part = _symbols(whole[start : start + WIDTH])
        symbols.append(np.pad(part, (0, WIDTH - len(part)), constant_values=_N_SYMBOLS - 1))
        tags.append(np.pad(np.array(marks[start : start + WIDTH], np.int64), (0, WIDTH - len(part))))
    return lstm_crf.train(np.stack(symbols), np.stack(tags), _N_SYMBOLS, _barred(), rounds)


def _plausible(kind: int, span: str) -> bool:
    """A last check of what the model found."""
    span = _plain_digits(span)
    digits = _NOT_DIGIT.sub("", span)
    if kind == 0:
        return bool(_AT.search(span, 1)) and bool(_DOT.search(span))
    if kind == 1:
        parts = [p for p in _NOT_DIGIT.split(span) if p]
        return len(parts) == 4 and all(int(p) <= 255 for p in parts if len(p) < 4) and all(len(p) < 4 for p in parts)
    if re.search("[^0-9 ().+-]", span):
        return False
    return 16 <= len(digits) <= 19 and _luhn(digits) if kind == 2 else 8 <= len(digits) <= 15 and len(digits) < len(span)


def _windows_of(text: str) -> list[int]:
    """Starts of the windows in which a cue begins."""
    last = max(0, -(-(len(text) - WIDTH) // STRIDE))
    wanted: set[int] = set()
    for m in _CUE.finditer(text):
        i = m.start() // STRIDE
        near = (i - 1, i) if m.group().isdecimal() else (i - 2, i - 1, i, i + 1)  # an address goes on to both sides of its cue
        wanted.update(j for j in near if 0 <= j <= last)
        if i > last:
            wanted.add(last)
    return [j * STRIDE for j in sorted(wanted)]


def model_spans(model: dict, texts: list[str]) -> list[list[tuple[int, int, int]]]:
    """Spans of each text as the model tells them, windows of all texts computed together."""
    places = [(n, start) for n, text in enumerate(texts) for start in _windows_of(text)]
    # tag and how far inside its window each character of a window stands, joined text by text
    joined: list[dict[int, tuple[int, int]]] = [{} for _ in texts]
    for i in range(0, len(places), AT_ONCE):
        some = places[i : i + AT_ONCE]
        symbols = np.full((len(some), WIDTH), _N_SYMBOLS - 1, np.int64)
        for row, (n, start) in enumerate(some):
            part = _symbols(texts[n][start : start + WIDTH])
            symbols[row, : len(part)] = part
        for (n, start), tags in zip(some, lstm_crf.decode(model, symbols)):
            length = len(texts[n])
            for t in np.flatnonzero(tags | (np.abs(np.arange(WIDTH) - WIDTH / 2 + 0.5) < STRIDE)):
                depth = min(int(t) if start else WIDTH, WIDTH - 1 - int(t) if start + WIDTH < length else WIDTH)
                at = start + int(t)
                if at < length and depth > joined[n].get(at, (0, -1))[1]:
                    joined[n][at] = (int(tags[t]), depth)
    out = []
    for text, tagged in zip(texts, joined):
        spans, kind, first, last = [], -1, 0, -2
        for at in sorted(tagged):
            tag = tagged[at][0]
            own = (tag - 1) // 2 if tag else -1
            if kind >= 0 and (own != kind or at != last + 1 or tag % 2):
                spans.append((kind, first, last + 1))
                kind = -1
            if own >= 0:
                if kind < 0:
                    kind, first = own, at
                last = at
        if kind >= 0:
            spans.append((kind, first, last + 1))
        trimmed = ((k, a + len(text[a:b]) - len(text[a:b].lstrip()), b - len(text[a:b]) + len(text[a:b].rstrip())) for k, a, b in spans)
        out.append([(k, a, b) for k, a, b in trimmed if a < b and _plausible(k, text[a:b])])
    return out


def all_spans(texts: list[str], model: dict | None) -> list[tuple[list, list]]:
    """Base spans, and all spans, of each text: the model adds those that overlap no base span."""
    bases = [base_spans(t) for t in texts]
    more = model_spans(model, texts) if model else [[] for _ in texts]
    out = []
    for base, extra in zip(bases, more):
        free, edges = [], sorted((a, b) for _, a, b in base)
        for kind, a, b in extra:
            if not any(x < b and a < y for x, y in edges):
                free.append((kind, a, b))
        out.append((base, sorted([*base, *free])))
    return out


def _joined(spans: list) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def redacted(text: str, spans: list) -> str:
    """``text`` with each span replaced by its kind in angle brackets; overlapping spans become one."""
    pieces, at = [], 0
    for a, b, kind in sorted((a, b, k) for k, a, b in spans):
        if a >= at:
            pieces += [text[at:a], f"<{KINDS[kind].upper()}>"]
        at = max(at, b)
    return "".join(pieces) + text[at:]


def find(docs: DataFrame, text_col: str = "text", redact: bool = False, rounds: int = ROUNDS) -> DataFrame:
    """``docs`` with n_email, n_ip, n_card, n_phone and base_sha256 of the base spans, and all spans.

    Without ``redact`` the text is left out; with it, text has its spans replaced and n_chars is
    its new length. Null and empty texts have no spans (a null text stays null when redacting). Rows
    are read each by itself, repeated rows alike; other columns are passed on and result columns replace those of the same name. Without
    any cue in the table there is no model and nothing to find.
    """
    results = {**{f"n_{k}": pa.int64() for k in KINDS}, "base_sha256": pa.string(), "spans": pa.string()}
    kept = [c for c in docs.columns if c.lower() not in results and c != text_col and not (redact and c.lower() == "n_chars")]
    model = docs.sparkSession.sparkContext.broadcast(train_model(_sample(docs, text_col), rounds))
    names = [*kept, *([text_col, "n_chars"] if redact else []), *results]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                given = batch.column(len(kept)).to_pylist()
                spans = all_spans([t or "" for t in given], model.value)
                columns = list(batch.columns[: len(kept)])
                if redact:
                    clean = [t if t is None else redacted(t, s) for t, (_, s) in zip(given, spans)]
                    columns += [pa.array(clean, pa.string()), pa.array([None if t is None else len(t) for t in clean], pa.int64())]
                columns += [pa.array([sum(s[0] == k for s in base) for base, _ in spans], pa.int64()) for k in range(len(KINDS))]
                columns.append(pa.array([hashlib.sha256(_joined(base).encode()).hexdigest() for base, _ in spans], pa.string()))
                columns.append(pa.array([_joined(every) for _, every in spans], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = StructType([docs.schema[c] for c in kept])
    if redact:
        schema = schema.add(text_col, StringType()).add("n_chars", LongType())
    for c, t in results.items():
        schema = schema.add(c, LongType() if t == pa.int64() else StringType())
    # plain names on the way in: mapInArrow reads a dot as a path
    return docs.select(*(column(c).alias(f"c{i}") for i, c in enumerate([*kept, text_col]))).mapInArrow(run, schema)


def op7(spark, sf_dir) -> DataFrame:
    return find(documents(spark, sf_dir).select("doc_id", "text"))
