"""BPE by a tokenization automaton.

The automaton reads tokens, and accepts exactly the token sequences that the merges give. It
starts as one state with an arc to itself for every byte. Each merge a b adds a gadget, in order of rank: the state that
arcs labelled a lead to loses its arc labelled b (after it is split from a state that other tokens lead to as
well), and wherever a then b could be read, one arc labelled ab leads to where b led. Every prefix of a word has exactly one accepted
path, so a pre-split word is encoded from left to right: at each place the longest token whose arc leaves the state,
back to a shorter one where a path ends before the word does. Decoding emits the bytes on the arcs.

Arcs are kept by what is absent: ``cut`` has the rank at which a state lost an arc directly, ``parent`` the state it was split
from and when, ``left`` a token's first part and its rank; an arc made by a merge exists where its first part's arc did at that rank.
"""

from __future__ import annotations

import hashlib
import json
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from tilelake.llm.common import documents

#: The pre-tokenizer's pattern (fixed by the vocabulary file's kind). White space is Unicode's White_Space.
_SPACE = r"\t-\r \x85\xa0  -     　"
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + _SPACE + r"\p{L}\p{N}]+|[" + _SPACE + r"]+(?![^" + _SPACE + r"])|[" + _SPACE + r"]+"
)
#: Words whose ids a task keeps, and pairs of state and token whose arcs it keeps; both start anew when full.
KEPT_WORDS, KEPT_ARCS, LONGEST_KEPT = 300_000, 500_000, 64
_START, _NEVER = 0, 1 << 60


def _byte_of() -> dict[str, int]:
    """The printable stand-ins of a byte-level vocabulary: printable Latin-1 for itself, the rest from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Automaton:
    """Compiled tables; picklable, a few MB, bounded by the vocabulary."""

    def __init__(self, vocabulary: str):
        model = json.loads(vocabulary)
        byte_of = _byte_of()
        text = lambda token: bytes(byte_of[c] for c in token)
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        ids = {token: i for token, i in model["model"]["vocab"].items() if token not in self.special}
        self.id_of = {text(token): i for token, i in ids.items()}
        self.bytes_of = {i: b for b, i in self.id_of.items()} | {i: s.encode() for s, i in self.special.items()}
        self.longest = max(map(len, self.id_of))
        target, entering = {}, {_START: 0}  # token -> state its arcs lead to; state -> tokens that lead there
        self.left: dict[int, tuple[int, int]] = {}
        self.cut: dict[tuple[int, int], int] = {}
        self.parent: dict[int, tuple[int, int]] = {}
        for token, i in ids.items():
            if len(token) == 1:
                target[i] = _START
                entering[_START] += 1
        entering[_START] += 1  # the start itself: no arc of it is ever lost
        for rank, merge in enumerate(model["model"]["merges"]):
            first, second = merge if isinstance(merge, list) else merge.split(" ")
            a, b, ab = ids[first], ids[second], ids[first + second]
            state = target[a]
            if not self.leaves(state, b):  # earlier merges never leave a before b, so this one never applies
                del self.id_of[text(first + second)]
                target[ab] = _START
                continue
            # ab leads to where b led before the gadget, also if a and b are the same token
            target[ab] = target[b]
            entering[target[b]] += 1
            self.left[ab] = (a, rank)
            if entering[state] > 1:
                entering[state] -= 1
                new = len(entering)
                entering[new] = 1
                self.parent[new] = (state, rank)
                target[a] = state = new
            self.cut[state, b] = rank
        self.target = target

    def _lost(self, state: int, token: int) -> int:
        """The rank at which ``state`` lost its arc for ``token``, or _NEVER."""
        until = _NEVER
        while True:
            rank = self.cut.get((state, token))
            if rank is not None and rank < until:
                break
            up = self.parent.get(state)
            if up is None:
                rank = _NEVER
                break
            state, born = up
            until = min(until, born)
        return rank

    def leaves(self, state: int, token: int) -> bool:
        """Whether an arc for ``token`` leaves ``state``."""
        before = _NEVER - 1
        while True:
            # a merge a a also takes the arc aa from the state after a: of a a a the first two merge
            if self._lost(state, token) <= before:
                return False
            if token not in self.left:
                return True
            token, before = self.left[token]


class Codec:
    """Encoding and decoding with tables of recent words and arcs."""

    def __init__(self, automaton: Automaton):
        self.automaton = automaton
        self.words: dict[str, tuple[int, ...]] = {}
        self.arcs: dict[int, bool] = {}
        self.find = regex.compile(PATTERN).findall
        names = sorted(automaton.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, names)) + ")").split if names else lambda text: [text]

    def encode_word(self, word: bytes) -> tuple[int, ...]:
        """Token ids of one pre-split word: its one accepted path, longest tokens tried first."""
        a, arcs, n = self.automaton, self.arcs, len(word)
        find, target, longest = a.id_of.get, a.target, a.longest
        place, state, length = 0, _START, min(longest, n)
        out, taken, dead = [], [], set()
        while place < n:
            while length:
                token = find(word[place : place + length])
                if token is not None:
                    if state == _START:
                        able = True
                    else:
                        key = state << 20 | token
                        able = arcs.get(key)
                        if able is None:
                            if len(arcs) >= KEPT_ARCS:
                                arcs.clear()
                            able = arcs[key] = a.leaves(state, token)
                    if able and not (dead and (place + length, target[token]) in dead):
                        break
                length -= 1
            if length:
                taken.append((place, state, length))
                out.append(token)
                place, state = place + length, target[token]
                length = min(longest, n - place)
            else:
                dead.add((place, state))
                place, state, length = taken.pop()
                out.pop()
                length -= 1
        return tuple(out)

    def _encode_plain(self, text: str, out: array) -> None:
        words = self.words
        for word in self.find(text):
            ids = words.get(word)
            if ids is None:
                ids = self.encode_word(word.encode("utf-8"))
                if len(word) <= LONGEST_KEPT:
                    if len(words) >= KEPT_WORDS:
                        words.clear()
                    words[word] = ids
            out.extend(ids)

    def encode(self, text: str) -> array:
        """Token ids of a text; special tokens' strings become their tokens."""
        out = array("I")
        for i, part in enumerate(self.cut(text)):
            if i % 2:
                out.append(self.automaton.special[part])
            elif part:
                self._encode_plain(part, out)
        return out

    def decode(self, ids: array) -> str:
        return b"".join(map(self.automaton.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def compile_vocabulary(path: str) -> Automaton:
    with open(path, encoding="utf-8") as file:
        return Automaton(file.read())


@lru_cache(maxsize=1)
def _compiled(path: str) -> Automaton:
    return compile_vocabulary(path)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encode(docs: DataFrame, path: str | None = None, text_col: str = "text", digests: bool = False) -> DataFrame:
    """``docs`` without its text, with n_tokens and ids, or with the digests of ids and decoded text.

    Null and empty texts give no tokens. Every row is encoded by itself, so repeated rows give
    repeated results; other columns are passed on, but result columns replace those of the same name. Very long texts need memory
    in proportion to their own length. The vocabulary is read by the driver and the compiled tables are broadcast.
    """
    spark: SparkSession = docs.sparkSession
    results = {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"} if digests else {"n_tokens": "long", "ids": "array<int>"}
    kept = [c for c in docs.columns if c != text_col and c.lower() not in results]
    tables = spark.sparkContext.broadcast(_compiled(path or default_vocabulary()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(tables.value)
        for batch in batches:
            found = {n: [] for n in results}
            flat, ends = array("I"), [0]
            for text in batch.column(len(kept)):
                ids = codec.encode(text.as_py() or "")
                found["n_tokens"].append(len(ids))
                if digests:
                    packed = ids.tobytes() if array("I").itemsize == 4 and struct.pack("=I", 1) == struct.pack("<I", 1) else struct.pack(f"<{len(ids)}I", *ids)
                    found["ids_sha256"].append(hashlib.sha256(packed).hexdigest())
                    found["decoded_sha256"].append(hashlib.sha256(codec.decode(ids).encode("utf-8")).hexdigest())
                else:
                    flat.extend(ids)
                    ends.append(len(flat))
            columns = [pa.array(v, pa.int64() if n == "n_tokens" else pa.string()) for n, v in found.items() if n != "ids"]
            if not digests:
                columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32())))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *columns], names=[*kept, *results])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)
    schema = ", ".join([*([fields] if fields else []), *(f"{n} {t}" for n, t in results.items())])
    return docs.select(*kept, text_col).mapInArrow(run, schema)


def op6(spark, sf_dir) -> DataFrame:
    return encode(documents(spark, sf_dir).select("doc_id", "text"), digests=True)
