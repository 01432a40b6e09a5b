"""Byte-level BPE encoding by speculation and verification, and decoding.

A text is cut into words by the tokenizer's pattern. For every word not met before,
greedy longest match proposes tokens. A proposal is the exact encoding if every adjacent
pair of tokens is compatible, that is if the two tokens' bytes together encode to just
these two tokens. All adjacent pairs of a batch are tested at once with array operations:
the pair is unwound along the tokens' last merges, and it is incompatible if at some
stage the touching parts would have merged earlier. Only the words with a failing pair
undergo exact merging by rank.

A task keeps the encodings of the pieces it met in a table of at most ``CACHE_PIECES``
entries that is cut back when full and emptied at its end: memory is bounded, results don't
depend on it. Texts are encoded whole; a very long text is worked off in slices of its
words. The vocabulary file (a path) is read by the driver and broadcast: its size is that
of a vocabulary, whatever the input.

Defined results: a null or empty text has no ids and decodes to the empty text. Text that
spells a special token gets that token's id. Repeated rows are encoded like any other, an
empty table gives an empty table, and the columns passed on are those of the input; an
input column named like an output column is replaced.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CACHE_PIECES = 1 << 19
LONG_PIECE = 1 << 10     # longer pieces are encoded anew each time
LONG_TEXT = 1 << 20      # characters; longer texts are cut into pieces step by step
SLICE = 1 << 16          # pieces of a step
OUT_BYTES = 4 << 20      # of a slice of a batch
WORD_BLOCK = 1 << 13     # distinct words encoded together: bounds the proposals held at a time

# The word pattern of the byte-level tokenizer, white space spelled out.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")

# White space other than the space and the line feed, and runs of those two.
UNPLAIN = ["  ", "\n\n", " \n", "\n ", *"\t\x0b\x0c\r"]
UNPLAIN_WIDE = [*"\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000", *map(chr, range(0x2000, 0x200B))]


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in the vocabulary file: printable Latin-1
    characters stand for themselves, the other bytes for code points from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Tokens, merges and special tokens of a tokenizer file (JSON)."""

    def __init__(self, data: bytes, encoder: bool = True):
        spec = json.loads(data)
        vocab, alphabet = spec["model"]["vocab"], byte_alphabet()
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.cache: dict[str, bytes] = {}
        as_bytes = {t: bytes(alphabet[c] for c in t) for t in vocab if t not in self.special}
        self.size = 1 + max([*vocab.values(), *self.special.values()])
        self.token_bytes = [b""] * self.size
        for t, b in as_bytes.items():
            self.token_bytes[vocab[t]] = b
        for t, i in self.special.items():
            self.token_bytes[i] = t.encode()
        if encoder:
            self._prepare(spec, vocab, as_bytes)

    def _prepare(self, spec: dict, vocab: dict[str, int], as_bytes: dict[str, bytes]) -> None:
        """What only encoding needs."""
        import ahocorasick
        import regex

        by_bytes = {b: vocab[t] for t, b in as_bytes.items()}
        self.single = np.array([by_bytes[bytes([b])] for b in range(256)], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        self.made = np.array([vocab[a + b] for a, b in merges], np.int64)
        # when a token comes to be (bytes before all merges) and the two halves it is made of
        self.order = np.full(self.size, -1, np.int64)
        self.order[self.made] = np.arange(len(merges))
        self.halves = np.stack([np.arange(self.size), np.arange(self.size)])
        self.halves[:, self.made] = np.stack([left, right])
        code = left * self.size + right
        self.pair_rank = np.argsort(code)
        self.pair_code = code[self.pair_rank]
        if len(set(self.made.tolist())) < len(merges) or (
                np.maximum(self.order[left], self.order[right]) >= np.arange(len(merges))).any():
            raise ValueError("a token must have one merge, and its halves must come before it")
        # tokens that their own bytes encode to; only these are proposed
        names = list(by_bytes)
        usable = [len(got) == 1 for got in self.merge(names)]
        self.match = ahocorasick.Automaton()
        for b, ok in zip(names, usable):
            if ok:
                self.match.add_word(b.decode("latin-1"), by_bytes[b])
        self.match.make_automaton()
        self.pattern = regex.compile(PATTERN)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def rank(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The number of the merge of x and y, or the number of merges if there is none."""
        code = x * self.size + y
        at = np.minimum(np.searchsorted(self.pair_code, code), len(self.pair_code) - 1)
        return np.where(self.pair_code[at] == code, self.pair_rank[at], len(self.pair_code))

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the bytes of tokens a and b, one after the other, encode to a and b.

        Each step looks at the token a' that ends the left and the token b' that starts the
        right at some stage of the merging, the latest stage first, and at the merge number
        up to which they touch. Had (a', b') merged before that, the pair would not be.
        Of merges of the same number the left one comes first.
        """
        a, b = a.copy(), b.copy()
        until = np.full(len(a), len(self.made))   # merges numbered below it happen while a', b' touch
        ok, live = np.ones(len(a), bool), np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            clash = self.rank(x, y) < until[live]
            ok[live[clash]] = False
            live, x, y = live[~clash], x[~clash], y[~clash]
            ox, oy = self.order[x], self.order[y]
            back = ox > oy      # the later of the two is taken apart
            until[live] = np.where(back, ox, oy + 1)
            a[live] = np.where(back, self.halves[1][x], x)
            b[live] = np.where(back, y, self.halves[0][y])
            live = live[np.maximum(ox, oy) >= 0]   # two bytes: nothing came before
        return ok

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """Exact encodings: in every word the pair of lowest rank merges, from the left, until none can."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ids = self.single[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), sizes)
        none = len(self.made)
        done: list = [None] * len(words)
        while len(ids):
            rank = np.full(len(ids), none)
            rank[:-1] = np.where(word[1:] == word[:-1], self.rank(ids[:-1], ids[1:]), none)
            starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            lengths = np.diff(np.append(starts, len(word)))
            least = np.minimum.reduceat(rank, starts)
            for w, at, n in zip(word[starts[least == none]].tolist(), starts[least == none].tolist(),
                                lengths[least == none].tolist()):
                done[w] = ids[at:at + n]
            hit = (rank == np.repeat(least, lengths)) & (rank < none)
            # of overlapping pairs (a a a) every other one, from the left
            run = np.flatnonzero(hit & ~np.concatenate(([False], hit[:-1])))
            at = np.flatnonzero(hit)
            at = at[(at - run[np.searchsorted(run, at, side="right") - 1]) % 2 == 0]
            ids[at] = self.made[rank[at]]
            stay = np.repeat(least < none, lengths)
            stay[at + 1] = False
            ids, word = ids[stay], word[stay]
        return [np.empty(0, np.int64) if d is None else d for d in done]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The ids (int32) of distinct words: proposals, the test of all adjacent pairs, merging where it fails."""
        raw = [w.encode() for w in words]
        found = list(self.match.iter_long("\u0100".join([b.decode("latin-1") for b in raw])))
        ends, ids = np.array(found, np.int64).reshape(-1, 2).T
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        last = np.cumsum(sizes + 1) - 2
        word = np.searchsorted(last, ends)
        touching = np.flatnonzero(word[1:] == word[:-1])
        pairs, inverse = np.unique(ids[touching] * self.size + ids[touching + 1], return_inverse=True)
        good = self.compatible(pairs // self.size, pairs % self.size)[inverse]
        failing = np.zeros(len(words), bool)
        failing[word[touching[~good]]] = True
        flat, first = ids.astype(np.int32), np.searchsorted(word, np.arange(len(words) + 1))
        out = [flat[a:b].tobytes() for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
        wrong = np.flatnonzero(failing).tolist()
        for k, exact in zip(wrong, self.merge([raw[k] for k in wrong])):
            out[k] = exact.astype(np.int32).tobytes()
        return out

    def encode_pieces(self, pieces: list[str]) -> dict[str, bytes]:
        """The ids of distinct pieces, see :meth:`pieces`."""
        parts = [(" " + p,) if p.isalpha() else   # letters alone are one word
                 self.pattern.findall(p[1:] if p[:1] == " " else p if p[:1] == "\n" else " " + p) for p in pieces]
        words = list(set(chain.from_iterable(parts)))
        known = {}
        for k in range(0, len(words), WORD_BLOCK):
            block = words[k:k + WORD_BLOCK]
            known.update(zip(block, self.encode_words(block)))
        return {p: known[w[0]] if len(w) == 1 else b"".join([known[x] for x in w]) for p, w in zip(pieces, parts)}

    def pieces(self, text: str) -> Iterator[list[str]]:
        """The text cut into pieces between which no word runs on, in order.

        A piece stands for itself after a space; one that starts with a line feed stands
        for itself, and one that starts with a space for what follows that space. In texts
        whose blanks are single spaces and line feeds every space starts a piece; other
        texts are cut into words by the pattern.
        """
        if not text:
            return
        if len(text) > LONG_TEXT:
            found = (" " + m.group() for m in self.pattern.finditer(text))
            while part := list(islice(found, SLICE)):
                yield part
        elif text[-1] == " " or any(x in text for x in UNPLAIN) or (
                not text.isascii() and any(x in text for x in UNPLAIN_WIDE)):
            yield [" " + w for w in self.pattern.findall(text)]
        else:
            part = text.replace("\n", " \n").split(" ")
            part[0] = " " + part[0]
            yield part

    def learn(self, pieces: Iterable[str]) -> dict[str, bytes]:
        """Encode the pieces not met before, all together; returns a table that has all of them."""
        distinct, cache = set(pieces), self.cache
        new = self.encode_pieces([p for p in distinct if p not in cache])
        if len(cache) + len(new) <= CACHE_PIECES:
            cache.update((p, v) for p, v in new.items() if len(p) <= LONG_PIECE)
            return cache if all(len(p) <= LONG_PIECE for p in new) else cache | new
        here = {p: new[p] if p in new else cache[p] for p in distinct}
        self.cache = {p: v for p, v in here.items() if len(p) <= LONG_PIECE}   # make room: what is met now stays
        return here

    def segments(self, text: str) -> Iterator[bytes | list[str]]:
        """The text in order: ids of special tokens as int32, and lists of pieces."""
        for x in self.cut.split(text) if self.cut else [text]:
            if x in self.special:
                yield np.int32(self.special[x]).tobytes()
            else:
                yield from self.pieces(x)

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """The ids (int32) of whole texts; the new pieces of all but very long texts are encoded together."""
        parts = [list(self.segments(t)) if len(t) <= LONG_TEXT else None for t in texts]
        table = self.learn(chain.from_iterable(x for p in parts if p for x in p if type(x) is list))
        out = []
        for text, p in zip(texts, parts):
            if p is None:
                out.append(b"".join([x if type(x) is bytes else b"".join([*map(self.learn(x).__getitem__, x)])
                                     for x in self.segments(text)]))
            else:
                out.append(b"".join([x if type(x) is bytes else b"".join([table[w] for w in x]) for x in p]))
        return out

    def decode(self, ids: list[int]) -> str:
        table = self.token_bytes
        return b"".join([table[i] for i in ids]).decode("utf-8", "replace")


_LOADED: dict[tuple, Vocabulary] = {}   # of this worker, by broadcast and use


def _vocabulary(shared, encoder: bool = True) -> Vocabulary:
    key = (shared.id, encoder)
    if key not in _LOADED:
        for old in [k for k in _LOADED if k[1] == encoder]:
            del _LOADED[old]
        _LOADED[key] = Vocabulary(shared.value, encoder)
    return _LOADED[key]


def _forget() -> None:
    """Empty the tables of pieces: an idle worker would keep them beside the stages that follow."""
    for v in _LOADED.values():
        v.cache = {}


class _Share:
    """A broadcast with its number, which the worker keeps its tables by."""

    def __init__(self, spark, path: str):
        with open(path, "rb") as f:
            self.box = spark.sparkContext.broadcast(f.read())
        self.id = self.box._jbroadcast.id()

    def __getstate__(self):
        return {"box": self.box, "id": self.id}

    @property
    def value(self) -> bytes:
        return self.box.value


def _slices(batch: pa.RecordBatch, column: int, unit: int) -> Iterator[pa.RecordBatch]:
    """The batch cut into runs of rows of about OUT_BYTES (``unit`` bytes an element of the column)."""
    import pyarrow.compute as pc

    col = batch.column(column)
    size = pc.fill_null(pc.binary_length(col) if pa.types.is_string(col.type) or pa.types.is_large_string(col.type)
                        else pc.list_value_length(col), 0).to_numpy(zero_copy_only=False) * unit
    run = np.cumsum(size) // OUT_BYTES
    edges = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(size)]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def _map_column(df: DataFrame, source: str, unit: int, name: str, kind: T.DataType, run, done=None) -> DataFrame:
    """``df`` with column ``name`` (replaced if there is one): ``run(batch)`` of (others, source) in slices; ``done()`` ends a task.

    The other columns travel in a struct, so that their names don't matter.
    """
    others = F.struct(F.lit(True).alias("__"), *[F.col(f"`{c}`") for c in df.columns if c != source])
    packed = df.select(others.alias("o"), F.col(f"`{source}`").alias("s"))
    schema = T.StructType([packed.schema["o"], packed.schema["s"], T.StructField("n", kind)])

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in _slices(whole, 1, unit):
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), run(b.column(1))], names=["o", "s", "n"])
        if done:
            done()

    out = packed.mapInArrow(go, schema)
    return out.select(*[(F.col("s") if c == source else F.col(f"o.`{c}`")).alias(c) for c in df.columns if c != name],
                      F.col("n").alias(name))


def encode_documents(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with the ids (array of int) of each whole text."""
    share = _Share(docs.sparkSession, path)

    def run(texts: pa.Array) -> pa.Array:
        got = _vocabulary(share).encode_batch([t or "" for t in texts.to_pylist()])
        offsets = np.cumsum([0, *(len(g) // 4 for g in got)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(got), np.int32)))

    return _map_column(docs, text_col, 1, ids_col, T.ArrayType(T.IntegerType()), run, _forget)


def decode_documents(df: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``df`` with the text that the ids spell; null ids spell the empty text."""
    share = _Share(df.sparkSession, path)

    def run(lists: pa.Array) -> pa.Array:
        v = _vocabulary(share, encoder=False)
        sizes = [0 if n is None else n for n in lists.value_lengths().to_pylist()]
        ids, ends = lists.flatten().to_numpy().tolist(), np.cumsum(sizes).tolist()
        return pa.array([v.decode(ids[end - n:end]) for n, end in zip(sizes, ends)], pa.string())

    return _map_column(df, ids_col, 4, text_col, T.StringType(), run)
