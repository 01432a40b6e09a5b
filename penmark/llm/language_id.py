"""Language identification by hierarchical discrimination.

A text's language family is predicted first; one-versus-one linear support vector
machines then separate the closely related languages of that family by votes. Features
are the square roots of the shares of hashed character 1-, 2- and 3-grams of the whole
lower-cased text, every run of non-letters counting as one blank; they have unit length
for texts of any size. The machines are trained by dual coordinate descent (Hsieh et al.,
2008) on at most ``PER_LANGUAGE`` labelled rows a language, drawn by a hash of the row.
Sample and models are all that the driver holds; both have a size fixed by the number of
languages and the parameters here. Every row is then scored where it lies, without a shuffle.

Defined results: null text, empty text and text without a letter give ``und`` and score
0, and so does everything if there is no labelled row to learn from. Rows without lang
are not learned from. A null id counts as not held out. Ties of votes go to the larger sum
of margins, then to the language that comes first by code point. Repeated rows get equal
results, an empty table gives an empty table, other columns are not looked at. Long texts
are counted in slices of ``SLICE`` characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PER_LANGUAGE = 500     # labelled rows learned from, at most
BITS = 13              # of a hashed feature's number
SLICE = 1 << 20        # characters
COST = 10.0            # of a margin violation
EPOCHS = 30
UNKNOWN = "und"

# ISO 639-1 codes by family; a language not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl af sv da no nb nn is fy lb".split(),
    "romance": "fr es it pt ro ca gl oc".split(),
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk".split(),
    "uralic": "fi et hu".split(),
    "turkic": "tr az kk uz ky tk".split(),
    "indic": "hi ur bn mr pa gu ne".split(),
}


def family_of(lang: str) -> str:
    return next((f for f, members in FAMILIES.items() if lang in members), lang)


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def features(text: str) -> np.ndarray | None:
    """Feature vector of a text, or None if it has no letter."""
    counts, seen, carry = np.zeros(1 << BITS, np.int64), False, np.array([32], np.uint64)
    for lo in range(0, len(text), SLICE):
        code = np.frombuffer(text[lo:lo + SLICE].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _letters()[code]
        seen |= bool(letter.any())
        code = np.where(letter, code, 32).astype(np.uint64)
        code = np.concatenate([carry, code, [np.uint64(32)] if lo + SLICE >= len(text) else []]).astype(np.uint64)
        code = code[np.concatenate(([True], (code[1:] != 32) | (code[:-1] != 32)))]
        first = 2 if lo else 0     # grams within what the last slice carried are counted already
        gram = code
        for n in (1, 2, 3):
            if n > 1:
                gram = gram[:-1] * np.uint64(0x100000001B3) + code[n - 1:]
            h = (gram[max(0, min(first, len(carry)) - n + 1) if lo else 0:] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)
            counts += np.bincount(h.astype(np.int64), minlength=1 << BITS)
        carry = code[-2:]
    return np.sqrt(counts / counts.sum()) if seen else None


def train_svm(x: np.ndarray, y: np.ndarray, seed: int = 0) -> np.ndarray:
    """Weights (the last is the bias) of a linear SVM with hinge loss; y is -1 or 1."""
    norm = np.einsum("ij,ij->i", x, x) + 1
    alpha, w, bias = np.zeros(len(x)), np.zeros(x.shape[1], x.dtype), 0.0
    # rarer classes weigh more, so that a margin is worth the same on both sides
    upper = COST * np.where(y > 0, (y < 0).mean(), (y > 0).mean()) * 2
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        most = 0.0
        for i in rng.permutation(len(x)):
            g = y[i] * (float(w @ x[i]) + bias) - 1
            new = min(max(alpha[i] - g / norm[i], 0.0), upper[i])
            if new != alpha[i]:
                w += x.dtype.type((new - alpha[i]) * y[i]) * x[i]
                bias += (new - alpha[i]) * y[i]
                most = max(most, abs(new - alpha[i]))
                alpha[i] = new
        if most < 1e-4:
            break
    return np.append(w.astype(np.float64), bias)


class Hierarchy:
    """Family machines (one against the rest), then machines for the pairs of a family's languages."""

    def __init__(self, x: np.ndarray, langs: list[str]):
        self.langs = sorted(set(langs))
        self.families: dict[str, list[str]] = {}
        for lang in self.langs:
            self.families.setdefault(family_of(lang), []).append(lang)
        self.names = sorted(self.families)
        lang, family = np.array(langs), np.array([family_of(v) for v in langs])
        self.family_w = (np.stack([train_svm(x, np.where(family == f, 1.0, -1.0)) for f in self.names])
                         if len(self.names) > 1 else None)
        self.pair_w = {}
        for members in self.families.values():
            for a, b in combinations(members, 2):
                own = (lang == a) | (lang == b)
                self.pair_w[a, b] = train_svm(x[own], np.where(lang[own] == a, 1.0, -1.0))

    def predict(self, f: np.ndarray | None) -> tuple[str, float]:
        """Language and score; the score is the logistic of the least margin that decided."""
        if f is None or not self.langs:
            return UNKNOWN, 0.0
        f, least, family = np.append(f, 1.0), np.inf, self.names[0]
        if self.family_w is not None:
            margins = self.family_w @ f
            order = np.argsort(-margins, kind="stable")
            family, least = self.names[order[0]], (margins[order[0]] - margins[order[1]]) / 2
        members = self.families[family]
        votes = {v: [0, 0.0] for v in members}
        margin = {}
        for a, b in combinations(members, 2):
            m = float(self.pair_w[a, b] @ f)
            margin[a, b] = m
            votes[a if m >= 0 else b][0] += 1
            votes[a][1] += m
            votes[b][1] -= m
        best = min(members, key=lambda v: (-votes[v][0], -votes[v][1], v))
        for (a, b), m in margin.items():
            if best in (a, b):
                least = min(least, m if best == a else -m)
        return best, float(1 / (1 + np.exp(-np.clip(2 * least, -30, 30)))) if np.isfinite(least) else 1.0


def held_out(id_col: Column) -> Column:
    """Rows kept from training: crc32 of the id as text has remainder 2 by 4."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_sample(rows: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """About ``per_language`` rows (lang, text) of each language, drawn by a hash of id and text."""
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}   # a row a language
    if not counts:
        return rows.select("lang", "text").limit(0)
    share = F.element_at(F.create_map(*[v for k, n in counts.items() for v in (F.lit(k), F.lit(per_language / n))]), F.col("lang"))
    drawn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < share * (1 << 30)
    return rows.filter(drawn).select("lang", "text").limit(2 * per_language * len(counts))


def train(rows: DataFrame, per_language: int = PER_LANGUAGE) -> Hierarchy:
    """Fit the hierarchy on a bounded sample of ``rows`` (doc_id, lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [features(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([None if f is None else f.astype(np.float32).tobytes() for f in found], pa.binary())],
                names=["lang", "f"])

    got = training_sample(rows, per_language).mapInArrow(run, "lang string, f binary").filter("f IS NOT NULL").collect()
    got.sort(key=lambda r: (r.lang, bytes(r.f)))   # the same order however the rows came
    langs, x = [r.lang for r in got], np.empty((len(got), 1 << BITS), np.float32)
    for i in range(len(got)):
        x[i], got[i] = np.frombuffer(got[i].f, np.float32), None   # one copy at a time
    return Hierarchy(x, langs)


def identify(docs: DataFrame, model: Hierarchy, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            found = [m.predict(features(t.as_py() or "")) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x for x, _ in found], pa.string()),
                                              pa.array([s for _, s in found], pa.float64())], names=[id_col, "lang_pred", "score"])

    return docs.select(id_col, text_col).mapInArrow(run, schema)
