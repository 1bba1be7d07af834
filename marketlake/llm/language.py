"""Hierarchical language identification.

First the language family is predicted by one-versus-rest linear support vector machines, then
one-versus-one linear machines tell the languages of that family apart by votes (ties: the
larger sum of margins). Features are hashed byte trigrams of the lower-cased letters, square
roots of counts, scaled to length 1. Whole texts are read.

Learned only from ``text`` and ``lang`` of the learning rows (crc32(id) mod 5 is not 0). The
machines are fitted on the driver from a sample of at most about ``fit_rows`` documents of each
language (chosen by a hash of the id; the bound is this parameter), trigrams of which the
executors count and pack. The driver unpacks them into one matrix of 4 * ``dims`` bytes a
document, on which all machines work in place; prediction runs over all documents on the executors.

Null texts and texts without a letter are ``und`` with score 0. Documents with null ids belong
to no fold (held_out null) and are never learned from. Without any learning row, every text
gets ``und``. Ties and repeated rows get equal predictions; further columns are ignored; empty
tables give empty results.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import crc_mod, map_batches, tidy

#: Language families by ISO 639-1 code. A code that is not listed is its own family.
FAMILIES = {
    "germanic": ["en", "de", "nl", "af", "sv", "da", "no", "nb", "nn", "is", "lb", "fy", "yi"],
    "romance": ["fr", "es", "it", "pt", "ca", "gl", "ro", "oc", "la"],
    "slavic": ["ru", "uk", "be", "pl", "cs", "sk", "bg", "mk", "sr", "hr", "bs", "sl"],
    "baltic": ["lt", "lv"],
    "uralic": ["fi", "et", "hu"],
    "turkic": ["tr", "az", "kk", "uz", "ky", "tk"],
    "indic": ["hi", "ur", "bn", "pa", "mr", "gu", "ne"],
    "semitic": ["ar", "he", "mt", "am"],
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}

_LETTER = regex.compile(r"\p{L}")
#: Byte -> itself for ASCII letters and bytes of longer characters, else a space.
_FOLD = np.array([b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256)], np.uint8)


def trigrams(text: str, dims: int) -> np.ndarray:
    """How many trigrams fall into each slot."""
    b = _FOLD[np.frombuffer((" " + text.lower() + " ").encode(), np.uint8)]
    b = b[np.concatenate([[True], (b[1:] != 32) | (b[:-1] != 32)])].astype(np.uint32)
    if len(b) < 3:
        return np.zeros(dims, np.int64)
    code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    slot = (code * np.uint32(2654435761)) >> np.uint32(32 - (dims.bit_length() - 1))
    return np.bincount(slot, minlength=dims)


def scaled(counts: np.ndarray) -> np.ndarray:
    x = np.sqrt(counts).astype(np.float32)
    return x / max(np.linalg.norm(x), 1e-9)


def features(text: str, dims: int) -> np.ndarray:
    return scaled(trigrams(text, dims))


def pack(counts: np.ndarray) -> bytes:
    """Most slots are 0: about a fifth of the bytes of the features."""
    return zlib.compress(counts.astype("<u4").tobytes(), 1)


def unpacked(packed: Iterable[bytes], rows: int, dims: int) -> np.ndarray:
    """A row of features for each document, with a last 1 for the bias."""
    x = np.ones((rows, dims + 1), np.float32)
    for row, counts in zip(x, packed):
        row[:dims] = scaled(np.frombuffer(zlib.decompress(counts), "<u4"))
    return x


def linear_svm(x: np.ndarray, rows: np.ndarray, y: np.ndarray, c: float = 4.0, rounds: int = 12) -> np.ndarray:
    """Weights (bias last) of an L2-regularised squared-hinge machine, by dual coordinate descent,
    from the named ``rows`` of ``x``, which is not copied.
    ``y`` is +1 or -1; each class carries the same total weight."""
    cost = np.where(y > 0, 0.5 * len(y) / max(1, (y > 0).sum()), 0.5 * len(y) / max(1, (y < 0).sum())) * c
    w, alpha, q = np.zeros(x.shape[1], np.float32), np.zeros(len(y)), np.array([(x[r] * x[r]).sum() for r in rows]) + 0.5 / cost
    order = np.random.default_rng(7)
    for _ in range(rounds):
        for i in order.permutation(len(y)):
            at = x[rows[i]]
            step = (y[i] * float(at @ w) - 1 + 0.5 * alpha[i] / cost[i]) / q[i]
            new = max(alpha[i] - step, 0.0)
            if new != alpha[i]:
                w += np.float32((new - alpha[i]) * y[i]) * at
                alpha[i] = new
    return w


@dataclass(frozen=True)
class LanguageModel:
    dims: int
    families: tuple[str, ...]
    languages: tuple[tuple[str, ...], ...]  # of each family
    family_weights: np.ndarray  # a row per family
    pairs: tuple[tuple[int, int, int], ...]  # family, and the two languages' places in it
    pair_weights: np.ndarray  # a row per pair; positive: the first of the two

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.families or not _LETTER.search(text):
            return "und", 0.0
        x = np.append(features(text, self.dims), np.float32(1))
        family, score = 0, 1.0
        if len(self.families) > 1:
            margins = self.family_weights @ x
            family = int(np.argmax(margins))
            score = _chance(margins[family])
        known = self.languages[family]
        if len(known) == 1:
            return known[0], score
        votes, sums, least = [0] * len(known), [0.0] * len(known), {}
        margins = self.pair_weights @ x
        for (f, a, b), m in zip(self.pairs, margins):
            if f == family:
                win = a if m >= 0 else b
                votes[win] += 1
                sums[a] += m
                sums[b] -= m
                least[win] = min(least.get(win, abs(m)), abs(m))
        best = max(range(len(known)), key=lambda k: (votes[k], sums[k], -k))
        return known[best], score * _chance(least[best])


def _chance(margin: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(2.5 * margin, -30, 30))))


def fit(docs: DataFrame, fit_rows: int = 1500, dims: int = 2048, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang") -> LanguageModel:
    """Learn from rows with text, language and id outside the held-out fold."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")) \
        .where(F.col("text").isNotNull() & F.col("lang").isNotNull() & (crc_mod("id", 5) != 0))
    known = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # a row per language
    if not known:
        return LanguageModel(dims, (), (), np.zeros((0, dims + 1)), (), np.zeros((0, dims + 1)))
    share = F.lit(0.0)
    for lang, n in known.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, fit_rows / n))).otherwise(share)
    chosen = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < share * (1 << 30))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = [pack(trigrams(t.as_py(), dims)) for t in batch.column("text")]
        return pa.RecordBatch.from_arrays([batch.column("id"), batch.column("lang"), pa.array(x, pa.binary())], names=["id", "lang", "x"])

    got = map_batches(chosen.select("id", "text", "lang"), work, "id long, lang string, x binary").toArrow()
    got = got.take(pc.sort_indices(got, [("id", "ascending"), ("lang", "ascending")]))  # stable
    x = unpacked((counts.as_py() for counts in got["x"]), len(got), dims)
    lang = np.array(got["lang"].to_pylist(), object)
    del got
    by_family: dict[str, list[str]] = {}
    for code in sorted(set(lang)):
        by_family.setdefault(FAMILY_OF.get(code, code), []).append(code)
    families = tuple(by_family)
    of = np.array([FAMILY_OF.get(code, code) for code in lang])
    tops = [linear_svm(x, np.arange(len(x)), np.where(of == f, 1.0, -1.0)) for f in families] if len(families) > 1 else []
    pairs, weights = [], []
    for k, f in enumerate(families):
        for a, b in combinations(range(len(by_family[f])), 2):
            mine = np.flatnonzero((lang == by_family[f][a]) | (lang == by_family[f][b]))
            pairs.append((k, a, b))
            weights.append(linear_svm(x, mine, np.where(lang[mine] == by_family[f][a], 1.0, -1.0)))
    del x
    tidy()
    empty = np.zeros((0, dims + 1))
    return LanguageModel(dims, families, tuple(tuple(v) for v in by_family.values()),
                         np.array(tops) if tops else empty, tuple(pairs), np.array(weights) if weights else empty)


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, held_out, lang_pred and score (0 to 1)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # families x dims weights: a few hundred KB
    kind = docs.schema[id_col].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        got = [shared.value.predict(t) for t in batch.column(text_col).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(id_col), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
            names=[id_col, "lang_pred", "score"])

    out = map_batches(docs.select(id_col, text_col), work, f"{id_col} {kind}, lang_pred string, score double")
    return out.select(id_col, (crc_mod(id_col, 5) == 0).alias("held_out"), "lang_pred", "score")


def predicted(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> Column:
    """The predicted language as a column. Only the texts go through the Python workers."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("string")
    def language(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([shared.value.predict(t.as_py())[0] for t in texts], pa.string())
        tidy()

    # Spark may evaluate a deterministic function once for a filter and once more for the column
    return language.asNondeterministic()(F.col(text_col))


def with_language(docs: DataFrame, model: LanguageModel, wanted: Sequence[str] | None = None, text_col: str = "text",
                  lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` in one of the ``wanted`` languages (None: any that the model knows), all
    columns, with the predicted language in ``lang_col``."""
    found = docs.withColumn("_lang_pred", predicted(docs, model, text_col))
    good = F.col("_lang_pred") != "und" if wanted is None else F.col("_lang_pred").isin(list(wanted))
    return found.where(good).select(*[F.col("_lang_pred").alias(c) if c == lang_col else F.col(c) for c in docs.columns])
