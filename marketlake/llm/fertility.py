"""Quality rules with tokeniser fertility.

Base statistics of a text (words, symbols, repeated lines and word windows) and what two public
vocabularies make of its words: characters per token in each (a byte-fallback vocabulary and a
byte-level one), and in the first the share of byte-fallback tokens, the share of tokens without
a letter and the entropy of the token distribution. A document is kept if it passes the base
rules, its figures lie in the band of its script and it holds no more than a trace of mojibake.

The Latin band comes from the labelled clean prose (en, de, fr, es) of 200 and more tokens: 1 %
quantiles of 1.80 (es) to 2.08 characters per token, at most 15 % letterless tokens (99 %).
Random letters (up to 1.63), base64 words (1.3) and hex words (1.1) lie under it in the first
vocabulary (base64 also under 1.4 in the second), texts laden with symbols or cell borders over it in letterless tokens (from 23 %).
Entropy is compared with what the number of tokens allows. Mojibake of German prose keeps the
figures of clean prose in both vocabularies (1.99-2.16 characters per token), so it is found by
its bytes: characters that read as UTF-8 once they are turned back into Windows-1252 bytes.
The other scripts have no labelled prose in the given tables; their bands are wide.

Words are runs of characters other than ASCII white space; each word is encoded by itself, with
the vocabulary's word-start mark, and remembered (bounded), so the figures do not depend on how
a text is cut into batches. The script is that of most of the letters.

Null and empty texts have no words: all counts are 0 and the base rules fail them. Null or
repeated ids pass through, other columns are ignored, empty tables give empty results.
"""

from __future__ import annotations

import math
from array import array
from base64 import b64decode
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame

from marketlake.llm.common import map_batches, mix, texts_of, window_hash
from marketlake.llm.wordbpe import Memo


@dataclass(frozen=True)
class Band:
    """Accepted ranges of one script."""

    chars_per_token: tuple[float, float]
    most_fallback: float
    least_entropy: float  # bits, or ``entropy_share`` of log2(tokens) where that is less
    entropy_share: float
    second_least: float = 0.0  # characters per token in the second vocabulary
    most_letterless: float = 1.0


@dataclass(frozen=True)
class FertilityRules:
    """Limits. Fewer tokens than ``judge_from`` say too little for a verdict by fertility."""

    least_words: int = 20
    most_repeat_pct: int = 30
    window: int = 8
    judge_from: int = 40
    most_garbled: float = 0.005  # mojibake characters of all in words
    bands: dict[str, Band] = field(default_factory=lambda: {
        "Latin": Band((1.7, 8.0), 0.10, 5.5, 0.75, 1.4, 0.22),
        "Cyrillic": Band((1.1, 8.0), 0.10, 4.0, 0.5),
        "Greek": Band((0.8, 6.0), 0.30, 4.0, 0.5),
        "Han": Band((0.3, 3.0), 0.80, 4.0, 0.5),
        "Other": Band((0.25, 6.0), 0.95, 3.0, 0.4),
        "None": Band((0.8, 6.0), 0.10, 3.0, 0.4),
    })


_SCRIPTS = {s: regex.compile(rf"\p{{Script={s}}}+") for s in ("Latin", "Cyrillic", "Greek", "Han")}
_LETTERS = regex.compile(r"\p{L}+")
_BEYOND = regex.compile(r"[^\x00-\x7F]+")
_ASCII_LETTERS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_SYMBOLS = b"#*$%&|<>"
#: The second vocabulary.
BYTE_BPE = "byte_bpe_50k.tiktoken"


def _shown(first: int, last: int) -> str:
    """A class of what the bytes look like when they are read as Latin-1 or Windows-1252."""
    each = [chr(b) + bytes([b]).decode("cp1252", "ignore") for b in range(first, last + 1)]
    return f"[{''.join(map(regex.escape, each))}]"


_TAIL = _shown(0x80, 0xBF)
#: UTF-8 of two or three bytes, read in a single-byte character set.
_GARBLED = regex.compile(f"{_shown(0xC2, 0xDF)}{_TAIL}|{_shown(0xE0, 0xEF)}{_TAIL}{{2}}")


def garbled_chars(text: str) -> int:
    """Characters of ``text`` that are mojibake."""
    return 0 if text.isascii() else sum(map(len, _GARBLED.findall(text)))


def script_of(text: str) -> str:
    """The script of most letters; "None" without letters, "Other" outside the listed scripts."""
    raw = text.encode()
    latin = len(raw) - len(raw.translate(None, _ASCII_LETTERS))
    if text.isascii():
        return "Latin" if latin else "None"
    rest = "".join(_BEYOND.findall(text))
    letters = latin + sum(map(len, _LETTERS.findall(rest)))
    if not letters:
        return "None"
    by = {s: sum(map(len, p.findall(rest))) for s, p in _SCRIPTS.items()}
    by["Latin"] += latin
    best = max(by, key=by.get)
    return best if 2 * by[best] >= letters else "Other"


def repeated_words(ids: np.ndarray, window: int) -> int:
    """Words inside a window of ``window`` words that the text holds at least twice."""
    if len(ids) <= window:
        return 0
    h = window_hash(mix(ids.view(np.uint64) + np.uint64(1)), window)
    ordered = np.sort(h)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    starts = np.flatnonzero(np.isin(h, twice))
    edge = np.zeros(len(ids) + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def _packed(ids: list[int], second: int) -> bytes:
    """The ids of a word, then minus its tokens in the second vocabulary."""
    ids.append(-second)
    return array("i", ids).tobytes()


class Fertility:
    """Two vocabularies, the kinds of the first one's ids and the encoded words seen lately."""

    def __init__(self, path: str, second: str | None = None):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        with open(second or public_tokenizers.path(BYTE_BPE), "rb") as f:
            ranks = {b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.second = tiktoken.Encoding("second", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        n = self.model.get_piece_size()
        self.fallback = np.array([self.model.is_byte(i) for i in range(n)])
        pieces = [self.model.id_to_piece(i).replace("▁", "") for i in range(n)]
        self.letterless = ~self.fallback & np.array([p != "" and not _LETTERS.search(p) for p in pieces])
        self.words = Memo(lambda w: self._known(self.model.encode(w.decode()), w.decode()), most=300_000)

    def _known(self, ids: list[int], word: str) -> bytes:
        return _packed(ids, len(self.second.encode_ordinary(" " + word)))

    def learn(self, words: set[bytes]) -> None:
        """Encode in one call the words that are not remembered."""
        new = [w for w in words if w not in self.words and w not in self.words.old]
        texts = [w.decode() for w in new]
        for w, t, ids in zip(new, texts, self.model.encode(texts, num_threads=1)):
            self.words.put(w, self._known(ids, t))

    def figures(self, words: list[bytes], word_chars: int) -> tuple[int, float, float, float, float, float]:
        """Tokens, characters per token, byte-fallback share, entropy in bits, share of letterless
        tokens, characters per token of the second vocabulary."""
        if not words:
            return 0, 0.0, 0.0, 0.0, 0.0, 0.0
        memo = self.words
        both = np.frombuffer(b"".join([memo[w] for w in words]), np.int32)
        first = both >= 0
        ids, n_second = both[first], -int(both[~first].sum(dtype=np.int64))
        n = len(ids)
        if not n:
            return 0, 0.0, 0.0, 0.0, 0.0, 0.0
        counts = np.bincount(ids, minlength=len(self.fallback))
        share = counts[counts > 0] / n
        return (n, word_chars / n, float(counts[self.fallback].sum() / n), float(-(share * np.log2(share)).sum()),
                float(counts[self.letterless].sum() / n), word_chars / n_second)


_OPEN: dict[str, Fertility] = {}


def fertility(path: str) -> Fertility:
    if path not in _OPEN:
        _OPEN[path] = Fertility(path)
    return _OPEN[path]


def measure(text: str, f: Fertility, rules: FertilityRules, words: list[bytes] | None = None) -> tuple:
    raw = text.encode()
    words = raw.split() if words is None else words  # bytes: cuts at \x20 and \x09-\x0D only
    n_words = len(words)
    blanks = len(raw) - len(raw.translate(None, b" \t\n\x0b\x0c\r"))
    word_chars = len(text) - blanks
    n_symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    n_repeat = repeated_words(np.fromiter(map(hash, words), np.int64, n_words), rules.window)
    failed = n_words < rules.least_words or 100 * n_repeat > rules.most_repeat_pct * n_words
    n, per_token, fallback, entropy, letterless, second = f.figures(words, word_chars)
    script = script_of(text)
    band = rules.bands[script]
    low, high = band.chars_per_token
    garbled = garbled_chars(text) / max(1, word_chars)
    good = n < rules.judge_from or (
        low <= per_token <= high and fallback <= band.most_fallback and second >= band.second_least
        and letterless <= band.most_letterless and garbled <= rules.most_garbled
        and entropy >= min(band.least_entropy, band.entropy_share * math.log2(n)))
    return (n_words, word_chars, n_symbols, len(lines) - len(set(lines)), n_repeat, failed, not failed and good,
            script, n, per_token, fallback, entropy, letterless, second, garbled)


FIELDS = [("n_words", "long", pa.int64()), ("word_chars", "long", pa.int64()), ("n_symbols", "long", pa.int64()),
          ("n_dup_lines", "long", pa.int64()), ("n_repeat_words", "long", pa.int64()),
          ("base_failed", "boolean", pa.bool_()), ("kept", "boolean", pa.bool_()), ("script", "string", pa.string()),
          ("n_tokens", "long", pa.int64()), ("chars_per_token", "double", pa.float64()),
          ("fallback_share", "double", pa.float64()), ("token_entropy", "double", pa.float64()),
          ("letterless_share", "double", pa.float64()), ("second_chars_per_token", "double", pa.float64()),
          ("garbled_share", "double", pa.float64())]


def quality_rules(docs: DataFrame, path: str, rules: FertilityRules | None = None, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Per document: id, the base statistics, base_failed, kept, and the figures behind the verdict."""
    rules = rules or FertilityRules()
    schema = f"{id_col} {docs.schema[id_col].dataType.simpleString()}, " + ", ".join(f"{n} {t}" for n, t, _ in FIELDS)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        f, rows = fertility(path), []
        texts = texts_of(batch, text_col)
        for at in range(0, len(texts), 64):
            some = texts[at:at + 64]
            words = [t.encode().split() for t in some]
            f.learn(set(chain.from_iterable(words)))
            rows += [measure(t, f, rules, w) for t, w in zip(some, words)]
        cols = zip(*rows) if rows else [()] * len(FIELDS)
        return pa.RecordBatch.from_arrays(
            [batch.column(id_col), *(pa.array(c, kind) for c, (_, _, kind) in zip(cols, FIELDS))],
            names=[id_col, *(n for n, _, _ in FIELDS)])

    return map_batches(docs.select(id_col, text_col), work, schema)
