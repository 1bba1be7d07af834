"""Token counts by prefix dynamic programming.

For every prefix of a pre-token the table holds the *last token* of that prefix's encoding
and the number of tokens. A prefix of length i ends in the one token t for which the last
token of the prefix before t stands next to t without merging (``Compat``): BPE output is
exactly the token sequence whose neighbours all stand. So one pass from left to right gives
the exact count at every prefix, with no re-encoding, and

* the count of the whole text is the sum over its pre-tokens,
* the count of any shorter prefix is the sum before its last pre-token plus one table cell,
* a token budget is answered by searching those sums (``longest_prefix``).

A prefix that ends inside a word ends that word, so its last token carries the end mark: the
table has a second row of counts for that.

Inputs may hold null texts (counted as empty), any length, repeated or null ids and further
columns (ignored). Empty tables give empty results.
"""

from __future__ import annotations

from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from marketlake.llm.common import map_batches, texts_of
from marketlake.llm.wordbpe import END, Memo, WordBpe, _SPACES, open_word_bpe

NEVER = 1 << 60


class Compat:
    """Whether two tokens stay apart when their strings are encoded together.

    Follows the piece of the left token at the border and the piece of the right token at the
    border through the merges that build the two tokens, in rank order; the border breaks if
    a merge of the two border pieces comes before either is built into something larger. On
    equal rank the left merge goes first, as merges of one rank apply from left to right.
    """

    def __init__(self, bpe: WordBpe):
        self.bpe = bpe
        self._spine: dict[tuple[str, int], list[tuple[str, int]]] = {}
        self._alone: dict[str, bool] = {}
        self.apart = Memo(lambda ab: self._apart(*ab, NEVER) and self.alone(ab[0]) and self.alone(ab[1]),
                          most=500_000, longest=2)

    def spine(self, token: str, side: int) -> list[tuple[str, int]]:
        """Border pieces of ``token`` (side 1: its right border) from one symbol up to the token,
        each with the rank of the merge that absorbs it."""
        key = (token, side)
        if key not in self._spine:
            steps, taken = [], NEVER
            while True:
                steps.append((token, taken))
                if token not in self.bpe.parts:
                    break
                parts = self.bpe.parts[token]
                taken, token = self.bpe.rank[parts], parts[side]
            self._spine[key] = steps[::-1]
        return self._spine[key]

    def _apart(self, left: str, right: str, until: int) -> bool:
        a, b, i, j = self.spine(left, 1), self.spine(right, 0), 0, 0
        while True:
            (x, x_taken), (y, y_taken) = a[i], b[j]
            x_taken, y_taken = min(x_taken, until), min(y_taken, until)
            m = self.bpe.rank.get((x, y), NEVER)
            if m < x_taken and m <= y_taken and m < until:
                return False
            if i + 1 == len(a) and j + 1 == len(b):
                return True
            if j + 1 == len(b) or (i + 1 < len(a) and x_taken <= y_taken):
                i += 1
            else:
                j += 1

    def alone(self, token: str) -> bool:
        """Whether the token's own string is encoded as this one token."""
        if token not in self._alone:
            parts = self.bpe.parts.get(token)
            self._alone[token] = parts is None or (
                self.alone(parts[0]) and self.alone(parts[1]) and self._apart(*parts, self.bpe.rank[parts]))
        return self._alone[token]


class PrefixCounter:
    """Prefix tables of one tokenizer file."""

    def __init__(self, path: str):
        self.bpe = open_word_bpe(path)
        self.compat = Compat(self.bpe)
        self.open = {t for t in self.bpe.ids if not t.endswith(END)}
        self.closed = {t[:-len(END)] for t in self.bpe.ids if t.endswith(END)}
        self.begins = {t[:i] for t in self.open | self.closed for i in range(1, len(t) + 1)}
        self.total = Memo(self._chunk_total, most=600_000)
        self.word_total = Memo(lambda w: self.table(w, every=False)[-1], most=300_000)

    def table(self, word: str, every: bool = True) -> list[int]:
        """Token count of ``word[:i]`` as a pre-token, for i from 0 to len(word). Without
        ``every``, only the last cell is worked out; the others are 0."""
        apart, alone, known, begins, final = self.compat.apart, self.compat.alone, self.open, self.begins, self.closed
        n = len(word)
        last, count, closed = [""] * (n + 1), [0] * (n + 1), [0] * (n + 1)
        for j in range(n):  # every token that starts at j, as the last one of a longer prefix
            before, so_far, i = last[j], count[j] + 1, j + 1
            t = word[j:i]
            while t in begins:
                if i == n:
                    if t in final and not closed[i] and (apart[before, t + END] if j else alone(t + END)):
                        closed[i] = so_far
                    break
                if not count[i] and t in known and (apart[before, t] if j else alone(t)):
                    last[i], count[i] = t, so_far
                if every and t in final and not closed[i] and (apart[before, t + END] if j else alone(t + END)):
                    closed[i] = so_far
                i += 1
                t = word[j:i]
        return closed

    def _chunk_total(self, chunk: str) -> int:
        return sum([1 if isinstance(w, int) else self.word_total[w] for w in self.bpe.pretokens(chunk)])

    def sums(self, text: str) -> list[int]:
        """Token count of the text up to the end of each white-space chunk."""
        total = self.total
        return list(accumulate([total[c] for c in self.bpe.chunks(text)]))

    def chunk_prefixes(self, chunk: str) -> list[int] | None:
        """Token count of every prefix of one chunk, by characters of the chunk, from the tables
        of its pre-tokens. None if normalisation changes the characters or a special string is
        in it, so that prefixes don't line up."""
        words, lower = self.bpe.pretokens(chunk), chunk.lower()
        if any(isinstance(w, int) for w in words) or len(lower) != len(chunk) \
                or "".join(words) != "".join([self.bpe.to_char[b] for b in lower.encode()]):
            return None
        out, done, at = [0], 0, 0
        for w in words:
            # a cut contraction falls apart into its apostrophe and letters
            cells = self.table(w) if w[0] != "'" or len(w) == 1 or not w[1].isalpha() else \
                [self._chunk_total(w[:i]) for i in range(len(w) + 1)]
            used = 0
            while used < len(w):
                used += len(lower[at].encode())
                at += 1
                out.append(done + cells[used])
            done += cells[-1]
        return out

    def longest_prefix(self, text: str, budget: int, sums: list[int] | None = None) -> str:
        """The longest prefix of the text with at most ``budget`` tokens. In a chunk whose
        prefixes don't line up with its tables, the place is bisected and then searched for
        64 characters further, since a longer prefix can have a token less."""
        sums = self.sums(text) if sums is None else sums
        if not sums or sums[-1] <= budget:
            return text
        k = next(i for i, s in enumerate(sums) if s > budget)
        a, b = _chunk_spans(text, k)
        left, chunk = budget - (sums[k - 1] if k else 0), text[a:b]
        cells = self.chunk_prefixes(chunk)
        if cells is not None:
            return text[:a + max(i for i, c in enumerate(cells) if c <= left)]
        low, high = 0, len(chunk)
        while high - low > 1:
            mid = (low + high) // 2
            low, high = (mid, high) if self._chunk_total(chunk[:mid]) <= left else (low, mid)
        further = range(low, min(len(chunk), low + 64) + 1)
        return text[:a + max(i for i in further if i == low or self._chunk_total(chunk[:i]) <= left)]


def _chunk_spans(text: str, k: int) -> tuple[int, int]:
    """Start and end of white-space chunk number ``k``."""
    at, n = 0, -1
    while True:
        m = _SPACES.search(text, at)
        end = m.start() if m else len(text)
        if end > at:
            n += 1
            if n == k:
                return at, end
        at = m.end() if m else len(text)


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text",
                 keep_sums: bool = False) -> DataFrame:
    """Per document: id, n_bytes, n_tokens, over_limit (n_tokens > ``limit``) and limit_bytes, the
    UTF-8 length of the longest prefix within the limit. ``keep_sums`` adds ``chunk_sums``, the
    count at the end of every white-space chunk, for later truncation and budget questions."""
    extra = ", chunk_sums array<int>" if keep_sums else ""
    schema = f"{id_col} {docs.schema[id_col].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean, limit_bytes long{extra}"

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        c, n_bytes, n_tokens, within, kept = counter(path), [], [], [], []
        for text in texts_of(batch, text_col):
            sums = c.sums(text)
            n_bytes.append(len(text.encode()))
            n_tokens.append(sums[-1] if sums else 0)
            over = n_tokens[-1] > limit
            within.append(len(c.longest_prefix(text, limit, sums).encode()) if over else n_bytes[-1])
            kept.append(sums)
        cols = [batch.column(id_col), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()),
                pa.array([n > limit for n in n_tokens], pa.bool_()), pa.array(within, pa.int64())]
        names = [id_col, "n_bytes", "n_tokens", "over_limit", "limit_bytes"]
        if keep_sums:
            cols, names = [*cols, pa.array(kept, pa.list_(pa.int32()))], [*names, "chunk_sums"]
        return pa.RecordBatch.from_arrays(cols, names=names)

    return map_batches(docs.select(id_col, text_col), work, schema)
