"""Removal of repeated passages by prefix-free parsing.

A byte is removed if a string of ``length`` bytes that covers it also starts in a document with
a smaller id (on the input, whole texts, UTF-8; matches never cross documents).

*Parse.* A rolling hash over ``trigger`` bytes marks triggers: the smallest hash among the
windows of any ``length`` bytes. The trigger of a string depends on the string alone, so equal
strings have equal triggers at equal places. The strings with one trigger start side by side;
the bytes they cover are a *phrase*. Phrases overlap, so none is a prefix of the text after
it, and a text is the sequence of its phrases.

*Dictionary.* Distinct phrases with the smallest document each. A phrase that a smaller document
holds too is removed as a whole: long repeats, however often they occur, cost a dictionary
entry for each phrase and no more.

*Order.* What is left are edges of repeats, where equal strings lie in different phrases of one
trigger. Only suffixes that can have an equal are looked at: phrases that agree with another one
of their trigger on 17 bytes to its left or right. Their suffixes are put in corpus order as far
as it matters here, by (a fingerprint of) their first ``length`` bytes, and every run of equal
ones gets its smallest document. Trigger by trigger this is the suffix array of the
dictionary, expanded by the parse to the documents.

Each step is one exchange between blocks of documents and ranges of hashes: a block sends every
hash once with its smallest document, packed in arrays, so a passage that a third of all
documents holds counts once for a block, and gets the answers in the order it sent. Documents are
dealt to blocks by a hash of the id, about ``block_bytes`` of text each, and hashes to ranges of
about ``part_bytes`` of text each; a step sends a row for each block and range, so their number
grows with the square of the input (about 9000 at 0.5 GB).

Null texts are empty and nothing is removed; texts shorter than ``length`` stay whole; rows
that repeat an id don't remove each other's text; rows without id stay whole and remove
nothing; other columns are ignored; empty tables give empty results. 64-bit fingerprints stand
for strings.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import BYTE_VALUE, mix, tidy, window_hash, window_min

PIECE = 1 << 20  # texts are parsed in overlapping pieces of this size
_B = 0x9E3779B97F4A7C15
_POWER: dict[str, np.ndarray] = {}


def _powers() -> tuple[np.ndarray, np.ndarray]:
    if not _POWER:
        with np.errstate(over="ignore"):
            for name, base in (("up", _B), ("down", pow(_B, -1, 1 << 64))):
                _POWER[name] = np.concatenate([[np.uint64(1)], np.cumprod(np.full(PIECE + 128, base, np.uint64))])
    return _POWER["up"], _POWER["down"]


class Phrases:
    """The phrases of a block's documents, as arrays: doc (place in the block), first and last
    start of the strings, place of the trigger, its hash, content hash, and hashes of 17 bytes on either side."""

    def __init__(self, texts: list[bytes], length: int, trigger: int, contents: bool = True):
        """Without ``contents``, content, left and right are left out."""
        self.length, self.trigger, self.contents = length, trigger, contents
        self.up, self.down = _powers()
        parts = [p for k, t in enumerate(texts) for p in self._parse(k, t)]
        cols = zip(*parts) if parts else [[np.empty(0, np.int64)]] * 4 + [[np.empty(0, np.uint64)]] * (4 if contents else 1)
        self.doc, self.first, self.last, self.place, self.hash, *rest = (np.concatenate(list(c)) for c in cols)
        if contents:
            self.content, self.left, self.right = rest

    def _sums(self, raw: bytes) -> np.ndarray:
        value = BYTE_VALUE[np.frombuffer(raw, np.uint8)]
        with np.errstate(over="ignore"):
            return np.concatenate([[np.uint64(0)], np.cumsum(value * self.up[:len(value)], dtype=np.uint64)])

    def _cut(self, sums: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Hash of the bytes from a to b."""
        with np.errstate(over="ignore"):
            return mix((sums[b] - sums[a]) * self.down[a] + (b - a).astype(np.uint64))

    def _parse(self, k: int, text: bytes) -> Iterator[tuple]:
        half = self.length - self.trigger  # most bytes of a string on one side of its trigger
        reach = (half + 1) // 2
        for at in range(0, max(1, len(text) - self.length + 1), PIECE - self.length + 1):
            raw = text[at:at + PIECE]
            if len(raw) < self.length:
                return
            h = window_hash(BYTE_VALUE[np.frombuffer(raw, np.uint8)], self.trigger)
            # smallest hash, then leftmost: the place in the low 20 bits
            place = (window_min((h & np.uint64(~0xFFFFF & (1 << 64) - 1)) | np.arange(len(h), dtype=np.uint64), half + 1) & np.uint64(0xFFFFF)).astype(np.int64)
            cut = np.flatnonzero(place[1:] != place[:-1]) + 1
            first, last = np.concatenate([[0], cut]), np.concatenate([cut - 1, [len(place) - 1]])
            p = place[first]
            own = np.full(len(first), k, np.int64), first + at, last + at, p + at, h[p]
            if not self.contents:
                yield own
                continue
            sums = self._sums(raw)
            with np.errstate(over="ignore"):
                content = mix(self._cut(sums, first, last + self.length) + (p - first).astype(np.uint64) * np.uint64(_B))
            has_left, has_right = p - first >= reach, p - last <= reach
            left = np.where(has_left, self._cut(sums, np.where(has_left, p - reach, 0), p) | np.uint64(1), np.uint64(0))
            to = p + self.trigger + half - reach
            right = np.where(has_right & (to <= len(raw)), self._cut(sums, p + self.trigger, np.minimum(to, len(raw))) | np.uint64(1), np.uint64(0))
            yield *own, content, left, right

    def strings(self, texts: list[bytes], which: np.ndarray, by_left: np.ndarray, by_right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(doc, start, hash) of the strings of the chosen phrases that hold the bytes left of the
        trigger, for phrases marked ``by_left``, or those to its right."""
        docs, starts, hashes = [], [], []
        # strings with the bytes to the left start at or before trigger - reach, the others from there on
        turn = self.place[which] - (self.length - self.trigger + 1) // 2
        first = np.where(by_left, self.first[which], np.maximum(self.first[which], turn))
        last = np.where(by_right, self.last[which], np.minimum(self.last[which], turn))
        some = (by_left | by_right) & (first <= last)
        which, first, last = which[some], first[some], last[some]
        for k in np.unique(self.doc[which]):
            mine = self.doc[which] == k
            n = last[mine] - first[mine] + 1
            s = np.repeat(first[mine] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            if len(texts[k]) <= PIECE:
                got = self._cut(self._sums(texts[k]), s, s + self.length)
            else:  # hash piece by piece; the value does not depend on the piece
                got = np.empty(len(s), np.uint64)
                for base in np.unique(s // (PIECE // 2)) * (PIECE // 2):
                    here = (s >= base) & (s < base + PIECE // 2)
                    got[here] = self._cut(self._sums(texts[k][base:base + PIECE // 2 + self.length]), s[here] - base, s[here] - base + self.length)
            docs.append(np.full(len(s), k))
            starts.append(s)
            hashes.append(got)
        if not docs:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
        return np.concatenate(docs), np.concatenate(starts), np.concatenate(hashes)


# ---- packed messages --------------------------------------------------------------------

MESSAGE = "block int, part int, kind int, payload binary"


def _pack(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *(len(a.tobytes()) for a in arrays)], np.int64)
    return head.tobytes() + b"".join(a.tobytes() for a in arrays)


def _unpack(payload: bytes, *kinds: type) -> list[np.ndarray]:
    n = int(np.frombuffer(payload, np.int64, 1)[0])
    sizes, at, out = np.frombuffer(payload, np.int64, n, 8), 8 * (n + 1), []
    for size, kind in zip(sizes, kinds):
        out.append(np.frombuffer(payload, kind, int(size) // np.dtype(kind).itemsize, at))
        at += int(size)
    return out


def _messages(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    cols = list(zip(*rows)) if rows else [(), (), (), ()]
    return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.int32(), pa.binary()))], names=["block", "part", "kind", "payload"])


def _bits(flags: np.ndarray) -> np.ndarray:
    return np.packbits(flags)


def _rows(table: pa.Table) -> list[tuple[int, int, int, bytes]]:
    return list(zip(*(table.column(c).to_pylist() for c in ("block", "part", "kind", "payload"))))


def _first_of(keys: tuple[np.ndarray, ...], doc: np.ndarray) -> tuple[tuple[np.ndarray, ...], np.ndarray, np.ndarray]:
    """Distinct keys in sorted order, the smallest doc of each, and each input's place among them."""
    order = np.lexsort((doc, *keys[::-1]))
    sorted_keys = [k[order] for k in keys]
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in sorted_keys])
    at = np.empty(len(order), np.int64)
    at[order] = np.cumsum(new) - 1
    return tuple(k[new] for k in sorted_keys), doc[order][new], at


def _parts(keys: np.ndarray, parts: int) -> list[np.ndarray]:
    """Places of the keys (sorted) in each part."""
    of = (keys >> np.uint64(32)) % np.uint64(parts)
    order = np.argsort(of, kind="stable")
    return np.split(order, np.searchsorted(of[order], np.arange(1, parts)))


FILTER, DICTIONARY, SUFFIXES, SPANS, CARRIED = range(5)


class Block:
    """One block of documents with the answers that came back so far."""

    def __init__(self, docs: pa.Table, answers: pa.Table | None, length: int, trigger: int, parts: int, parse: str = "all"):
        """``parse``: "all", "triggers" (hashes only) or "none"."""
        order = sorted((i, t or "") for i, t in zip(docs.column("doc_id").to_pylist(), docs.column("text").to_pylist()) if i is not None)
        self.block = docs.column("block")[0].as_py() if docs.num_rows else 0
        self.ids, self.texts = np.array([i for i, _ in order], np.int64), [t.encode() for _, t in order]
        self.parts = parts
        if parse != "none":
            self.phrases = Phrases(self.texts, length, trigger, parse == "all")
            self.doc = self.ids[self.phrases.doc] if len(self.ids) else np.empty(0, np.int64)
        self.answers = {(kind, part): payload for _, part, kind, payload in (_rows(answers) if answers is not None else [])}

    def _send(self, kind: int, keys: np.ndarray, pack: Callable[[np.ndarray], bytes]) -> list[tuple[int, int, int, bytes]]:
        return [(self.block, part, kind, pack(at)) for part, at in enumerate(_parts(keys, self.parts)) if len(at)]

    def _carry(self) -> list[tuple[int, int, int, bytes]]:
        """Earlier answers travel along, so that a step needs only the one before."""
        return [(self.block, part, CARRIED + kind, payload) for (kind, part), payload in self.answers.items()]

    def _answered(self, kind: int, keys: np.ndarray, flags: int) -> list[np.ndarray]:
        """The answers, so many flags for each key, in the order of the keys."""
        out = [np.zeros(len(keys), bool) for _ in range(flags)]
        for part, at in enumerate(_parts(keys, self.parts)):
            if len(at):
                for o, got in zip(out, _unpack(self.answers[kind, part], *[np.uint8] * flags)):
                    o[at] = np.unpackbits(got, count=len(at)).astype(bool)
        return out

    # step 1: which triggers occur in two documents
    def triggers(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        (keys,), low, at = _first_of((self.phrases.hash,), self.doc)
        high = np.zeros(len(keys), np.int64)
        np.maximum.at(high, at, self.doc) if len(keys) and self.ids.min() >= 0 else None
        if len(keys) and self.ids.min() < 0:
            high = -_first_of((self.phrases.hash,), -self.doc)[1]
        return keys, high > low, at

    def ask_triggers(self) -> list:
        keys, several, _ = self.triggers()
        # 48 bits do: a false meeting only lets a trigger through to the next step
        return self._send(FILTER, keys, lambda at: _pack(keys[at].astype(np.uint32), (keys[at] >> np.uint64(32)).astype(np.uint16), _bits(several[at])))

    # step 2: the dictionary of phrases of shared triggers
    def dictionary(self) -> tuple:
        keys, _, at = self.triggers()
        (shared,) = self._answered(FILTER, keys, 1)
        mine = np.flatnonzero(shared[at])
        p = self.phrases
        (hashes, contents, lefts, rights), low, place = _first_of((p.hash[mine], p.content[mine], p.left[mine], p.right[mine]), self.doc[mine])
        return mine, place, hashes, contents, lefts, rights, low

    def ask_dictionary(self) -> list:
        _, _, hashes, contents, lefts, rights, low = self.dictionary()
        return self._carry() + self._send(DICTIONARY, hashes, lambda at: _pack(
            hashes[at].astype(np.uint32), contents[at], lefts[at].astype(np.uint32), rights[at].astype(np.uint32), low[at]))

    # step 3: the suffixes of phrases first met here that may have an equal elsewhere
    def suffixes(self) -> tuple:
        mine, place, hashes, _, _, _, low = self.dictionary()
        earlier, by_left, by_right = (x[place] for x in self._answered(DICTIONARY, hashes, 3))
        here = self.doc[mine] == low[place]  # the first of the block's documents with the phrase
        first = here & ~earlier
        return mine[~first], *self.phrases.strings(self.texts, mine[first], by_left[first], by_right[first])

    def ask_suffixes(self) -> list:
        """The open strings, and for the last step what is known now: removed spans, and the open
        strings' places with the place of each one's answer."""
        whole, doc, start, hashes = self.suffixes()
        own = self.ids[doc] if len(doc) else doc
        (keys,), low, at = _first_of((hashes,), own)
        known = own > low[at] if len(own) else np.empty(0, bool)  # held by a smaller document of the block
        p, n = self.phrases, self.phrases.length
        spans = _joined(np.concatenate([p.doc[whole], doc[known]]), np.concatenate([p.first[whole], start[known]]),
                        np.concatenate([p.last[whole], start[known]]) + n)
        split = _parts(keys, self.parts)
        answer = np.empty(len(keys), np.int64)
        answer[np.concatenate(split)] = np.arange(len(keys))
        open_ = (doc[~known], start[~known], answer[at[~known]])
        small = [x.astype(np.uint32) for x in (*spans, *open_, np.array([len(x) for x in split]))]
        # the blocks' spans are as much as the input: each part passes on those of a few blocks
        return [(self.block, self.block % self.parts, CARRIED + SPANS, _pack(*small))] + self._send(SUFFIXES, keys, lambda at: _pack(keys[at], low[at]))

    # result: what is covered
    def removed(self, length: int) -> list[tuple]:
        a, begin, end, doc, start, answer, sizes = (x.astype(np.int64) for x in _unpack(self.answers[SPANS, self.block % self.parts], *[np.uint32] * 7))
        earlier = [np.unpackbits(*_unpack(self.answers[SUFFIXES, part], np.uint8), count=int(n)) for part, n in enumerate(sizes) if n]
        hit = np.concatenate(earlier)[answer].astype(bool) if len(answer) else np.empty(0, bool)
        a, begin, end = np.concatenate([a, doc[hit]]), np.concatenate([begin, start[hit]]), np.concatenate([end, start[hit] + length])
        out = []
        order = np.argsort(a, kind="stable")
        bounds = np.searchsorted(a[order], np.arange(len(self.ids) + 1))
        for k, (i, text) in enumerate(zip(self.ids.tolist(), self.texts)):
            mine = order[bounds[k]:bounds[k + 1]]
            _, low, high = _joined(a[mine], begin[mine], end[mine])
            kept, at = hashlib.sha256(), 0
            for x, y in zip(low.tolist(), high.tolist()):
                kept.update(text[at:x])
                at = y
            kept.update(text[at:])
            out.append((i, len(text), int((high - low).sum()), np.stack([low, high], axis=1).ravel().tolist(), kept.hexdigest()))
        return out


def _joined(doc: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The spans of each document with those that touch or overlap made one."""
    if not len(doc):
        return doc, begin, end
    order = np.lexsort((begin, doc))
    doc, begin, end = doc[order], begin[order], end[order]
    base = int(end.max()) + 2  # documents side by side on one line
    low, high = doc * base + begin, np.maximum.accumulate(doc * base + end)
    new = np.concatenate([[True], low[1:] > high[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(doc) - 1]])
    return doc[new], begin[new], high[last] - doc[last] * base


def _answer(table: pa.Table) -> pa.Table:
    """Answers of one part to the blocks that asked it."""
    passed = pc.greater_equal(table.column("kind"), CARRIED)
    carried = table.select(["block", "part", "kind", "payload"]).filter(passed)
    carried = carried.set_column(2, "kind", pc.subtract(carried.column("kind"), pa.scalar(CARRIED, pa.int32())))
    rows, out = _rows(table.filter(pc.invert(passed))), []
    del table, passed
    if not rows:
        return carried
    kind = rows[0][2]
    if kind == FILTER:
        got = [_unpack(r[3], np.uint32, np.uint16, np.uint8) for r in rows]
        keys = np.concatenate([g[0] | (g[1].astype(np.uint64) << np.uint64(32)) for g in got])
        several = np.concatenate([np.unpackbits(g[2], count=len(g[0])).astype(bool) for g in got])
        _, which, counts = np.unique(keys, return_inverse=True, return_counts=True)
        # in two blocks, so in two documents; or in two of one block, wherever else it is
        both = np.zeros(len(counts), bool)
        np.logical_or.at(both, which, several)
        replies = [(counts > 1)[which] | both[which]]
    elif kind == DICTIONARY:
        got = [_unpack(r[3], np.uint32, np.uint64, np.uint32, np.uint32, np.int64) for r in rows]
        trigger, content, left, right, doc = (np.concatenate(c) for c in zip(*got))
        (t, _, l, r_), first, at = _first_of((trigger, content, left, right), doc)
        shared = []
        for side in (l, r_):
            _, which, counts = np.unique(_pairs(t, side), return_inverse=True, return_counts=True)
            shared.append((counts[which] > 1) & (side > 0))
        replies = [first[at] < doc, shared[0][at], shared[1][at]]
    else:
        got = [_unpack(r[3], np.uint64, np.int64) for r in rows]
        keys, doc = (np.concatenate(c) for c in zip(*got))
        _, first, at = _first_of((keys,), doc)
        replies = [first[at] < doc]
    ends = np.cumsum([len(g[0]) for g in got])
    for (b, p, k, _), end, g in zip(rows, ends, got):
        out.append((b, p, k, _pack(*(_bits(x[end - len(g[0]):end]) for x in replies))))
    del rows, got, replies
    out = pa.concat_tables([carried, _messages(out)])
    tidy()
    return out


def _pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(a.astype(np.uint64) * np.uint64(_B) + b.astype(np.uint64))


def find_repeats(docs: DataFrame, length: int = 50, trigger: int = 16, block_bytes: int = 4 << 20, part_bytes: int = 8 << 20, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Per document: id, n_bytes, n_removed, spans (start and end byte of each maximal removed
    run, in turn) and kept_sha256 (of what remains). A task holds about ``block_bytes`` of texts, or
    the keys of ``part_bytes`` of texts."""
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    parts, blocks = (max(1, math.ceil(total / size)) for size in (part_bytes, block_bytes))
    block = F.pmod(F.xxhash64(id_col), F.lit(blocks)).cast("int")
    table = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), block.alias("block"))
    by_block = table.where(F.col("doc_id").isNotNull()).groupBy("block")

    def ask(step: str, answers: DataFrame | None) -> DataFrame:
        if answers is None:
            sent = by_block.applyInArrow(lambda d: asked(d, None, step, "triggers"), MESSAGE)
        else:
            sent = by_block.cogroup(answers.groupBy("block")).applyInArrow(lambda d, a: asked(d, a, step), MESSAGE)
        return sent.groupBy("part").applyInArrow(_answer, MESSAGE)

    def asked(d: pa.Table, a: pa.Table | None, step: str, parse: str = "all") -> pa.Table:
        out = _messages(getattr(Block(d, a, length, trigger, parts, parse), step)())
        tidy()
        return out

    known = ask("ask_suffixes", ask("ask_dictionary", ask("ask_triggers", None)))
    names = [id_col, "n_bytes", "n_removed", "spans", "kept_sha256"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.string()]

    def result(d: pa.Table, a: pa.Table) -> pa.Table:
        rows = Block(d, a, length, trigger, parts, "none").removed(length)
        tidy()
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 5, kinds)], names=names)

    schema = f"{id_col} long, n_bytes long, n_removed long, spans array<int>, kept_sha256 string"
    found = by_block.cogroup(known.groupBy("block")).applyInArrow(result, schema)
    text = F.coalesce(F.col("text"), F.lit(""))
    without = table.where(F.col("doc_id").isNull()).select(
        F.col("doc_id").cast("long").alias(id_col), F.octet_length(text).cast("long"), F.lit(0).cast("long"), F.array().cast("array<int>"), F.sha2(text.cast("binary"), 256))
    return found.union(without)
