"""BPE encoding as a bounded-lookahead streaming transducer, and its decoder.

``sufficient_lookahead`` works out from the merge list alone how many symbols to the right of
a position can still change the tokens that end there. The encoder reads a pre-token symbol by
symbol into a window, merges the window, and emits every token that ends at least that many
symbols before the window's end; what is left is merged again with the symbols that follow.
Restarting at a token border is safe, because a run of tokens of an encoding is the encoding of
that run. So memory is the window, however long the pre-token is.

The decoder is a state machine fed one id at a time; its state is the bytes of a character that
is not complete yet. It turns bytes into text as the tokenizer file says (``decoder``): files
without a decoder join the pieces by spaces, which is what the library's ``decode`` returns.

Null texts count as empty, ids may repeat or be null, other columns are ignored, empty tables
give empty results.
"""

from __future__ import annotations

import codecs
import hashlib
from collections.abc import Iterable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame

from marketlake.llm.common import cache, map_batches
from marketlake.llm.wordbpe import END, Memo, WordBpe, open_word_bpe


_NONE = 1 << 60


def sufficient_lookahead(bpe: WordBpe) -> int:
    """Symbols after the end of a token that can keep it from being final.

    The merge r = (u, v) happens unless, at an earlier rank, a piece x on the right border of v
    is taken by a merge (x, y) with what follows; that merge in turn happens unless a piece on
    the right border of y is taken at a still earlier rank. The reach of r is thus |v| plus the
    longest reach of such an (x, y); going through the merges in rank order, all reaches needed
    are known. A token that ends at the border is disturbed by merges that start with a piece
    of its right border, so the longest reach over all merges suffices.
    """
    def right_border(t: str) -> Iterator[str]:
        while True:
            yield t
            if t not in bpe.parts:
                return
            t = bpe.parts[t][1]

    starting: dict[str, int] = {}  # longest reach of the merges so far, by their left side
    longest = 0
    for u, v in bpe.rank:  # in rank order
        reach = len(v.removesuffix(END)) + max(starting.get(x, 0) for x in right_border(v))
        starting[u] = max(starting.get(u, 0), reach)
        longest = max(longest, reach)
    return longest


class Transducer:
    """Streaming encoder of one pre-token at a time: ``feed`` symbols, ``finish`` at its end."""

    def __init__(self, bpe: WordBpe, lookahead: int):
        self.bpe, self.lookahead = bpe, lookahead
        self.width = 4 * lookahead  # merge again only when this many symbols wait
        self.window: list[str] = []

    def feed(self, symbols: Iterable[str]) -> Iterator[str]:
        symbols, room = iter(symbols), self.width + self.lookahead
        while True:
            self.window += islice(symbols, room - len(self.window))
            if len(self.window) < room:
                return
            yield from self._emit(room - self.lookahead)

    def finish(self) -> Iterator[str]:
        """The pre-token ends: its last symbol takes the end mark, all waiting tokens are final."""
        if self.window:
            self.window[-1] += END
            tokens, self.window = self._merge(self.window), []
            yield from tokens

    def _emit(self, until: int) -> list[str]:
        # the last symbol may still take the end mark, so it is not merged yet
        out, at = [], 0
        for t in self._merge(self.window[:-1]):
            if at + len(t) > until - 1:
                break
            out.append(t)
            at += len(t)
        self.window = self.window[at:]
        return out

    def _merge(self, symbols: list[str]) -> list[str]:
        rank, word = self.bpe.rank.get, list(symbols)
        waiting = [rank(p, _NONE) for p in zip(word, word[1:])]
        while waiting:
            best = min(waiting)
            if best == _NONE:
                break
            i = waiting.index(best)
            word[i:i + 2] = [word[i] + word[i + 1]]
            del waiting[i]
            if i:
                waiting[i - 1] = rank((word[i - 1], word[i]), _NONE)
            if i < len(waiting):
                waiting[i] = rank((word[i], word[i + 1]), _NONE)
        return word


class PieceDecoder:
    """Incremental decoder: ``feed`` an id, get the text that is certain now.

    ``text()`` mode yields the plain text (end marks become spaces, bytes become characters as
    soon as they are complete); the default yields the library's decoding of files without a
    decoder, the pieces joined by single spaces.
    """

    def __init__(self, bpe: WordBpe, text: bool = False):
        self.bpe, self.as_text, self.first = bpe, text, True
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, token_id: int) -> str:
        piece = self.bpe.pieces[token_id]
        if not self.as_text:
            out = piece if self.first else " " + piece
            self.first = False
            return out
        if piece in self.bpe.specials:
            return self.machine.decode(b"", True) + piece
        ends = piece.endswith(END) and len(piece) > len(END)
        body = piece[:-len(END)] if ends else piece
        return self.machine.decode(bytes(self.bpe.to_byte[c] for c in body), ends) + (" " if ends else "")

    def feed_all(self, token_ids: Iterable[int]) -> str:
        """What feeding the ids one by one yields."""
        if self.as_text:
            return "".join(map(self.feed, token_ids))
        out = " ".join(map(self.bpe.pieces.__getitem__, token_ids))
        if not out:
            return ""
        first, self.first = self.first, False
        return out if first else " " + out

    def finish(self) -> str:
        return self.machine.decode(b"", True) if self.as_text else ""


class StreamCoder:
    """Encoder and decoder of one file; remembers the ids of a bounded number of chunks.

    A remembered chunk is one string of decimal ids (that of a single token is shared), since every
    Python worker of an executor holds them; texts are decoded from their ids.
    """

    def __init__(self, path: str):
        self.bpe = open_word_bpe(path)
        self.lookahead = sufficient_lookahead(self.bpe)
        self.decimal = {i: str(i) for i in self.bpe.pieces}
        self.coded = Memo(self._code, most=300_000, room=9_000_000)
        self.coded_word = Memo(self._code_word, most=100_000, room=3_000_000)

    def stream(self, chunks: Iterable[str]) -> Iterator[int]:
        """Token ids of a stream of chunks, each emitted once it is stable."""
        machine, ids = Transducer(self.bpe, self.lookahead), self.bpe.ids
        for chunk in chunks:
            for w in self.bpe.pretokens(chunk):
                if isinstance(w, int):
                    yield w
                else:
                    for t in machine.feed(w):
                        yield ids[t]
                    for t in machine.finish():
                        yield ids[t]

    def _code_word(self, word: str) -> str:
        machine, ids, decimal = Transducer(self.bpe, self.lookahead), self.bpe.ids, self.decimal
        out = [decimal[ids[t]] for t in machine.feed(word)]
        out += [decimal[ids[t]] for t in machine.finish()]
        return " ".join(out)

    def _code(self, chunk: str) -> str:
        """The ids of one chunk in decimal, joined by a space."""
        words = self.bpe.pretokens(chunk)
        if len(words) == 1 and words[0] == chunk:
            return self._code_word(chunk)  # remembered as a chunk
        return " ".join([self.decimal[w] if isinstance(w, int) else self._word(w) for w in words])

    def _word(self, word: str) -> str:
        # lower-case letters are a chunk that stands for itself
        return self.coded[word] if word.isascii() and word.isalpha() and word.islower() else self.coded_word[word]

    def digests(self, text: str) -> tuple[int, str, str]:
        """Token count, digests of the ids in decimal, joined by a space, and of the decoded text."""
        ids = " ".join(filter(None, map(self.coded.__getitem__, self.bpe.chunks(text))))
        tokens = list(map(int, ids.split()))
        decoder = PieceDecoder(self.bpe)
        decoded = decoder.feed_all(tokens) + decoder.finish()
        return len(tokens), hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()

    def encode(self, text: str) -> list[int]:
        return list(self.stream(self.bpe.chunks(text)))

    def decode(self, ids: Iterable[int], text: bool = False) -> str:
        decoder = PieceDecoder(self.bpe, text)
        return decoder.feed_all(ids) + decoder.finish()


_CODERS: dict[str, StreamCoder] = cache("coders")


def coder(path: str) -> StreamCoder:
    if path not in _CODERS:
        _CODERS[path] = StreamCoder(path)
    return _CODERS[path]


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                  keep: bool = False) -> DataFrame:
    """Per document: id, n_tokens, ids_sha256 (decimal ids joined by one space) and
    decoded_sha256. ``keep`` adds ``ids`` and ``decoded`` themselves."""
    extra = ", ids array<int>, decoded string" if keep else ""
    schema = f"{id_col} {docs.schema[id_col].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string{extra}"

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        c = coder(path)

        def texts() -> Iterator[str]:  # text by text: a list of all would be another copy of the batch
            return (t.as_py() or "" for t in batch.column(text_col))

        n, a, b = zip(*map(c.digests, texts())) if batch.num_rows else ((), (), ())
        cols = [batch.column(id_col), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())]
        names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
        if keep:
            ids = [c.encode(t) for t in texts()]
            cols += [pa.array(ids, pa.list_(pa.int32())), pa.array([c.decode(x) for x in ids], pa.string())]
            names += ["ids", "decoded"]
        return pa.RecordBatch.from_arrays(cols, names=names)

    return map_batches(docs.select(id_col, text_col), work, schema, keep="coders")
