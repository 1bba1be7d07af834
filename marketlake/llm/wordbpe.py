"""The word-level BPE file (``word_bpe_49k.json``): vocabulary, merges, and its cut of a text
into pre-tokens. Both the prefix counter and the streaming encoder build on this reading; the
merging itself is theirs.

White space separates pre-tokens and is dropped, so a text is cut at white space first and
each piece ("chunk") is worked out on its own and remembered. Chunks of Latin letters and
ASCII are normalised and cut here; any other chunk goes through the library's own normaliser
and pre-tokeniser, so rare scripts follow its Unicode tables exactly.
"""

from __future__ import annotations

import json

import regex
from tokenizers import Tokenizer

END = "</w>"
#: Characters whose composition, lower case and letter / digit class are the same in every Unicode version.
_PLAIN = regex.compile(r"[\x21-\x7E\xA1-\u024F]*+")
_PRETOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}++|\p{N}|[^\s\p{L}\p{N}]++")
_SPACES = regex.compile(r"[\t-\r \x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]+")


def byte_alphabet() -> dict[int, str]:
    """Byte -> printable character: printable Latin-1 stands for itself, the rest follow from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordBpe:
    """One tokenizer file. ``symbols`` are characters of the byte alphabet, the last one of a
    pre-token with ``</w>`` appended."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.ids: dict[str, int] = spec["model"]["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pieces = {i: s for s, i in (self.ids | self.specials).items()}
        self.rank = {tuple(m): r for r, m in enumerate(spec["model"]["merges"])}
        self.parts = {a + b: (a, b) for a, b in self.rank}
        if len(self.parts) != len(self.rank):
            raise ValueError("two merges make the same token")
        self.to_char = byte_alphabet()
        self.to_byte = {c: b for b, c in self.to_char.items()}
        self._special = regex.compile("(" + "|".join(regex.escape(s) for s in self.specials) + ")")

    def chunks(self, text: str) -> list[str]:
        """The text cut at white space; special strings hold none, so they stay whole."""
        if "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text:
            return [c for c in _SPACES.split(text) if c]  # split() would cut at these four too
        return text.split()

    def pretokens(self, chunk: str) -> list[str | int]:
        """Pre-tokens of one chunk in the byte alphabet; a special token as its id."""
        if "<|" in chunk:
            out: list[str | int] = []
            for part in self._special.split(chunk):
                out += [self.specials[part]] if part in self.specials else self._plain(part) if part else []
            return out
        return self._plain(chunk)

    def _plain(self, part: str) -> list[str]:
        if part.isascii() and part.isalpha():
            return [part.lower()]
        if _PLAIN.fullmatch(part):
            table = self.to_char
            return ["".join([table[b] for b in w.encode()]) for w in _PRETOKEN.findall(part.lower())]
        norm = self.library.normalizer.normalize_str(part)
        return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(norm)]


_OPEN: dict[str, WordBpe] = {}


def open_word_bpe(path: str) -> WordBpe:
    """The file read once in each Python worker."""
    if path not in _OPEN:
        _OPEN[path] = WordBpe(path)
    return _OPEN[path]


class Memo(dict):
    """A dict of bounded size. When full, its entries become the old generation and replace the
    one before; an old entry that is asked for again moves back. So frequent keys stay, and
    memory does not grow with the corpus. ``room`` bounds the characters of keys and (text) values
    too: chunks of scripts without blanks are long."""

    def __init__(self, make, most: int = 250_000, longest: int = 256, room: int | None = None):
        self.make, self.most, self.longest, self.room = make, most, longest, room
        self.old: dict = {}
        self.held = 0

    def __missing__(self, key):
        value = self.old[key] if key in self.old else self.make(key)
        self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(key) <= self.longest:
            size = 0 if self.room is None else len(key) + len(value)
            if len(self) >= self.most or (self.room is not None and self.held + size > self.room):
                self.old, self.held = dict(self), 0
                self.clear()
            self[key] = value
            self.held += size
