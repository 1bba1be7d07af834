"""op3 and op8 against the tokenizers library; op10 against a plain version."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
import tracemalloc
from collections import Counter

import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from conftest import SF001
from llm.conftest import EDGES
from marketlake.llm.bpe_stream import PieceDecoder, StreamCoder, Transducer, encode_decode, sufficient_lookahead
from marketlake.llm.fertility import FertilityRules, fertility, measure, quality_rules, script_of
from marketlake.llm.token_counts import PrefixCounter, count_tokens
from marketlake.llm.wordbpe import Memo, open_word_bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
COUNTER, CODER = PrefixCounter(PATH), StreamCoder(PATH)


def ids_of(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


PIECES = ["a", "in", "tion", " ", "  ", "\n", "'s", "'re", "'", "<|endoftext|>", "<|startoftext|>", "<|", "é", "É", "İ", "Σ", "ß", "́", "漢", "😀",
          "\x85", "\xa0", "\x1c", "7", "42", "...", "###", "the", "xyzzy", "ing", "ſ", "ﬁ"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=25).map("".join))
def test_counts_and_codes_equal_the_library(text):
    want = ids_of(text)
    assert (COUNTER.sums(text) or [0])[-1] == len(want)
    assert CODER.encode(text) == want
    assert CODER.decode(want) == LIBRARY.decode(want, skip_special_tokens=False)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abcdeinrst 'é", max_size=40), st.integers(0, 12))
def test_longest_prefix_is_the_longest(text, budget):
    fits = [i for i in range(len(text) + 1) if len(ids_of(text[:i])) <= budget]
    assert len(COUNTER.longest_prefix(text, budget)) == max(fits)


def test_every_prefix_has_its_count():
    for word in ("internationalization", "thethethe", "aaaaaaaaaaa", "zyzzyva", "don", "é" * 5):
        mapped = COUNTER.bpe.pretokens(word)[0]
        cells = COUNTER.table(mapped)
        for i in range(1, len(word) + 1):
            assert cells[len(word[:i].encode())] == len(ids_of(word[:i]))


def test_transducer_emits_before_the_end_and_keeps_a_bounded_window():
    bpe = open_word_bpe(PATH)
    look = sufficient_lookahead(bpe)
    rng = random.Random(5)
    vocabulary = [p for p in bpe.ids if p.isascii() and p.isalpha() and p.islower()]
    word = "".join(rng.choices(vocabulary, k=4000))
    machine, out, widest = Transducer(bpe, look), [], 0
    for at in range(0, len(word), 100):
        out += machine.feed(word[at:at + 100])
        widest = max(widest, len(machine.window))
    early = len(out)
    out += machine.finish()
    assert early > 0 and widest <= machine.width + look
    assert [bpe.ids[t] for t in out] == ids_of(word)


def test_text_decoding_is_incremental():
    assert CODER.decode(CODER.encode("Höhle and café <|endoftext|>"), text=True) == "höhle and café <|endoftext|>"


def test_memo_is_bounded():
    memo = Memo(lambda k: k * 2, most=10)
    for k in range(100):
        assert memo[str(k)] == str(k) * 2
    assert len(memo) <= 10 and len(memo.old) <= 10


def test_memo_is_bounded_by_characters():
    memo = Memo(lambda k: k * 2, most=1000, room=3000)
    for k in range(100):
        assert memo[f"{k:0100}"] == f"{k:0100}" * 2
        assert memo[f"{0:0100}"] == "0" * 200  # asked for again and again
    assert sum(3 * len(k) for k in memo) <= 3000 and sum(3 * len(k) for k in memo.old) <= 3000


def test_coder_remembers_a_chunk_in_little_memory():
    """Every Python worker of an executor holds hundreds of thousands of them."""
    rng, coder = random.Random(3), StreamCoder(PATH)
    chunks = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=8)) for _ in range(4000)]
    chunks += [c.capitalize() + "," for c in chunks]
    text = " ".join(chunks)
    tracemalloc.start()
    try:
        n, ids, decoded = coder.digests(text)
        held = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    want = ids_of(text)
    assert (n, ids, decoded) == (len(want), sha(" ".join(map(str, want))), sha(LIBRARY.decode(want, skip_special_tokens=False)))
    assert held / len(chunks) < 230


def test_decoder_takes_ids_in_parts():
    ids = CODER.encode("Höhle and café <|endoftext|> 漢字!")
    for text in (False, True):
        for at in range(len(ids) + 1):
            whole, parts = PieceDecoder(CODER.bpe, text), PieceDecoder(CODER.bpe, text)
            assert parts.feed_all(ids[:at]) + parts.feed_all([]) + parts.feed_all(ids[at:]) + parts.finish() == \
                "".join(map(whole.feed, ids)) + whole.finish()


def test_count_tokens_on_edges(docs):
    rows = count_tokens(docs(EDGES), PATH).collect()
    assert len(rows) == len(EDGES)
    want = Counter((i, len((t or "").encode()), len(ids_of(t or ""))) for i, t in EDGES)
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in rows) == want
    for r in rows:
        assert r.over_limit == (r.n_tokens > 2048)
        assert r.limit_bytes == r.n_bytes if not r.over_limit else r.limit_bytes < r.n_bytes
    assert count_tokens(docs([]), PATH).collect() == []


def test_kept_sums_answer_budgets(docs):
    row = count_tokens(docs([(1, "one two three four")]), PATH, keep_sums=True).first()
    assert row.chunk_sums == [len(ids_of(t)) for t in ("one", "one two", "one two three", "one two three four")]


def test_encode_decode_on_edges_and_documents(docs, spark):
    def want(t):
        ids = ids_of(t or "")
        return len(ids), sha(" ".join(map(str, ids))), sha(LIBRARY.decode(ids, skip_special_tokens=False))
    rows = encode_decode(docs(EDGES), PATH).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == Counter((i, *want(t)) for i, t in EDGES)
    table = spark.read.parquet(f"{SF001}/documents.parquet")
    texts = {r.doc_id: r.text for r in table.collect()}
    for r in encode_decode(table, PATH, keep=True).collect():
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == want(texts[r.doc_id])
        assert r.ids == ids_of(texts[r.doc_id])
    assert encode_decode(docs([]), PATH).collect() == []


PIECE = public_tokenizers.path("piece_bpe_32k.model")


def plain_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    twice = Counter(windows)
    covered = {j for i, w in enumerate(windows) if twice[w] > 1 for j in range(i, i + 8)}
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed


def plain_figures(text):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    ids = [i for w in words for i in model.encode(w)]
    if not ids:
        return 0, 0.0, 0.0, 0.0
    p = [c / len(ids) for c in Counter(ids).values()]
    return len(ids), sum(map(len, words)) / len(ids), sum(map(model.is_byte, ids)) / len(ids), -sum(x * math.log2(x) for x in p)


def test_quality_rules_against_plain_version(docs, spark):
    table = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    more = [(900, "a b c d e f g h " * 10), (901, "x\ny\nx\n \n \nx"), (902, "漢字かな" * 30 + " " + "ж " * 30), (903, "Ã©Â¤" * 200)]
    rows = {r.doc_id: r for r in quality_rules(docs(table + more), PIECE).collect()}
    assert len(rows) == len(table) + len(more)
    for i, t in table + more:
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain_base(t)
        n, per, fallback, entropy = plain_figures(t)
        assert r.n_tokens == n and math.isclose(r.chars_per_token, per) and math.isclose(r.fallback_share, fallback)
        assert math.isclose(r.token_entropy, entropy, abs_tol=1e-9)
        assert not (r.base_failed and r.kept)


def test_quality_rules_edges_and_bands(docs, spark):
    rows = quality_rules(docs(EDGES), PIECE).collect()
    assert len(rows) == len(EDGES) and all(r.n_words == 0 and r.base_failed and not r.kept for r in rows if r.doc_id in (1, 2, 3))
    assert quality_rules(docs([]), PIECE).collect() == []
    f, rules = fertility(PIECE), FertilityRules()
    prose = spark.read.parquet(f"{SF001}/documents.parquet").where("lang = 'en' and n_chars > 2000").orderBy("doc_id").first().text
    few = " ".join(f"word{i % 10} and another sentence about rivers" for i in range(60))
    noise = " ".join("".join(chr(random.Random(i * 97 + k).randrange(0xA1, 0x2AF)) for k in range(12)) for i in range(60))
    kept = lambda t: measure(t, f, rules)[6]
    assert kept(prose) and not kept(noise) and not kept(few)


def test_script_of():
    assert [script_of(t) for t in ("abc", "", "12 !", "привет мир", "漢字漢字 ab", "नमस्ते", "déjà vu")] == \
        ["Latin", "None", "None", "Cyrillic", "Han", "Other", "Latin"]


def test_bands_reject_noise_and_keep_clean_prose(spark):
    """Random letters, base64, hex, mojibake and symbols go; clean labelled prose stays."""
    f, rules, rng = fertility(PIECE), FertilityRules(), random.Random(5)
    labels = spark.read.parquet(f"{SF001}/labels.parquet").where("quality = 1").select("doc_id")
    clean = [r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").join(labels, "doc_id").where("n_chars > 600").collect()]
    clean = [t for t in clean if not measure(t, f, rules)[5]]
    kept = lambda t: measure(t, f, rules)[6]
    assert len(clean) > 10 and sum(map(kept, clean)) >= 0.98 * len(clean)
    noise = [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 10))) for _ in range(150)),
             " ".join(base64.b64encode(rng.randbytes(12)).decode() for _ in range(60)), " ".join(rng.randbytes(8).hex() for _ in range(60))]
    german = "Über die schöne Brücke führt eine Straße für alle Bürger, die später größere Wälder und Flüsse hören können, wenn der Frühling kommt und die Vögel zurückkehren."
    french = "La forêt où l'été précède la fenêtre brûlée, très près du château, a été protégée à côté de la rivière, et les élèves y ont marché toute la journée."
    assert kept(german) and kept(french)
    for charset in ("latin-1", "cp1252"):
        noise += [t.encode().decode(charset, "ignore") for t in (german, french)]
    noise += [" ".join(w + rng.choice(["###", "$$$", "%%%", "***"]) for w in t.split()) for t in clean]
    assert not any(map(kept, noise))


def test_workers_drop_the_coder_when_another_operator_ends():
    """Its memos hold more than 100 MB in each Python worker; tasks of its own keep it."""
    from marketlake.llm import bpe_stream, common
    common.cache("coders")["file"] = object()
    common.tidy("coders")
    assert "file" in bpe_stream._CODERS
    common.tidy()
    assert not bpe_stream._CODERS
