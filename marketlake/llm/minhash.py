"""Near-duplicates by bottom-k sketches of one hash function.

A document's set are its distinct shingles of ``width`` words (ASCII letters in lower case; the
whole sequence if shorter). Documents are linked if 100 * intersection >= ``percent`` * union of
their sets, and a component is what links reach.

1. *Sketch*: the k smallest hashes of the set. Documents with equal sets are one class at once;
   only classes go on, so thousands of copies cost as much as one document.
2. *Inverted lists* of the retained hashes. Linked classes share at least ``least_shared`` of
   their hashes (see there), so they meet in the list of one of the ``size - least_shared + 1``
   rarest hashes of either; only those are listed. Hashes of a passage that a third of all
   documents share thus serve last, in documents that hold little else.
3. *Star passes*: every list has a leader, the class with the most shared hashes - of a text and
   its edited copies that is the text, since edits make hashes that nobody shares. Every class
   is compared with the leader it meets most often, then with those of its other lists that
   are in another component still. Large groups of near copies collapse here.
4. *Rest*: classes whose lists still span components are listed anew, by the rarest hashes of
   their full sets, of which a link needs ``percent`` % in common; documents that only share a
   passage part here. Of the pairs of one list in different components those remain that have
   enough hashes which occur elsewhere at all, for their sizes, and bit maps of their sets that
   differ in few enough places. Short lists are joined; long ones are dealt out in pairs of blocks, so that no task holds a whole list,
   and no pair is left out.
5. In all passes the *union sketch* (k smallest of both sketches) estimates the similarity and
   drops pairs that are out of reach, and the exact Jaccard of the full sets decides.

The only chance event is in least_shared: a pair at the threshold is missed with a probability
under one in a million (sets of fewer than about 1.6 k shingles: never).

Null, empty and blank texts have the empty set and are linked with nothing. Ties go to the
smaller id. Rows that repeat an id are judged each by its own text, so an id with two texts can
be in two components; rows without id are linked through their
text but never stand for a group and are always kept. Other columns are ignored; empty tables
give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import BYTE_VALUE, map_batches, mix, staged, tidy

K = 48
#: Least hashes of a union sketch of K that a pair at similarity 0.75 shares, but for one in a
#: million pairs: the quantile of the binomial distribution (48, 0.75), which bounds it.
LIKELY = 21
#: Lists up to this length are joined pair by pair, longer ones in blocks of BLOCK.
SHORT, BLOCK = 48, 512
#: Places of the bit map that bounds the overlap of two full sets.
BITS = 2048

_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True


def shingle_set(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    b = np.frombuffer((text or "").encode(), np.uint8)
    word = ~_BLANK[b]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], word, [False]])))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    # polynomial hash of each word from its own start, then of the words of a shingle
    with np.errstate(over="ignore"):
        place = np.arange(len(b)) - np.repeat(np.concatenate([[0], starts]), np.diff(np.concatenate([[0], starts, [len(b)]])))
        value = BYTE_VALUE[_LOWER[b]] * _powers(int(place.max()) + 1)[place]
        value[~word] = 0
        words = mix(np.add.reduceat(value, starts) + (ends - starts).astype(np.uint64))
        n = len(words) - width + 1
        if n < 1:
            h, n = np.uint64(len(words)), 1
            for w in words:
                h = mix(np.array([h * np.uint64(31) + w]))[0]
            return np.array([h], np.uint64)
        h = np.zeros(n, np.uint64)
        for k in range(width):
            h = mix(h + words[k:k + n] * np.uint64(2 * k + 1))
    return np.unique(h)


_POWERS = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        with np.errstate(over="ignore"):
            _POWERS = np.cumprod(np.full(max(n, 4096), 0x9E3779B97F4A7C15, np.uint64))
    return _POWERS[:n]


def _class_of(s: np.ndarray, doc_id: object) -> bytes:
    return hashlib.blake2b(s.tobytes() if len(s) else f"empty {doc_id}".encode(), digest_size=16).digest()


def sketches(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, class_id, n_shingles, and the sketch where the class is first met in the partition."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            ids, classes, sizes, kept = batch.column(id_col), [], [], []
            for i, t in zip(ids.to_pylist(), batch.column(text_col)):
                s = shingle_set(t.as_py(), width)
                c = _class_of(s, i)
                classes.append(c)
                sizes.append(len(s))
                kept.append(None if c in seen or not len(s) else np.sort(s.view(np.int64))[:K])
                seen.add(c)
            yield pa.RecordBatch.from_arrays([ids, pa.array(classes, pa.binary()), pa.array(sizes, pa.int64()), pa.array(kept, pa.list_(pa.int64()))],
                                             names=["doc_id", "class_id", "n_shingles", "sketch"])
        tidy()

    return docs.select(id_col, text_col).mapInArrow(run, f"doc_id {kind}, class_id binary, n_shingles long, sketch array<long>")


def least_shared(n: Column, percent: int) -> Column:
    """Hashes that the sketch of a class with n shingles shares at least with one it is linked to.

    The union sketch's common hashes are in both sketches. If the union has at most K hashes, it
    is the union and ``percent`` of n are common. Else it is K hashes drawn from the union, of
    which (100 - percent) % at most, and so n * (100 - percent) / percent, are not common.
    """
    whole = F.ceil(n * percent / 100)
    drawn = F.lit(K) - F.floor(n * (100 - percent) / percent)
    likely = F.lit(LIKELY if percent == 75 else max(1, int(K * percent / 100 - 5 * (K * percent * (100 - percent)) ** 0.5 / 100)))
    return F.greatest(F.lit(1), F.when(n <= K, F.least(whole, drawn)).otherwise(F.greatest(drawn, likely)))


def listed(values: DataFrame, sizes: DataFrame, need: Column) -> DataFrame:
    """The inverted lists (hash, cid, n, hub) of the rows (cid, hash): of each class the rarest
    hashes that can matter if a link needs ``need`` common ones, as far as others have them.
    ``sizes`` has cid, n and size, the number of the class's hashes in ``values``. hub orders
    classes by the number of their shared hashes, then by how often these occur."""
    often = values.groupBy("hash").count().where(F.col("count") > 1)
    shared = values.join(often, "hash").groupBy("cid").agg(F.sort_array(F.collect_list(F.struct("count", "hash"))).alias("shared"))
    rows = sizes.join(shared, "cid")
    # hashes of one class only are the rarest and fill the first places
    places = F.col("size") - need + 1 - (F.col("size") - F.size("shared"))
    few = F.slice("shared", F.lit(1), F.greatest(F.lit(0), places).cast("int"))
    hub = F.struct(F.size("shared").alias("shared"), F.aggregate("shared", F.lit(0).cast("long"), lambda a, x: a + x["count"]).alias("often"))
    return rows.select("cid", "n", hub.alias("hub"), F.explode(F.transform(few, lambda x: x["hash"])).alias("hash"))


def by_sketch(classes: DataFrame, percent: int) -> DataFrame:
    return listed(classes.select("cid", F.explode("sketch").alias("hash")), classes.select("cid", "n", F.size("sketch").alias("size")),
                  least_shared(F.col("n"), percent))


def bit_maps(sets: DataFrame) -> DataFrame:
    """(cid, bits): the packed places (hash mod BITS) that a class's set takes."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        bits = [np.packbits(np.bincount((np.frombuffer(m.as_py(), np.uint64) % np.uint64(BITS)).astype(np.int64), minlength=BITS) > 0).tobytes()
                for m in batch.column("members")]
        return pa.RecordBatch.from_arrays([batch.column("cid"), pa.array(bits, pa.binary())], names=["cid", "bits"])

    return map_batches(sets.select("cid", "members"), work, "cid long, bits binary")


def by_full_set(sets: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, m in zip(batch.column("cid").to_pylist(), batch.column("members")):
                h = np.frombuffer(m.as_py(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), i), pa.int64()), pa.array(h)], names=["cid", "hash"])

    sizes = classes.select("cid", "n", F.col("n").alias("size"))
    return listed(sets.mapInArrow(run, "cid long, hash long"), sizes, F.ceil(F.col("n") * percent / 100))


def within_reach(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose union sketch leaves the link possible."""
    side = lambda c: classes.select(F.col("cid").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"s_{c}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    both = F.slice(F.sort_array(F.array_union("s_a", "s_b")), 1, K)
    common = F.size(F.array_intersect(F.array_intersect("s_a", "s_b"), both))
    sizes = (100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    exact = 100 * common >= percent * F.size(both)
    return joined.where(sizes & F.when(F.size(both) < K, exact).otherwise(common >= least_shared(F.least("n_a", "n_b"), percent))).select("a", "b")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets confirm the link."""
    joined = pairs.join(sets.select(F.col("cid").alias("a"), F.col("members").alias("m_a")), "a") \
        .join(sets.select(F.col("cid").alias("b"), F.col("members").alias("m_b")), "b").select("a", "b", "m_a", "m_b")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        good = []
        for x, y in zip(batch.column("m_a"), batch.column("m_b")):
            x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
            common = len(np.intersect1d(x, y, assume_unique=True))
            good.append(100 * common >= percent * (len(x) + len(y) - common))
        return batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return joined.mapInArrow(lambda it: (x for x in map(work, it) if x.num_rows), "a long, b long")


def full_sets(docs: DataFrame, wanted: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(cid, members) of the wanted classes (class_id, cid); every partition sends a class once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            classes, texts = [], []
            for row, (i, t) in enumerate(zip(batch.column(id_col).to_pylist(), batch.column(text_col))):
                s = shingle_set(t.as_py(), width)
                c = _class_of(s, i)
                if len(s) and c not in seen:
                    seen.add(c)
                    classes.append(c)
                    texts.append(row)
            if classes:
                yield pa.RecordBatch.from_arrays([pa.array(classes, pa.binary()), batch.column(text_col).take(pa.array(texts))], names=["class_id", "text"])
        tidy()

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), width).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("cid"), pa.array(sets, pa.binary())], names=["cid", "members"])
        tidy()

    texts = docs.select(id_col, text_col).mapInArrow(run, "class_id binary, text string")
    return texts.join(wanted, "class_id").select("cid", "text").dropDuplicates(["cid"]).mapInArrow(members, "cid long, members binary")


def components(links: DataFrame) -> DataFrame:
    """(cid, component) of every linked class; the component is its smallest cid.

    Alternates the large-star and small-star steps: every class hands its larger neighbours to
    the smallest one it knows, then its smaller ones, until nothing changes. Hubs are handled by
    aggregates and joins, never gathered."""
    edges = staged(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    before = None
    while True:
        state = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if state == before or not state[0]:
            return edges.select(F.col("u").alias("cid"), F.col("v").alias("component"))
        before = state
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        edges = staged(small.where("u <> v").distinct(), "edges")


def met_leaders(lists: DataFrame) -> DataFrame:
    """(a, b, lists, hub): classes with the leaders of their lists, and in how many they meet."""
    leaders = lists.groupBy("hash").agg(F.max(F.struct("hub", "cid")).alias("leader"), F.count("*").alias("length")) \
        .where("length > 1").select("hash", "leader")
    met = lists.select("hash", F.col("cid").alias("a")).join(leaders, "hash").where(F.col("a") != F.col("leader.cid"))
    return met.groupBy("a", F.col("leader.cid").alias("b")).agg(F.count("*").alias("lists"), F.max("leader.hub").alias("hub"))


def apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs (a, b) in different components."""
    side = lambda c: labels.select(F.col("cid").alias(c), F.col("component").alias(f"c_{c}"))
    return pairs.join(side("a"), "a", "left").join(side("b"), "b", "left") \
        .where(F.coalesce("c_a", "a") != F.coalesce("c_b", "b")).select("a", "b")


def open_lists(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """The lists that span components, with length and component of each row."""
    rows = lists.join(labels, "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    spans = rows.groupBy("hash").agg(F.count("*").alias("length"), F.min("component").alias("low"), F.max("component").alias("high")) \
        .where("low <> high").select("hash", "length")
    return rows.join(spans, "hash")


def rest_pairs(lists: DataFrame, labels: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of a list in different components whose sizes, and numbers of hashes that
    others have too, allow a link; pairs of long lists also share enough hashes of their sketches."""
    left_over = open_lists(lists, labels).select("cid").distinct()
    exact = by_full_set(sets.join(left_over, "cid", "left_semi"), classes, percent)
    rows = staged(open_lists(staged(exact, "full-lists"), labels).withColumn("shared", F.col("hub.shared")).drop("hub"), "open-lists")
    n_a, n_b = F.col("n_a"), F.col("n_b")
    # common hashes are at least percent / (100 + percent) of both sizes, and occur elsewhere
    possible = (100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)) \
        & ((100 + percent) * F.least("shared_a", "shared_b") >= percent * (n_a + n_b))

    short = rows.where(F.col("length") <= SHORT)
    left = short.select("hash", F.col("cid").alias("a"), F.col("n").alias("n_a"), F.col("shared").alias("shared_a"), F.col("component").alias("c_a"))
    right = short.select("hash", F.col("cid").alias("b"), F.col("n").alias("n_b"), F.col("shared").alias("shared_b"), F.col("component").alias("c_b"))
    few = left.join(right, "hash").where((F.col("a") < F.col("b")) & (F.col("c_a") != F.col("c_b")) & possible).select("a", "b")

    n_blocks = F.ceil(F.col("length") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("cid"), n_blocks).cast("int")
    dealt = rows.where(F.col("length") > SHORT).join(classes.select("cid", "sketch"), "cid").join(bit_maps(sets), "cid") \
        .withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), n_blocks - 1))) \
        .select("hash", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "cid", "n", "shared", "component", "sketch", "bits")

    def block_pairs(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        _, i, j = key
        x, y = (rows[rows["own"] == k].reset_index(drop=True) for k in (i, j))
        sketches = [*x["sketch"], *y["sketch"]]
        _, at, often = np.unique(np.concatenate(sketches) if sketches else np.empty(0), return_inverse=True, return_counts=True)
        column = np.where(often > 1, np.cumsum(often > 1) - 1, -1)[at]  # only hashes of two rows matter
        row = np.repeat(np.arange(len(sketches)), [len(s) for s in sketches])
        held = np.zeros((len(sketches), max(1, int((often > 1).sum()))), np.float32)
        held[row[column >= 0], column[column >= 0]] = 1
        common = held[:len(x)] @ held[len(x):].T
        n_x, n_y = x["n"].to_numpy()[:, None], y["n"].to_numpy()[None, :]
        small, big = np.minimum(n_x, n_y), np.maximum(n_x, n_y)
        bits_x, bits_y = (np.unpackbits(np.frombuffer(b"".join(z["bits"]), np.uint8).reshape(len(z), -1), axis=1).astype(np.float32) for z in (x, y))
        both = bits_x @ bits_y.T
        # a place that only one of two sets takes holds at least one hash the other does not have
        most = np.minimum(n_x - bits_x.sum(1)[:, None] + both, n_y - bits_y.sum(1)[None, :] + both)
        enough = np.minimum(most, np.minimum(x["shared"].to_numpy()[:, None], y["shared"].to_numpy()[None, :]))
        good = (100 * small >= percent * big) & ((100 + percent) * enough >= percent * (n_x + n_y)) & (x["component"].to_numpy()[:, None] != y["component"].to_numpy()[None, :])
        need = np.where(small <= K, np.minimum(np.ceil(small * percent / 100), K - small * (100 - percent) // percent),
                        np.maximum(K - small * (100 - percent) // percent, LIKELY if percent == 75 else 1))
        r, c = np.nonzero(good & (common >= np.maximum(1, need)))
        a, b = x["cid"].to_numpy()[r], y["cid"].to_numpy()[c]
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}).drop_duplicates()

    many = dealt.groupBy("hash", "i", "j").applyInPandas(block_pairs, "a long, b long")
    return few.union(many).distinct()


def class_ids(docs: DataFrame, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the class (``class_id``) of each row's text, as in :func:`near_duplicates`."""

    @F.arrow_udf("binary")
    def class_of(ids: pa.Array, texts: pa.Array) -> pa.Array:
        return pa.array([_class_of(shingle_set(t.as_py(), width), i.as_py()) for i, t in zip(ids, texts)], pa.binary())

    return docs.withColumn("class_id", class_of(id_col, text_col))


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of every component the row with the smallest id,
    one row if several have that id; rows without id all stay.

    An id that occurs once is decided by the id. The rows of an id that repeats are decided each by
    the class of its own text, which is computed again for these rows only."""
    found = staged(near_duplicates(docs, width, percent, id_col, text_col, with_class=True).where(F.col(id_col).isNotNull()), "decided")
    repeated = staged(found.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(id_col), "repeated")
    out = docs.join(found.where("not kept").select(id_col).union(repeated).distinct(), id_col, "left_anti").select(docs.columns)
    standing = found.join(repeated, id_col, "left_semi").where("kept").groupBy(id_col, "group_id").agg(F.min("class_id").alias("class_id"))
    again = class_ids(docs.join(repeated, id_col, "left_semi").select(docs.columns), width, id_col, text_col)
    one = again.join(standing.select(id_col, "class_id"), [id_col, "class_id"]).groupBy(id_col, "class_id").agg(F.min(F.struct(*docs.columns)).alias("row"))
    return out.union(one.select("row.*"))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text",
                    with_class: bool = False) -> DataFrame:
    """Per row of ``docs``: id, n_shingles, component_id (smallest id of the component) and kept;
    ``with_class`` adds class_id, which equal sets share, and group_id, which linked classes share
    (two components can have one component_id where an id repeats)."""
    rows = staged(sketches(docs, width, id_col, text_col), "sketches")
    classes = staged(rows.where(F.col("sketch").isNotNull()).groupBy("class_id").agg(F.max("n_shingles").alias("n"), F.first("sketch").alias("sketch"))
                     .withColumn("cid", F.monotonically_increasing_id()), "classes")
    lists = staged(by_sketch(classes, percent), "lists")
    wanted = lists.select("cid").distinct().join(classes.select("cid", "class_id"), "cid")
    sets = staged(full_sets(docs, wanted, width, id_col, text_col), "sets")

    def joined_by(pairs: DataFrame, labels: DataFrame | None) -> DataFrame:
        """Components after the links among the pairs are added."""
        links = verified(staged(within_reach(pairs, classes, percent), "pairs"), sets, percent)
        return components(links if labels is None else labels.select(F.col("cid").alias("a"), F.col("component").alias("b")).union(links))

    met = staged(met_leaders(lists), "leaders")
    most = met.groupBy("a").agg(F.max(F.struct("lists", "hub", "b")).alias("best")).select("a", "best.b")
    labels = joined_by(most, None)
    labels = joined_by(apart(met, labels), labels)
    labels = joined_by(rest_pairs(lists, labels, classes, sets, percent), labels)

    # a class without links is its own component; classes of one component share its smallest id
    named = labels.join(classes.select("cid", "class_id"), "cid").select("class_id", "component") \
        .union(labels.select("component").distinct().join(classes.select(F.col("cid").alias("component"), "class_id"), "component").select("class_id", "component"))
    firsts = rows.groupBy("class_id").agg(F.min("doc_id").alias("first"))
    joined = firsts.join(named, "class_id", "left")
    group = staged(joined.where(F.col("component").isNotNull()), "groups")
    of_group = group.join(group.groupBy("component").agg(F.min("first").alias("smallest"), F.min("class_id").alias("group_id")), "component") \
        .select("class_id", "smallest", "group_id")
    of_class = joined.where(F.col("component").isNull()).select("class_id", F.col("first").alias("smallest"), F.col("class_id").alias("group_id")).union(of_group)
    return rows.join(of_class, "class_id").select(
        F.col("doc_id").alias(id_col), "n_shingles", F.col("smallest").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.col("smallest"), F.lit(True)).alias("kept"), *(["class_id", "group_id"] if with_class else []))
