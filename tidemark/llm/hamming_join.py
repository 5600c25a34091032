"""Near-duplicate components: b-bit MinHash signatures joined by Hamming distance over several indexes.

A signature has 64 positions of 8 bits. Its distance to another is the number of positions that differ. The positions
are split into 12 chunks; signatures at a distance of at most 23 differ in at most one position of some chunk (24
would be needed to have two in each), so each chunk is indexed once for each position that may be wrong, without that
position: 64 keys a signature. Every pair within the distance has a common key, whatever the data. A pair of similarity
0.85 is farther apart than 23 with probability 8e-6, a more similar pair with less.

Documents with equal sets are one class and are looked at once. Pairs are never listed within a bucket:

1. Each class meets the smallest of each of its buckets; those near enough are compared exactly. This joins most of
   what belongs together.
2. Buckets that still hold several components are compared in blocks by signature, only across components, and give one
   row for each class that is near another.
3. What hangs together by such near pairs is compared exactly, in blocks, again only across components.

Steps 2 and 3 make the result whole: every pair with a common key is either within one component or compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ready, written
from tidemark.llm.components import connected
from tidemark.llm.jaccard_join import set_hashes, shingle_sets
from tidemark.llm.words import mix, text_slices

SHINGLE = 3
#: A link: 100 times the common shingles are at least so many times all shingles of the two.
PERCENT = 85
POSITIONS = 64
CHUNKS = 12
#: The largest distance with a common key for certain: one position of each chunk may be wrong, and one chunk more.
REACH = 2 * CHUNKS - 1
WORDS64 = [f"s{i}" for i in range(POSITIONS // 8)]
#: Signatures of one side of a block that is compared in memory.
BLOCK_SIGNATURES = 4000
#: Classes and shingles of one side of a block that is compared exactly.
BLOCK_CLASSES = 2000
BLOCK_SHINGLES = 400_000

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
BYTE_ONES = 0x0101010101010101

# ------------------------------------------------------------------ signatures and keys


def signatures(owner: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Per text with shingles, eight 64-bit words: the low byte of the least hash of its set for each position."""
    first = np.unique(owner, return_index=True)[1]
    seeds = mix(np.arange(1, POSITIONS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    out = np.zeros((len(first), POSITIONS), np.uint8)
    for p in range(POSITIONS if len(first) else 0):
        h = (key ^ seeds[p]) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        out[:, p] = mix(np.minimum.reduceat(h, first)) & np.uint64(255)
    return out.view("<u8")


def chunk_starts() -> np.ndarray:
    return np.arange(CHUNKS) * POSITIONS // CHUNKS


def index_keys(signature: np.ndarray) -> np.ndarray:
    """Per signature (eight words) a key for each position: a hash of the rest of the chunk that holds it."""
    values = np.ascontiguousarray(signature, "<u8").view(np.uint8)
    places = np.arange(POSITIONS, dtype=np.uint64)
    part = mix(values.astype(np.uint64) + places * np.uint64(256) + np.uint64(1 << 32))
    starts = chunk_starts()
    sums = np.add.reduceat(part, starts, axis=1)
    chunk = np.searchsorted(starts, np.arange(POSITIONS), "right") - 1
    return mix(sums[:, chunk] - part + mix(places + np.uint64(1 << 48))).view(np.int64)


SIGNED = "id long, h1 long, h2 long, n long, " + ", ".join(f"{w} long" for w in WORDS64)


def sign_batches(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """Rows of SIGNED from rows (doc_id, text), for the texts that have a word."""
    for batch in batches:
        ids = batch.column(0)
        for a, _, data, offsets in text_slices(batch.column(1)):
            owner, key = shingle_sets(LOWER[data], offsets, n)
            own, size = np.unique(owner, return_counts=True)
            if not len(own):
                continue
            columns = [*set_hashes(owner, key), size, *signatures(owner, key).view(np.int64).T]
            arrays = [ids.take(pa.array(own + a)), *[pa.array(np.ascontiguousarray(c)) for c in columns]]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "h1", "h2", "n", *WORDS64])


def key_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, id) from rows (id, s0 ... s7)."""
    for batch in batches:
        ids = batch.column(0).to_numpy()
        words = np.stack([c.to_numpy() for c in batch.columns[1:]], axis=1)
        keys = index_keys(words) if len(ids) else np.zeros((0, POSITIONS), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(ids, POSITIONS))], names=["key", "id"])


def set_batches(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """Rows (id, h1, h2, shingles) from rows (doc_id, text)."""
    for batch in batches:
        ids = batch.column(0)
        for a, _, data, offsets in text_slices(batch.column(1)):
            owner, key = shingle_sets(LOWER[data], offsets, n)
            own, size = np.unique(owner, return_counts=True)
            if len(own):
                cuts = pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32())
                sets = pa.ListArray.from_arrays(cuts, pa.array(key.view(np.int64)))
                h1, h2 = set_hashes(owner, key)
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(own + a)), pa.array(h1), pa.array(h2), sets], names=["id", "h1", "h2", "shingles"])


# ------------------------------------------------------------------ distances


def distance(left: str, right: str) -> Column:
    """Positions that differ between the words of two aliases: bytes of the exclusive or that are not zero."""

    def bytes_set(x: Column) -> Column:
        for bits in (4, 2, 1):
            x = x.bitwiseOR(F.shiftrightunsigned(x, bits))
        return F.bit_count(x.bitwiseAND(F.lit(BYTE_ONES).cast("long")))

    return sum((bytes_set(F.col(f"{left}.{w}").bitwiseXOR(F.col(f"{right}.{w}"))) for w in WORDS64), F.lit(0))


def distances(words: np.ndarray, one: np.ndarray) -> np.ndarray:
    """The same for one signature against many."""
    x = words ^ one
    for bits in (4, 2, 1):
        x |= x >> np.uint64(bits)
    return np.bitwise_count(x & np.uint64(BYTE_ONES)).sum(axis=1)


def sizes_fit(a, b, percent: int):
    """False for sizes of sets that cannot be similar enough (of columns or arrays): the common part is at most the smaller."""
    return (100 * a >= percent * b) & (100 * b >= percent * a)


class Block:
    """The rows of two sides that meet in one task, with a label for each that starts as its component."""

    def __init__(self, same: bool, side: np.ndarray, comp: np.ndarray, n: np.ndarray, words: np.ndarray, percent: int):
        self.same, self.side, self.n, self.words, self.percent = same, side, n, words, percent
        self.label = comp.copy()

    def searchers(self) -> np.ndarray:
        """All rows but those of the most frequent component: one row of every pair across components is among them."""
        names, count = np.unique(self.label, return_counts=True)
        return np.flatnonzero(self.label != names[count.argmax()])

    def near(self, a: int, apart: np.ndarray) -> np.ndarray:
        """Rows that row ``a`` must be compared with: another label in ``apart``, fitting size, distance within reach."""
        rows = np.flatnonzero((apart != apart[a]) & sizes_fit(self.n, self.n[a], self.percent))
        if not self.same:
            rows = rows[self.side[rows] != self.side[a]]
        return rows[distances(self.words[rows], self.words[a]) <= REACH]

    def join(self, names: np.ndarray, a: int, rows: np.ndarray) -> None:
        """Give the groups of ``a`` and of ``rows`` in ``names`` one name, the smallest."""
        met = np.unique(np.append(names[rows], names[a]))
        names[np.isin(names, met)] = met[0]


def run_rows(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[pa.Table]:
    """The rows of each group, one table each, from rows sorted by the first ``n_keys`` integer columns."""
    held: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(k).to_numpy() for k in range(n_keys)], axis=1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(keys)], strict=True):
            if now is not None and not (keys[a] == now).all():
                yield pa.Table.from_batches(held)
                held = []
            now = keys[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def block_of(rows: pa.Table, percent: int) -> Block:
    """From columns group, i, j, side, id, comp, n, s0 ... s7."""
    values = {name: rows.column(name).to_numpy() for name in ("i", "j", "side", "comp", "n")}
    words = np.stack([rows.column(w).to_numpy() for w in WORDS64], axis=1).view(np.uint64)
    return Block(values["i"][0] == values["j"][0], values["side"], values["comp"], values["n"], words, percent)


def near_batches(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows (id, root): the smallest id that an id hangs together with by near pairs of a block."""
    for rows in run_rows(batches, 3):
        block, ids = block_of(rows, percent), rows.column("id").to_numpy()
        names, found = ids.copy(), np.zeros(len(ids), bool)
        for a in block.searchers():
            near = block.near(a, block.label)
            if len(near):
                found[near] = found[a] = True
                block.join(names, a, near)
        if found.any():
            yield pa.RecordBatch.from_arrays([pa.array(ids[found]), pa.array(names[found])], names=["id", "root"])


def link_batches(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows (a, b) of components that an exact link joins, from the columns of ``block_of`` and shingles."""
    for rows in run_rows(batches, 3):
        block, comp = block_of(rows, percent), rows.column("comp").to_numpy()
        lists = rows.column("shingles").combine_chunks()
        cuts, keys = lists.offsets.to_numpy(), lists.values.to_numpy().view(np.uint64)
        for a in block.searchers():
            near = block.near(a, block.label)
            if len(near):
                own = keys[cuts[a] : cuts[a + 1]]
                common = np.array([np.count_nonzero(own[np.searchsorted(own[:-1], keys[cuts[b] : cuts[b + 1]])] == keys[cuts[b] : cuts[b + 1]]) for b in near])
                linked = near[100 * common >= percent * (block.n[near] + block.n[a] - common)]
                if len(linked):
                    block.join(block.label, a, linked)
        moved = np.unique(np.stack([comp, block.label], axis=1)[comp != block.label], axis=0)
        if len(moved):
            yield pa.RecordBatch.from_arrays([pa.array(moved[:, 0]), pa.array(moved[:, 1])], names=["a", "b"])


def in_blocks(rows: DataFrame, group: str, blocks: Column, columns: list[str]) -> DataFrame:
    """Rows (group, i, j, side, columns) dealt so that any two rows of a group meet in the task of some (i, j)."""
    placed = rows.withColumn("_blocks", F.greatest(blocks.cast("long"), F.lit(1))).withColumn("_own", F.pmod(F.xxhash64("id"), F.col("_blocks")))
    spread = placed.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
    dealt = spread.select(
        group, F.least("_own", "_other").alias("i"), F.greatest("_own", "_other").alias("j"), (F.col("_own") > F.col("_other")).alias("side"), *columns
    )
    order = [group, "i", "j"]
    return dealt.repartition(*order).sortWithinPartitions(*order)


# ------------------------------------------------------------------ the operator


def near_components(
    docs: DataFrame,
    n: int = SHINGLE,
    percent: int = PERCENT,
    block_signatures: int = BLOCK_SIGNATURES,
    block_classes: int = BLOCK_CLASSES,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """One row for each doc_id: doc_id, n_shingles, component_id, kept.

    Words are runs without white space after lower-casing A-Z; a document's set is its distinct shingles of ``n``
    words, or its whole sequence of words if it has fewer. Two documents are linked if 100 times their common shingles
    are at least ``percent`` times all shingles of both; ``component_id`` is the smallest doc_id that is reached over
    links. Null texts and texts without a word have no shingle and no link.

    Rows of one doc_id are one document: it has the links of all its texts, and the size of its largest set. Rows
    without a doc_id come back one by one with their own size, component_id and kept null; they are linked with
    nothing. An empty table gives an empty one. Other columns are not read.
    """
    ready(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = written(texts.mapInArrow(lambda b: sign_batches(b, n), SIGNED), "hamming-signatures")
    named = signed.filter("id IS NOT NULL")
    first = [F.any_value(c).alias(c) for c in ("n", *WORDS64)]
    classes = written(named.groupBy("h1", "h2").agg(F.min("id").alias("id"), *first), "hamming-classes")
    members = written(named.select("id", "h1", "h2", "n").join(classes.select("h1", "h2", F.col("id").alias("head")), ["h1", "h2"]).select("id", "head", "n"), "hamming-members")

    keyed = classes.select("id", *WORDS64).mapInArrow(key_batches, "key long, id long")
    buckets = keyed.groupBy("key").agg(F.min("id").alias("head"), F.count("*").alias("size")).filter("size > 1")
    meets = written(keyed.join(written(buckets, "hamming-buckets"), "key"), "hamming-meets")

    by_head = first_links(texts, meets, classes, n, percent)
    parts = connected(by_head).select(F.col("node").alias("id"), F.col("root").alias("comp"))
    rest = later_links(texts, meets, classes, parts, n, percent, block_signatures, block_classes, block_shingles)

    several = members.groupBy("id").agg(F.min("head").alias("h"), F.max("head").alias("g")).filter("h <> g")
    own = members.join(several, "id").select(F.col("head").alias("a"), F.col("h").alias("b"))
    roots = connected(by_head.unionByName(rest).unionByName(own)).select(F.col("node").alias("head"), "root")
    placed = members.join(written(roots, "hamming-roots"), "head", "left").groupBy("id").agg(
        F.max("n").alias("n_shingles"), F.min(F.coalesce("root", "head")).alias("component_id")
    )
    ids = texts.filter("doc_id IS NOT NULL").select("doc_id").distinct()
    found = ids.join(placed.withColumnRenamed("id", "doc_id"), "doc_id", "left").select(
        "doc_id", F.coalesce("n_shingles", F.lit(0).cast("long")).alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )
    nameless = signed.filter("id IS NULL").select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("id").alias("component_id"))
    wordless = texts.filter("doc_id IS NULL AND NOT coalesce(text, '') RLIKE '[^\\\\x20\\\\x09-\\\\x0D]'").select(
        "doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id")
    )
    return found.unionByName(nameless).unionByName(wordless).withColumn("kept", F.col("doc_id") == F.col("component_id"))


def sets_of(texts: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """(id, h1, h2, shingles) of the texts whose doc_id is in ``ids`` (id)."""
    # The same plan at every size: the wanted ids are never broadcast.
    wanted = texts.join(ids.select(F.col("id").alias("doc_id")).distinct().hint("merge"), "doc_id", "left_semi")
    return wanted.mapInArrow(lambda b: set_batches(b, n), "id long, h1 long, h2 long, shingles array<long>")


def first_links(texts: DataFrame, meets: DataFrame, classes: DataFrame, n: int, percent: int) -> DataFrame:
    """Exact links (a, b) between classes and the smallest of their buckets."""
    signature = classes.select("id", "n", *WORDS64)
    pairs = meets.filter("id <> head").select(F.col("id").alias("a"), F.col("head").alias("b")).distinct()
    both = pairs.join(signature.alias("l"), F.col("l.id") == F.col("a")).join(signature.alias("r"), F.col("r.id") == F.col("b"))
    near = both.filter((distance("l", "r") <= REACH) & sizes_fit(F.col("l.n"), F.col("r.n"), percent)).select("a", "b").distinct()
    near = written(near, "hamming-near")
    sets = written(sets_of(texts, near.select(F.col("a").alias("id")).unionByName(near.select(F.col("b").alias("id"))), n), "hamming-sets")
    filled = near.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b"
    )
    counted = filled.select("a", "b", (F.size("x") + F.size("y")).alias("both"), F.size(F.array_intersect("x", "y")).alias("common"))
    linked = counted.filter(F.lit(100) * F.col("common") >= F.lit(percent) * (F.col("both") - F.col("common")))
    return written(linked.select("a", "b").distinct(), "hamming-links")


def later_links(
    texts: DataFrame, meets: DataFrame, classes: DataFrame, parts: DataFrame, n: int, percent: int,
    block_signatures: int, block_classes: int, block_shingles: int,
) -> DataFrame:
    """Links (a, b) between the components ``parts`` (id, comp) of classes that share a bucket, compared in blocks."""
    parts = written(parts, "hamming-parts")
    labelled = written(meets.join(parts, "id", "left").select("key", "id", F.coalesce("comp", "id").alias("comp")), "hamming-labelled")
    mixed = labelled.groupBy("key").agg(F.count("*").alias("size"), F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low <> high")
    open_rows = labelled.join(mixed.select("key", "size"), "key").join(classes.select("id", "n", *WORDS64), "id")
    columns = ["id", "comp", "n", *WORDS64]
    blocks = in_blocks(open_rows, "key", F.ceil(F.col("size") / F.lit(block_signatures)), columns)
    near = written(blocks.mapInArrow(lambda b: near_batches(b, percent), "id long, root long"), "hamming-near-blocks")

    groups = written(connected(near.select(F.col("id").alias("a"), F.col("root").alias("b"))).select(F.col("node").alias("id"), F.col("root").alias("grp")), "hamming-groups")
    rows = groups.join(classes, "id").join(parts, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    bound = F.greatest(F.ceil(F.sum("n") / F.lit(block_shingles)), F.ceil(F.count("*") / F.lit(block_classes)))
    sizes = rows.groupBy("grp").agg(bound.alias("size"))
    filled = rows.join(sizes, "grp").join(sets_of(texts, groups, n), ["id", "h1", "h2"])
    dealt = in_blocks(filled, "grp", F.col("size"), [*columns, "shingles"])
    return written(dealt.mapInArrow(lambda b: link_batches(b, percent), "a long, b long"), "hamming-more-links")

