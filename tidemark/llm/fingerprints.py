"""Document fingerprints from spot signatures: chains of content words after common words. Built-in functions only.

The likeness of two texts is the Jaccard similarity of their sets of signatures. Sets are partitioned by length:
sets in bands that are not neighbours cannot be similar enough and are never compared.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import let, ready, written

#: Fixed list: very common words of English, German, French and Spanish that start a chain.
ANCHORS = (
    "the a an is was and that to with for it "
    "der die das ein ist und nicht von mit den "
    "le les un une est et du des pour dans "
    "el los una es y en por con se su"
).split()
#: The beginning of a line starts a chain of one word, so that any text with a content word has a signature.
LINE = "¶"
CHAIN = 2
#: Content words with a CRC-32 divisible by this start chains as well: texts of other languages and lists have spots too.
SPREAD = 8
#: Words after an anchor among which the words of its chain are looked for.
REACH = 8
SIMILAR = 0.8

BUCKET_ROWS = 2048
FAN = 128


# ------------------------------------------------------------------ signatures


def signatures(text: Column) -> Column:
    """The sorted set of 32-bit hashes of the text's chains.

    Words are runs of letters and digits of the lower-cased text. A chain is an anchor and the next content words,
    two at most (one after the beginning of a line); one that finds none within reach is left out. Null, empty and
    wordless texts have the empty set.
    """
    lined = F.concat(F.lit(LINE), F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"\n+", f" {LINE} "))
    tokens = F.filter(F.split(F.regexp_replace(lined, LINE, f" {LINE} "), rf"[^\p{{L}}\p{{N}}{LINE}]+"), lambda w: w != "")

    def anchor(w: Column) -> Column:
        return w.isin(*ANCHORS, LINE)

    def spots(words: Column) -> Column:
        def chain(w: Column, i: Column) -> Column:
            following = F.filter(F.slice(words, i + 2, F.lit(REACH)), lambda x: ~anchor(x))
            content = F.slice(following, F.lit(1), F.when(w == LINE, 1).otherwise(CHAIN))
            spot = anchor(w) | (F.crc32(w) % SPREAD == 0)
            return F.when(spot, F.when(F.size(content) > 0, _short(F.xxhash64(w, F.array_join(content, " ")))))

        return F.array_sort(F.array_distinct(F.filter(F.transform(words, chain), lambda h: h.isNotNull())))

    return let(tokens, spots)


def _short(h: Column) -> Column:
    return F.shiftrightunsigned(h, 32)


def signatures_or_whole(text: Column) -> Column:
    """The same; a text without any chain has one signature, of all it contains. Null is empty."""
    whole = F.array(_short(F.xxhash64(F.lit("whole text"), F.coalesce(text, F.lit("")))))
    return let(signatures(text), lambda signs: F.when(F.size(signs) > 0, signs).otherwise(whole))


def fingerprint(signs: Column) -> Column:
    """The set as text, whole: eight hexadecimal digits for each signature, in the order of the hashes."""
    return F.array_join(F.transform(signs, lambda h: F.lpad(F.lower(F.hex(h)), 8, "0")), "")


def jaccard(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard similarity of two sets, 1 for two empty ones; 0 without looking if their sizes rule out ``least``."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    both = F.size(F.array_intersect(a, b))
    return (
        F.when(large == 0, F.lit(1.0))
        .when((small == 0) | (small < least * large), F.lit(0.0))
        .otherwise(both / (small + large - both))
    )


# ------------------------------------------------------------------ similar documents


def similar_to(queries: DataFrame, docs: DataFrame, least: float = SIMILAR) -> DataFrame:
    """(query_id, doc_id, similarity) for each query row and each row of ``docs`` that is at least ``least`` similar to it.

    A set takes part by its prefix: the signatures that come first in the order of rarity, as many as a similar set
    cannot all lack. Pairs that share one and lie in the same or neighbouring bands of length are compared. Empty
    sets match nothing; rows with the same id and text count once; a row is not matched with its own id.
    """
    ready(docs.sparkSession)

    def sets(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.col("doc_id").alias(name), signatures(F.col("text")).alias("signs")).filter("size(signs) > 0").distinct()

    left, right = written(sets(queries, "query_id"), "spot-queries"), written(sets(docs, "doc_id"), "spot-docs")
    rare = right.select(F.explode("signs").alias("sign")).groupBy("sign").count()

    def prefixes(df: DataFrame, name: str) -> DataFrame:
        size = F.size("signs")
        spread = df.select(name, size.alias("size"), F.explode("signs").alias("sign"))
        ranked = spread.join(rare, "sign", "left").withColumn("count", F.coalesce("count", F.lit(0)))
        by_rarity = Window.partitionBy(name, "size").orderBy("count", "sign")
        keep = F.col("size") - F.ceil(F.col("size") * least - 1e-9) + 1
        band = F.floor(F.log(F.col("size")) / math.log(1 / least) + 1e-9)
        return ranked.withColumn("_at", F.row_number().over(by_rarity)).filter(F.col("_at") <= keep).select(name, "sign", band.alias("band"))

    found = prefixes(left, "query_id").withColumn("band", F.explode(F.array(*[F.col("band") + i for i in (-1, 0, 1)])))
    pairs = found.join(prefixes(right, "doc_id"), ["sign", "band"]).filter("query_id <> doc_id").select("query_id", "doc_id").distinct()
    looked = pairs.join(left.withColumnRenamed("signs", "_a"), "query_id").join(right.withColumnRenamed("signs", "_b"), "doc_id")
    likeness = jaccard(F.col("_a"), F.col("_b"), least)
    return looked.select("query_id", "doc_id", likeness.alias("similarity")).filter(F.col("similarity") >= least)


# ------------------------------------------------------------------ the next document


def place(key: Column, cuts: list[int]) -> Column:
    """How many of the ascending cuts are at most ``key``, found in two steps of at most FAN comparisons each."""
    groups = [cuts[i : i + FAN] for i in range(0, len(cuts), FAN)]

    def below(values: Column) -> Column:
        return F.size(F.filter(values, lambda c: c <= key))

    if not groups:
        return F.lit(0)
    if len(groups) == 1:
        return below(F.lit(cuts))
    heads = F.lit([g[0] for g in groups])
    lists = F.array(*[F.lit(g) for g in groups])
    return let(below(heads), lambda g: F.when(g == 0, F.lit(0)).otherwise((g - 1) * FAN + below(F.element_at(lists, F.greatest(g, F.lit(1))))))


def beside_next(docs: DataFrame, bucket_rows: int = BUCKET_ROWS) -> tuple[DataFrame, Window]:
    """Rows of ``docs`` (doc_id, text) in buckets of neighbouring ids, and the window that orders a bucket.

    The first row of a bucket is also put at the end of the bucket before, marked ``_guest``, and the very first
    row at the end of the last, so that ``lead`` finds the next document of each row without any row passing
    through one task. Cut points are approximate quantiles of the ids, FAN * FAN at most; the result does not
    depend on them. Null ids come first; rows of one id are ordered by text.
    """
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), key.alias("_key"))
    buckets = min(FAN * FAN, max(1, -(-docs.count() // bucket_rows)))
    shares = [i / buckets for i in range(1, buckets)]
    cuts = keyed.agg(F.percentile_approx("_key", shares, 100_000).alias("cuts")).first().cuts if shares else []
    cuts = sorted(set(cuts or []))
    bucketed = keyed.withColumn("_bucket", place(F.col("_key"), cuts))
    firsts = {r._bucket: r.first for r in bucketed.groupBy("_bucket").agg(F.min("_key").alias("first")).collect()}
    order = sorted(firsts)
    here = F.struct(F.col("_bucket").alias("bucket"), F.lit(0).alias("guest"))
    homes = F.array(here)
    if order:
        first = F.lit([firsts.get(b, 0) for b in range(order[-1] + 1)])
        before = {b: a for a, b in zip(order, order[1:], strict=False)}
        home = F.lit([before.get(b, order[-1]) for b in range(order[-1] + 1)])
        at = F.col("_bucket") + 1
        guest = F.struct(F.element_at(home, at).alias("bucket"), F.when(F.col("_bucket") == order[0], 2).otherwise(1).alias("guest"))
        homes = F.when(F.col("_key") == F.element_at(first, at), F.array(here, guest)).otherwise(homes)
    spread = bucketed.withColumn("_home", F.explode(homes)).select(
        "doc_id", "text", "_key", F.col("_home.bucket").alias("_bucket"), F.col("_home.guest").alias("_guest")
    )
    return spread, Window.partitionBy("_bucket").orderBy("_guest", "_key", "text")


def compare_with_edited(docs: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Per document: doc_id, n_chars, its edited text, the signatures of both and how alike it is to the edited and the next text.

    The edited text has the last floor(n_chars / 4) code points replaced by the first as many, or all, of the next
    document in ascending doc_id; after the last comes the first. A null text is empty; repeated rows are kept. Texts
    without a chain are alike only if they are equal. Likeness is that of the fingerprints, which hold the signatures whole.
    """
    ready(docs.sparkSession)
    rows, following = beside_next(docs, bucket_rows)
    edited = rows.withColumn("_next", F.lead("text").over(following)).withColumn("n_chars", F.length("text").cast("long"))
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    kept = F.substr("text", F.lit(1), F.col("n_chars").cast("int") - cut)
    joined = edited.withColumn("edited", F.concat(kept, F.when(cut > 0, F.substr("_next", F.lit(1), cut)).otherwise("")))
    signed = joined.withColumn("signs", signatures_or_whole(F.col("text"))).withColumn("edited_signs", signatures_or_whole(F.col("edited")))
    after = signed.withColumn("_next_signs", F.lead("signs").over(following)).filter("_guest = 0")
    return after.select(
        "doc_id",
        "n_chars",
        "edited",
        "signs",
        "edited_signs",
        jaccard(F.col("signs"), F.col("edited_signs")).alias("near_edited"),
        jaccard(F.col("signs"), F.col("_next_signs")).alias("near_next"),
    )


def digest(compared: DataFrame) -> DataFrame:
    return compared.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("signs")).alias("fingerprint"),
        fingerprint(F.col("edited_signs")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )
