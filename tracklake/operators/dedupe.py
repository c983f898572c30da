"""Near-duplicate pairs of 64-bit hashes, groups, and what to keep of them."""

from __future__ import annotations

from itertools import combinations
from math import log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracklake.functions.names import name_key
from tracklake.operators.graph import connected_components
from tracklake.storage import materialize


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def text_simhash(docs: DataFrame, column: str = "text") -> DataFrame:
    """``doc_id, h``: the sign of each of 64 sums of bits over the distinct words of the text."""
    # hashed inside the array, so that the 64 sums read one column instead of hashing 64 times
    words = F.array_distinct(F.split(name_key(F.col(column)), " "))
    hashed = F.transform(words, lambda w: F.conv(F.substring(F.md5(w), 1, 16), 16, -10).cast("bigint"))
    bits = docs.select("doc_id", F.explode(hashed).alias("x"))
    sums = [F.sum(F.when(F.shiftrightunsigned("x", i).bitwiseAND(1) == 1, 1).otherwise(-1)).alias(f"s{i}") for i in range(64)]
    code = F.lit(0).cast("bigint")
    for i in range(64):
        code = code.bitwiseOR(F.when(F.col(f"s{i}") > 0, F.lit(1 << i if i < 63 else -(1 << 63))).otherwise(F.lit(0)).cast("bigint"))
    return bits.groupBy("doc_id").agg(*sums).select("doc_id", code.alias("h"))


def hamming_pairs(hashes: DataFrame, threshold: int = 6, blocks: int | None = None) -> DataFrame:
    """``i, j, d``: all pairs i < j with min(d(h_i, h_j), d(mirror_i, h_j)) <= threshold.

    ``hashes`` holds idx, h and mirror, a row for each idx (repeated rows count once); null hashes take no part, and a null mirror
    stands for the hash. Images of equal codes are one class: only classes meet (``_met``), and each pair of classes is spelt out once. All pairs
    of equal codes are in the result; ``hamming_edges`` links the same groups without them.
    """
    own, classes = _classes(hashes)
    # merge joins: files of codes and of sources are small beside their rows as hash tables, several of which a driver would hold at once
    members = own.join(classes.hint("merge"), ["h", "mirror"]).select("low", "idx").distinct()
    first, second = members.select(F.col("low").alias("a"), F.col("idx").alias("i")), members.select(F.col("low").alias("b"), F.col("idx").alias("j"))
    near = _met(classes, threshold, blocks).groupBy("a", "b").agg(F.min("d").alias("d"))
    apart = near.join(first.hint("merge"), "a").join(second.hint("merge"), "b").where("i < j").select("i", "j", "d")
    same = first.join(second.hint("merge"), F.col("a") == F.col("b")).where("i < j").select("i", "j", F.lit(0).alias("d"))
    return same.unionAll(apart)


def _classes(hashes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows that take part, and ``h, mirror, low, high``: smallest and largest index of each two codes."""
    own = hashes.where("idx IS NOT NULL AND h IS NOT NULL").select("idx", "h", F.coalesce("mirror", "h").alias("mirror"))
    return own, materialize(own.groupBy("h", "mirror").agg(F.min("idx").alias("low"), F.max("idx").alias("high")), "hash-classes")


def _signed(mask: int) -> Column:
    return F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("bigint")


def bit_blocks(entropy: list[float], blocks: int) -> list[int]:
    """Masks of ``blocks`` sets of bits with about the same entropy in sum: the bits, those of most entropy
    first, each go to the set that holds least. Bits that nearly all codes share so do not make up a whole block."""
    masks, load = [0] * blocks, [(0.0, 0)] * blocks
    for bit in sorted(range(64), key=lambda i: (-entropy[i], i)):
        k = min(range(blocks), key=lambda n: (*load[n], n))
        masks[k] |= 1 << bit
        load[k] = (load[k][0] + entropy[bit], load[k][1] + 1)
    return masks


def _entropy(share: float) -> float:
    return -sum(p * log2(p) for p in (share, 1 - share) if p > 0)


def block_keys(masks: list[int], threshold: int):
    """Keys of a code: a hash of the bits in each choice of all but ``threshold`` of its blocks. Two codes
    within the threshold differ in that many blocks at most, so they share a key."""
    agree = len(masks) - threshold
    if agree < 1:
        raise ValueError("blocks must exceed the threshold")

    def keys(h: str) -> Column:
        return F.explode(F.array(*(F.xxhash64(F.lit(n), F.col(h).bitwiseAND(_signed(sum(chosen)))) for n, chosen in enumerate(combinations(masks, agree)))))

    return keys


def blocks_for(codes: int, threshold: int) -> int:
    """Blocks so that the keys of so many codes seldom meet by chance: more codes, more and wider keys."""
    return threshold + (2 if codes <= 200_000 else 3 if codes <= 4_000_000 else 4)


TILE, SAMPLED = 1 << 12, 16  # members of one key that a task holds; classes of which one counts for full keys


def candidates(classes: DataFrame, threshold: int, blocks: int | None = None, tile: int = TILE) -> DataFrame:
    """``a, b, b_high, probe, own, other``: directed pairs of classes of which a code or mirror code of the one shares a key with the code of the other.

    Blocks are made of bits by their measured entropy (one row of 64 counts goes to the driver). A key of more
    than about ``tile`` classes, as counted on one class in ``SAMPLED``, is cut into tiles of rows and columns, so that no task holds a full key; each pair
    of its members still meets, in one tile. Tiles only share out work: whatever the sample says, the pairs are the same.
    """
    ones = [F.sum(F.shiftrightunsigned("h", i).bitwiseAND(1)).alias(f"s{i}") for i in range(64)]
    n, *set_bits = classes.agg(F.count("*"), *ones).first()
    keys = block_keys(bit_blocks([_entropy(s / n) if n else 0.0 for s in set_bits], blocks or blocks_for(n, threshold)), threshold)
    left = classes.select(F.col("low").alias("a"), F.col("h").alias("own"), F.explode(F.array_distinct(F.array("h", "mirror"))).alias("probe")).withColumn("key", keys("probe"))
    right = classes.select(F.col("low").alias("b"), F.col("high").alias("b_high"), F.col("h").alias("other")).withColumn("key", keys("other"))
    meet = ["key"]
    if n > tile:
        counted = classes.where(F.pmod(F.xxhash64("h", F.lit(7)), F.lit(SAMPLED)) == 0).select(keys("h").alias("key")).groupBy("key").agg(F.count("*").alias("n"))
        # written, so that its size is known when the join is chosen
        full = materialize(counted.where(F.col("n") * SAMPLED > tile).select("key", F.ceil(F.col("n") * SAMPLED / tile).cast("int").alias("tiles")), "full-keys")
        if not full.isEmpty():
            meet = ["key", "across", "down"]
            all_tiles = F.explode(F.sequence(F.lit(0), F.coalesce("tiles", F.lit(1)) - 1))
            place = lambda c: F.coalesce(F.pmod(F.xxhash64(c), F.col("tiles")), F.lit(0)).cast("int")
            left = left.join(full, "key", "left").withColumn("across", place("a")).withColumn("down", all_tiles).drop("tiles")
            right = right.join(full, "key", "left").withColumn("down", place("b")).withColumn("across", all_tiles).drop("tiles")
    # a merge join, as the written classes are small, and Spark takes the many keys that they are spread to for as small, and so for fit to be broadcast
    return left.join(right.hint("merge"), meet).where("a <> b").drop(*meet)


def _met(classes: DataFrame, threshold: int, blocks: int | None) -> DataFrame:
    """The candidates within the threshold, with ``d``; a pair may come once for each key it shares."""
    return candidates(classes, threshold, blocks).withColumn("d", hamming(F.col("probe"), F.col("other"))).where(F.col("d") <= threshold)


def hamming_edges(hashes: DataFrame, threshold: int = 6, blocks: int | None = None) -> DataFrame:
    """``src, dst``: edges that connect the same groups as ``hamming_pairs``. Images of equal code and equal
    mirror code are one class, linked as a star to its smallest index; pairs are made of classes only."""
    own, classes = _classes(hashes)
    stars = own.join(classes, ["h", "mirror"]).where("idx > low").select(F.col("low").alias("src"), F.col("idx").alias("dst"))
    # a mirror code counts for the smaller index of a pair only, so some image of the other class must come later
    met = _met(classes, threshold, blocks).where("probe = own OR a < b_high")
    return stars.unionAll(met.select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst")).distinct())


def group_counts(grouped: DataFrame) -> DataFrame:
    """Images, groups, and images kept, of a manifest after ``keep_policy``."""
    return grouped.agg(F.count("*").alias("n_images"), F.countDistinct("group_id").alias("n_groups"), F.count_if("keep").alias("n_kept"))


def groups(items: DataFrame, edges: DataFrame) -> DataFrame:
    """``items`` (idx, ...) with ``group_id``, the smallest index of the connected group."""
    found = connected_components(edges).withColumnsRenamed({"node": "idx", "component": "group_id"})
    return items.join(found, "idx", "left").withColumn("group_id", F.coalesce("group_id", "idx"))


def keep_policy(manifest: DataFrame) -> DataFrame:
    """Adds ``keep`` and ``drop_reason`` to a manifest with group_id, source, role and priority.

    A group of one source keeps all. Otherwise, if it holds test and train images, all train images
    are dropped as ``test_leak``; if more than one source is left, those whose priority is above
    the smallest are dropped as ``cross_source_dup``.
    """
    per = manifest.groupBy("group_id").agg(
        (F.min("source") != F.max("source")).alias("mixed"),
        (F.max((F.col("role") == "test").cast("int")) + F.max((F.col("role") == "train").cast("int")) == 2).alias("both"),
    )
    joined = manifest.join(per, "group_id").withColumn("leak", F.col("mixed") & F.col("both") & (F.col("role") == "train"))
    alive = joined.where("mixed AND NOT leak").groupBy("group_id").agg((F.min("source") != F.max("source")).alias("still"), F.min("priority").alias("least"))
    joined = joined.join(alive, "group_id", "left")
    later = F.coalesce(~F.col("leak") & F.col("mixed") & F.col("still") & (F.col("priority") > F.col("least")), F.lit(False))
    reason = F.when(F.col("leak"), "test_leak").when(later, "cross_source_dup").otherwise("")
    return joined.withColumn("drop_reason", reason).withColumn("keep", F.col("drop_reason") == "").drop("mixed", "both", "leak", "still", "least")


def cross_source(pairs: DataFrame, manifest: DataFrame, most: int = 300) -> DataFrame:
    """The first pairs, in order, whose ends are of different sources."""
    a = manifest.select(F.col("idx").alias("i"), F.col("source").alias("source_i"))
    b = manifest.select(F.col("idx").alias("j"), F.col("source").alias("source_j"))
    return pairs.join(a.hint("merge"), "i").join(b.hint("merge"), "j").where("source_i <> source_j").orderBy("i", "j").limit(most)


def group_split(items: DataFrame, val_frac: float, seed: int = 0) -> DataFrame:
    """Adds ``split``: whole groups go to val, in a seeded order within the source, until it holds
    ``val_frac`` of the source's items; it overshoots by one group at most."""
    if not 0 <= val_frac < 1:
        raise ValueError("val_frac must lie in [0, 1)")
    sizes = items.groupBy("source", "group_id").agg(F.count("*").alias("n"))
    key = F.md5(F.concat_ws("|", F.col("group_id").cast("string"), F.lit(str(seed))))
    # running sums by leading hash digits and then within, so that no task sorts a whole source
    sizes = sizes.withColumn("key", key).withColumn("head", F.substring("key", 1, 3))
    heads = sizes.groupBy("source", "head").agg(F.sum("n").alias("own"))
    upto = Window.partitionBy("source").orderBy("head").rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.select("source", "head", F.coalesce(F.sum("own").over(upto), F.lit(0)).alias("start"), F.sum("own").over(Window.partitionBy("source")).alias("total"))
    within = Window.partitionBy("source", "head").orderBy("key", "group_id").rowsBetween(Window.unboundedPreceding, -1)
    chosen = sizes.withColumn("within", F.coalesce(F.sum("n").over(within), F.lit(0))).join(heads, ["source", "head"]).withColumn("before", F.col("start") + F.col("within"))
    chosen = chosen.select("source", "group_id", F.when(F.col("before") < val_frac * F.col("total"), "val").otherwise("train").alias("split"))
    return items.join(chosen, ["source", "group_id"])


def assemble_splits(kept: DataFrame, negatives: DataFrame, val_frac: float = 0.1, neg_test_frac: float = 0.2, max_neg_frac: float = 0.1, seed: int = 0) -> DataFrame:
    """``idx, split, negative``: test images as they are, train images split by group, then negatives
    in a seeded order: a share to test, and to train at most a share of its size."""
    train = group_split(kept.where("role = 'train'"), val_frac, seed).select("idx", "split")
    test = kept.where("role = 'test'").select("idx", F.lit("test").alias("split"))
    base = train.unionByName(test)
    key = F.md5(F.concat_ws("|", F.col("idx").cast("string"), F.lit(str(seed))))
    # row numbers over all negatives without one sorting task: count by leading hash digits, then within
    head = negatives.withColumn("key", key).withColumn("head", F.substring("key", 1, 3))
    counts = head.groupBy("head").agg(F.count("*").alias("n"))
    starts = counts.withColumn("start", F.coalesce(F.sum("n").over(Window.orderBy("head").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    placed = head.join(F.broadcast(starts.drop("n")), "head").withColumn("place", F.col("start") + F.row_number().over(Window.partitionBy("head").orderBy("key", "idx")))
    sizes = negatives.agg(F.count("*").alias("n_neg")).join(base.agg(F.count_if(F.col("split") == "train").alias("n_train")))
    placed = placed.join(F.broadcast(sizes)).withColumn("n_test", F.bround(neg_test_frac * F.col("n_neg"), 0).cast("bigint"))
    split = F.when(F.col("place") <= F.col("n_test"), "test").when(F.col("place") <= F.col("n_test") + F.floor(max_neg_frac * F.col("n_train")), "train")
    chosen = placed.withColumn("split", split).where("split IS NOT NULL").select("idx", "split")
    return base.withColumn("negative", F.lit(False)).unionByName(chosen.withColumn("negative", F.lit(True)))
