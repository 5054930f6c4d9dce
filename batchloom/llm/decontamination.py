"""Benchmark decontamination by SimHash of item-sized windows, on built-in column functions only.

1. Documents that share no shingle with any benchmark item cannot be similar to one and are left out by a set test inside
   the scan. Benchmark items are a query set: they are gone through in blocks of at most ``block_shingles`` shingles, so the
   set that is sent to the tasks has a bound whatever the size of the benchmark.
2. For every item that a document shares a shingle with, every window of the item's number of words that covers the shared
   shingle gets a 64-bit SimHash of its words. A shorter document is one window.
3. Fingerprints are cut into ``blocks`` Hamming blocks. Items are indexed under all values within ``radius // blocks`` bits
   of their own in each block, windows are looked up under theirs: by the pigeonhole principle every pair within ``radius``
   bits meets in some block.
4. Similar windows can have fingerprints further apart. ``similarity`` asks for a least number of common shingles, so windows
   that hold at least as many places with a shingle of the item are candidates too, whatever their distance. ``radius``
   decides by which way a pair is found, never whether.
5. Candidates are verified by exact similarity of weighted shingles, the weight being how often a shingle stands in the
   text: the sum of the smaller weights over the sum of the larger. From ``similarity`` on it is a leak.

Words are lower-cased and parted by space, tab, newline, vertical tab, form feed and carriage return; shingles are of
``shingle`` words, a shorter item is one shingle of all its words. Null and empty texts and items match nothing. Null ids
stay null, repeated rows and repeated items give a row each. Empty tables give no rows, other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchloom.sources.files import write_scratch

BITS = 64


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), "[ \t\n\\x0B\f\r]+"), "")


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once per row, however often it is used inside lambdas.

    A plain column expression would be put in wherever it is named and worked out again for every element there.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def shingle_hashes(hashes: Column, size: int) -> Column:
    """A hash of each run of ``size`` of the given word hashes, in order; none if there are fewer."""

    def made(own: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.greatest(F.size(own) - size, F.lit(0))), lambda i: F.xxhash64(*[F.get(own, i + k) for k in range(size)]))
        return F.when(F.size(own) >= size, runs)

    return bound(hashes, made)


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def simhash(hashes: Column, lane: int) -> Column:
    """The bits set in over half of the hashes. Counters of ``lane`` bits share the longs of one running sum."""
    places = range(0, BITS, lane)
    mask = sum(1 << p for p in places)
    mask -= mask >> 63 << 64
    zero = F.array(*[F.lit(0).cast("bigint")] * lane)

    def added(own: Column) -> Column:
        return F.aggregate(own, zero, lambda sums, h: F.array(*[F.get(sums, F.lit(i)) + F.shiftrightunsigned(h, i).bitwiseAND(F.lit(mask)) for i in range(lane)]))

    def folded(sums: Column, n: Column) -> Column:
        out = F.lit(0).cast("bigint")
        for bit in range(BITS):
            count = F.shiftrightunsigned(F.get(sums, F.lit(bit % lane)), bit // lane * lane).bitwiseAND(F.lit((1 << lane) - 1))
            one = (1 << bit) - (bit // 63 << 64)
            out = out.bitwiseOR(F.when(count * 2 > n, F.lit(one).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
        return out

    return bound(hashes, lambda own: bound(added(own), lambda sums: folded(sums, F.size(own))))


def block_ranges(blocks: int) -> list[tuple[int, int]]:
    """First bit and width of each block."""
    bounds = [round(i * BITS / blocks) for i in range(blocks + 1)]
    return [(a, b - a) for a, b in zip(bounds, bounds[1:], strict=False)]


def _under(value: Column, masks: Column, block: int) -> Column:
    return bound(value, lambda v: F.transform(masks, lambda m: F.struct(F.lit(block).alias("block"), v.bitwiseXOR(m).alias("value"))))


def block_values(fp: Column, blocks: int, errors: int) -> Column:
    """Structs (block, value) of a fingerprint and of all that differ from it by at most ``errors`` bits of the block."""
    out = []
    for i, (first, width) in enumerate(block_ranges(blocks)):
        value = F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << width) - 1))
        if errors:
            every = F.sequence(F.lit(0).cast("bigint"), F.lit((1 << width) - 1))
            near = F.filter(every, lambda m: F.bit_count(m) <= errors)  # a constant, worked out when the query is planned
            out.append(_under(value, near, i))
        else:
            out.append(F.array(F.struct(F.lit(i).alias("block"), value.alias("value"))))
    return F.concat(*out)


def bags(rows: DataFrame, keys: list[str], size: Column) -> DataFrame:
    """How often each shingle of ``size`` words stands in ``words``, and how many there are."""
    spelt = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("words") - F.col("gram") + 1, F.lit(1))),
        lambda i: F.array_join(F.slice("words", i, F.col("gram")), " "),
    )
    return rows.withColumn("gram", size).select(*keys, F.explode(spelt).alias("spelt")).groupBy(*keys, "spelt").agg(F.count("*").alias("weight"))


def dense_windows(hits: DataFrame, gram: int, similarity: float) -> DataFrame:
    """Windows (row, item, n, start) that hold enough places of ``hits`` (row, size, item, n, at) to be similar to the item.

    Texts of t and u shingles that are ``similarity`` alike have at least (t + u) * similarity / (1 + similarity) in common.
    """
    size, n = F.col("size"), F.col("n")
    shingles = F.greatest(F.least(size, n) - gram + 1, F.lit(1)) + F.greatest(n - gram + 1, F.lit(1))
    need = F.greatest(F.ceil(shingles * F.lit(similarity / (1 + similarity)) - F.lit(1e-6)), F.lit(1)).cast("int")
    places = hits.groupBy("row", "size", "item", "n").agg(F.sort_array(F.collect_list("at")).alias("places")).withColumn("need", need)

    def starts(own: Column) -> Column:
        def first_is(at: Column, i: Column) -> Column:  # of the windows in which this is the first of the places
            last = F.get(own, i + F.col("need") - 1)
            low = F.greatest(last - n + gram, F.coalesce(F.get(own, i - 1) + 1, F.lit(0)), F.lit(0))
            high = F.least(at, F.greatest(size - n, F.lit(0)))
            return F.when(last.isNotNull() & (low <= high), F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

        return F.flatten(F.transform(own, first_is))

    return places.where(F.size("places") >= F.col("need")).select("row", "item", "n", F.explode(bound(F.col("places"), starts)).alias("start"))


def _item_block(docs: DataFrame, items: DataFrame, shingle: int, radius: int, blocks: int, similarity: float) -> DataFrame:
    grams = [r["gram"] for r in items.select("gram").distinct().orderBy("gram").collect()]  # at most ``shingle`` sizes
    lane = 16 if items.agg(F.max("n")).first()[0] < 1 << 16 else 32
    of_gram = {g: items.where(F.col("gram") == g).select("item", "n", F.explode(shingle_hashes(word_hashes(F.col("words")), g)).alias("h")) for g in grams}
    wanted = {g: sorted(r["h"] for r in found.select("h").distinct().collect()) for g, found in of_gram.items()}  # one block's
    tests = [shares_shingle(g, wanted[g]) for g in grams if wanted[g]]
    near = docs.where(F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False))).select("doc_id", "words", F.monotonically_increasing_id().alias("row"))
    near = write_scratch(near, "near")
    windows = dense = None
    for g in grams:
        found = near.select("row", F.size("words").alias("size"), F.posexplode(shingle_hashes(word_hashes(F.col("words")), g)).alias("at", "h"))
        held = dense_windows(found.join(of_gram[g].distinct(), "h"), g, similarity)
        dense = held if dense is None else dense.unionByName(held)
        found = found.join(of_gram[g].select("h", "n").distinct(), "h")
        low, high = F.greatest(F.col("at") - F.col("n") + g, F.lit(0)), F.least(F.col("at"), F.greatest(F.col("size") - F.col("n"), F.lit(0)))
        spread = found.where(low <= high).select("row", "n", F.explode(F.sequence(low, high)).alias("start")).distinct()
        windows = spread if windows is None else windows.unionByName(spread).distinct()
    cut = windows.join(near, "row").select("row", "n", "start", F.slice("words", F.col("start") + 1, F.col("n")).alias("words"))
    printed = write_scratch(cut.withColumn("fp", simhash(word_hashes(F.col("words")), lane)), "windows")
    prints = items.select("item", "n", simhash(word_hashes(F.col("words")), lane).alias("item_fp"))
    indexed = prints.select("item", "n", "item_fp", F.explode(block_values(F.col("item_fp"), blocks, radius // blocks)).alias("e")).select("item", "n", "item_fp", "e.*")
    probes = printed.select("row", "n", "start", "fp", F.explode(block_values(F.col("fp"), blocks, 0)).alias("e")).select("row", "n", "start", "fp", "e.*")
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    pairs = probes.join(indexed, ["n", "block", "value"]).where(distance <= radius)
    pairs = pairs.select("row", "n", "start", "item", distance.alias("distance")).distinct()
    beyond = dense.join(printed.select("row", "n", "start", "fp"), ["row", "n", "start"]).join(prints.drop("n"), "item").where(distance > radius)
    pairs = pairs.unionByName(beyond.select("row", "n", "start", "item", distance.alias("distance")))
    meant = pairs.join(items.select("item", "gram"), "item").join(printed.select("row", "n", "start", "words"), ["row", "n", "start"])
    of_window = bags(meant.withColumnRenamed("gram", "item_gram"), ["row", "start", "item", "distance"], F.col("item_gram"))
    of_item = bags(items.withColumnRenamed("gram", "item_gram"), ["item"], F.col("item_gram")).withColumnRenamed("weight", "item_weight")
    totals = of_item.groupBy("item").agg(F.sum("item_weight").alias("item_total"))
    both = of_window.join(of_item, ["item", "spelt"], "left").groupBy("row", "start", "item", "distance")
    met = both.agg(F.sum("weight").alias("total"), F.sum(F.least("weight", F.coalesce("item_weight", F.lit(0)))).alias("common")).join(totals, "item")
    like = met.withColumn("similarity", F.col("common") / (F.col("total") + F.col("item_total") - F.col("common"))).where(F.col("similarity") >= similarity)
    best = like.groupBy("row", "item").agg(F.min(F.struct((-F.col("similarity")).alias("less"), "start", "distance")).alias("best"))
    return best.join(near.select("row", "doc_id"), "row").join(items.select("item", "item_id"), "item").select(
        "doc_id", "item_id", F.col("best.start").cast("bigint").alias("start"), (-F.col("best.less")).alias("similarity"), F.col("best.distance").alias("distance")
    )


def shares_shingle(gram: int, wanted: list[int]) -> Column:
    """Whether ``words`` has a shingle of the set; as SQL text, in which a large set costs the driver little."""
    run = ", ".join(f"get(own, i + {k})" for k in range(gram))
    runs = f"transform(sequence(0, size(own) - {gram}), i -> xxhash64({run}))"
    some = f"exists({runs}, h -> h in ({', '.join(map(str, wanted))}))"
    return F.expr(f"get(transform(array(transform(words, w -> xxhash64(w))), own -> size(own) >= {gram} and {some}), 0)")


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, shingle: int = 5, similarity: float = 0.8, radius: int = 14, blocks: int = 5, block_shingles: int = 50_000
) -> DataFrame:
    """One row per document and benchmark item that it contains: doc_id, item_id, start (first word of the most similar
    window, the earliest of equals), similarity, distance (of the fingerprints, in bits)."""
    words = docs.select(F.col("doc_id").cast("bigint"), words_of(F.col("text").cast("string")).alias("words"))
    items = benchmark.select("item_id", words_of(F.col("text").cast("string")).alias("words")).where(F.size("words") > 0)
    items = items.select("item_id", "words", F.size("words").alias("n"), F.least(F.size("words"), F.lit(shingle)).alias("gram"))
    items = write_scratch(items.withColumn("item", F.monotonically_increasing_id()), "items")
    parts = max(1, -(-(items.agg(F.sum("n")).first()[0] or 0) // block_shingles))
    found = None
    for part in range(parts):
        own = items.where(F.pmod(F.xxhash64("item"), F.lit(parts)) == part)
        if own.isEmpty():
            continue
        leaks = _item_block(words, own, shingle, radius, blocks, similarity)
        found = leaks if found is None else found.unionByName(leaks)
    if found is None:
        kind = benchmark.schema["item_id"].dataType
        return words.limit(0).select("doc_id", F.lit(None).cast(kind).alias("item_id"), F.lit(0).cast("bigint").alias("start"), F.lit(0.0).alias("similarity"), F.lit(0).alias("distance"))
    return found
