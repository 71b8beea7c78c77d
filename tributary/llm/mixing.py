"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree (DataFrame operations only).

1. Targets: each source's share by weight, at most `cap` times its size; the excess is reshared by weight until none is
   above. Sources are ranked by a distributed sort and the level is found by sums over them, so they may be many.
2. Blocks: a source's documents are permuted by a hash and cut into hash buckets, its blocks. Its block quota is a whole
   number of passes over all of them, then as many of one more pass as the rest of its target fills. Blocks number in
   proportion to the source's words, so a hot source has more of them, not larger ones.
3. Tree: all quotas together are one ticket per block to be drawn, in a random order. A node of k shards holds a stretch of
   that order and hands its first half on to its left half of shards, and so on down to single shards. The tickets that a
   node sends left are thus drawn from it without replacement: per source, their numbers are multivariate hypergeometric.
   The tickets of a source at a leaf are that shard's quota of the source; quotas add up exactly.
4. Draws: the shards take, in turn, as many blocks as their quotas say off each source's permuted sequence of blocks (all of
   the first pass, then of the next), so blocks drawn by different shards are disjoint within a pass.
5. Each shard is shuffled locally by a hash of the draw. The block at which a source's target ends is cut in that order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import WORD, checked, looked_up, quoted, stage, text_hash, unused, whole
from tributary.llm.sharding import numbered

WEIGHTS = (5, 2, 1)
SHARDS = 16
#: Words of a piece of a shard, about 50 MB of text: the most that a task is to sort.
PIECE_WORDS = 8_000_000


def word_count(column: str = "text") -> Column:
    """Runs of anything but ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(column), F.lit(WORD)), F.lit(0)).cast("long")


def hashed(*parts: Column) -> Column:
    """60 bits of the md5 of the parts, joined by colons: the same in any engine."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = 3) -> DataFrame:
    """source, source_rows, words (a row per source) -> also weight, target.

    Weights repeat over the sources by code point, null last. With all words 0 every target is 0. The level falls on the
    sources that are not yet capped, which caps more of them, until no more are: a few sums over the sources.
    """
    ranked, _ = numbered(sizes.select("source", "source_rows", "words", F.col("source").isNull().alias("_none"), F.col("source").cast("binary").alias("_point")), ["_none", "_point"], "at")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.pmod("at", F.lit(len(weights))).cast("int") + 1).cast("long")
    t = stage(ranked.select("source", "source_rows", "words", weight.alias("weight")), "weights")
    capped, known, level = F.lit(False), -1, 0.0
    while True:
        held = F.when(capped, F.col("words") * cap).otherwise(0)
        n, words, taken, free = t.agg(F.count_if(capped), F.sum("words"), F.sum(held), F.sum(F.when(capped, 0).otherwise(F.col("weight")))).first()
        if n == known or not free:
            break
        known, level = n, float(words - taken) / float(free)
        capped = F.lit(level) * F.col("weight") > F.col("words") * cap
    return t.withColumn("target", F.when(capped, (F.col("words") * cap).cast("double")).otherwise(F.lit(level) * F.col("weight")))


def split(tickets: DataFrame, shards: int, seed: int) -> DataFrame:
    """tickets (source, ticket) -> also rank (their random order) and shard: the splitting tree.

    A node of k shards and n tickets sends its first floor(n * left / k) on to its `left` left shards. Ranks come from a
    distributed sort, and where a ticket goes is reckoned from its rank and the bounds of its node, so no node is gathered.
    """
    keyed = tickets.withColumn("_key", hashed(F.lit(f"{seed}:tree"), F.col("source"), F.col("source").isNull(), F.col("ticket"))).withColumn("_none", F.col("source").isNull())
    tree, n = numbered(keyed, ["_key", "_none", "source", "ticket"], "rank")
    low, high, first, held = F.lit(0), F.lit(shards), F.lit(0).cast("long"), F.lit(n).cast("long")
    for d in range(max(0, (shards - 1).bit_length())):
        tree = tree.withColumns({"_low": low, "_high": high, "_first": first, "_held": held})
        size = F.col("_high") - F.col("_low")
        mid = F.col("_low") + F.call_function("div", size, F.lit(2)).cast("int")
        sent = F.call_function("div", F.col("_held") * (mid - F.col("_low")), size).cast("long")
        left = (F.col("rank") < F.col("_first") + sent) & (size > 1)
        low, high = F.when((size <= 1) | left, F.col("_low")).otherwise(mid), F.when(left, mid).otherwise(F.col("_high"))
        first, held = F.when((size <= 1) | left, F.col("_first")).otherwise(F.col("_first") + sent), F.when(left, sent).when(size <= 1, F.col("_held")).otherwise(F.col("_held") - sent)
    return tree.select("source", "ticket", "rank", low.cast("int").alias("shard"))


def leaf_quotas(tickets: DataFrame) -> DataFrame:
    """source, shard, quota (blocks), first (the place in the source's sequence of blocks from which the shard takes them)."""
    leaves = tickets.groupBy("source", "shard").agg(F.count(F.lit(1)).alias("quota"))
    before = F.sum("quota").over(Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))  # a row per shard
    return leaves.withColumn("first", F.coalesce(before, F.lit(0)))


def _by_source(rows: DataFrame, table: DataFrame) -> DataFrame:
    """rows with the columns of table (a row per source, among them source_rows: how many of rows are of it); a source may hold any share of the rows."""
    split_null = {"_none": F.col("source").isNull(), "_name": F.coalesce("source", F.lit(""))}
    return looked_up(rows.withColumns(split_null), table.withColumns(split_null).drop("source"), ["_none", "_name"], "source_rows").drop("_none", "_name", "source_rows")


def plan(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = 3, shards: int = SHARDS, seed: int = 11, max_blocks: int = 65_536, block_rows: int = 2_000) -> DataFrame:
    """What is drawn of rows (source, size, h): a staged row per block: source, source_rows, bucket, buckets, words, source_size, target, drawn (pass and shard of each draw, by pass) and room.

    room is null but for the one block per source in which its target ends: there, the last draw takes that many words. The
    table has `max_blocks` rows and one more for each source at most, whatever the size of the data.
    """
    sizes = stage(rows.groupBy("source").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("source_rows")), "sources")
    count, words = sizes.agg(F.sum("source_rows"), F.sum("words")).first()
    blocks = min(max_blocks, max(256, (count or 0) // block_rows))
    quota = targets(sizes, weights, cap)
    quota = quota.withColumn("quota", F.least(F.floor(F.col("target") + 0.5), F.col("words") * cap))
    quota = quota.withColumn("passes", F.when(F.col("words") > 0, F.call_function("div", F.col("quota"), F.col("words"))).otherwise(0).cast("long"))
    quota = quota.withColumn("rest", F.col("quota") - F.col("passes") * F.col("words"))
    quota = stage(quota.withColumn("buckets", F.greatest(F.lit(1), F.ceil(F.col("words") * F.lit(float(blocks)) / F.lit(float(max(words or 0, 1))))).cast("long")), "quota")

    # blocks, in the order of their permuted sequence, and the words before each; empty ones are there, too
    on = F.col("source").eqNullSafe(F.col("_source"))
    dealt = _by_source(rows, quota.select("source", "source_rows", "buckets")).groupBy("source", F.pmod("h", "buckets").alias("bucket")).agg(F.sum("size").alias("held"))
    dealt = dealt.withColumnsRenamed({"source": "_source", "bucket": "_bucket"})
    every = quota.withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.col("buckets") - 1)))
    held = every.join(dealt, on & (F.col("bucket") == F.col("_bucket")), "left").withColumn("held", F.coalesce("held", F.lit(0))).drop("_source", "_bucket")
    before = F.coalesce(F.sum("held").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    held = stage(held.withColumn("before", before), "blocks")

    # the block quotas, through the tree, and back to blocks
    quotas = held.groupBy("source").agg((F.first("passes") * F.first("buckets") + F.count_if(F.col("before") < F.col("rest"))).alias("blocks"), F.first("buckets").alias("buckets")).where("blocks > 0")
    tickets = quotas.select("source", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("ticket"))
    leaves = stage(leaf_quotas(split(tickets, shards, seed)), "leaves")
    place = F.explode(F.sequence(F.col("first"), F.col("first") + F.col("quota") - 1)).alias("place")
    draws = leaves.select("source", "shard", place).join(quotas.select(F.col("source").alias("_source"), "buckets"), on)
    draws = draws.select("_source", F.call_function("div", F.col("place"), F.col("buckets")).cast("int").alias("pass"), F.pmod("place", "buckets").alias("_bucket"), "shard")
    draws = draws.groupBy("_source", "_bucket").agg(F.array_sort(F.collect_list(F.struct("pass", "shard"))).alias("drawn"))  # cap + 1 draws of a block at most
    out = held.join(draws, on & (F.col("bucket") == F.col("_bucket")), "left")
    ends = (F.col("before") < F.col("rest")) & (F.col("before") + F.col("held") > F.col("rest"))
    drawn = F.coalesce("drawn", F.array().cast("array<struct<pass:int,shard:int>>"))
    return stage(out.select("source", "source_rows", "bucket", "buckets", F.col("held").alias("words"), F.col("words").alias("source_size"), "target", drawn.alias("drawn"), F.when(ends, F.col("rest") - F.col("before")).alias("room")), "plan")


def _placed(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """rows (with source and h) with the row of their block."""
    sources = stage(blocks.groupBy("source").agg(F.first("buckets").alias("_buckets"), F.first("source_rows").alias("source_rows")), "sources")
    rows = _by_source(rows, sources).withColumn("_at", F.pmod("h", "_buckets")).drop("_buckets")
    state = blocks.withColumnsRenamed({"source": "_source", "bucket": "_bucket"}).drop("buckets", "source_rows", "words")
    return rows.join(checked(state), F.col("source").eqNullSafe(F.col("_source")) & (F.col("_at") == F.col("_bucket"))).drop("_source", "_bucket", "_at")


def local_order(seed: int, draw: Column, h: Column | str = "h") -> Column:
    """Where a draw of a document stands in its shard: by this key."""
    return hashed(F.lit(seed), draw["shard"], draw["pass"], F.col(h) if isinstance(h, str) else h)


def _last(rows: DataFrame, seed: int, cut: bool) -> DataFrame:
    """rows of blocks with room -> also part: the words that the block's last draw takes of each, in that shard's order.

    With cut=False a document is taken whole or not at all, whichever is nearer to the room. The window is over the documents of one block.
    """
    order = local_order(seed, F.element_at("drawn", -1))
    block = Window.partitionBy("source", "room").orderBy(order, "h", "doc_id", "size", "uid").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("room") - F.coalesce(F.sum("size").over(block), F.lit(0))
    part = F.greatest(F.lit(0), F.least(F.col("size"), left)) if cut else F.when((left * 2 >= F.col("size")) & (left > 0), F.col("size")).otherwise(0)
    return rows.withColumn("part", part.cast("long"))


def sized(docs: DataFrame, seed: int) -> DataFrame:
    """uid, doc_id, th, source, size, h of the documents, staged."""
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", text_hash().alias("th"), "source", word_count().alias("size"), hashed(F.lit(seed), F.col("doc_id")).alias("h"))
    return stage(rows, "sizes")


def drawn_rows(docs: DataFrame, seed: int = 11, cut: bool = True, **settings) -> DataFrame:
    """uid, doc_id, th, size, source_size, target, draws: an array of (pass, shard, words, place) per row of docs, by pass; place is its key in the shard's order."""
    rows = sized(docs, seed)
    placed = _placed(rows, plan(rows, seed=seed, **settings))
    full = placed.where("room is null").withColumn("part", F.col("size"))
    ends = _last(placed.where("room is not null"), seed, cut)
    last = F.size("drawn")

    def draw(d: Column, i: Column) -> Column:
        words = F.when(i + 1 == last, F.col("part")).otherwise(F.col("size"))
        return F.struct(d["pass"].alias("pass"), d["shard"].alias("shard"), words.alias("words"), local_order(seed, d).alias("place"))

    every = F.transform("drawn", draw)
    every = F.filter(every, lambda d: (d["words"] > 0) | (F.col("size") == 0) & ((d["pass"] < last - 1) | F.col("room").isNull()))
    return full.unionByName(ends).select("uid", "doc_id", "th", "source", "size", "source_size", "target", "h", every.alias("draws"))


def mix(docs: DataFrame, **settings) -> DataFrame:
    """One row per row of docs: uid, doc_id, size, source_size, target, taken (the words of all its draws), shards and places (of its draws, by pass, joined by commas).

    A null text has size 0; a null source is a source of its own, the last one; repeated rows are drawn one by one. A
    source without words has target 0. An empty table gives an empty result. Texts may be of any length. Other columns are ignored.
    """
    taken = F.aggregate("draws", F.lit(0).cast("long"), lambda n, d: n + d["words"])
    listed = lambda name: F.array_join(F.transform("draws", lambda d: d[name].cast("string")), ",").alias(f"{name}s")
    return drawn_rows(docs, **settings).select("uid", "doc_id", "size", "source_size", "target", taken.alias("taken"), listed("shard"), listed("place"))


def arranged(docs: DataFrame, named: str | None = None, seed: int = 11, **settings) -> DataFrame:
    """The mix itself: the rows of docs, each whole and as often as it is drawn, dealt out by shard, each shard in its shuffled order.

    Texts are moved once, to their place: what is drawn of a document is told by its block, and only documents of the few
    blocks that are cut are looked up. A partition holds pieces of shards, in order. named: a name for a further column with the shard.

    Null texts and null sources are drawn like others, as mix() says; repeated rows one by one. An empty table gives an empty
    result; columns of docs may have any names and all stay.
    """
    spark, shards = docs.sparkSession, settings.get("shards", SHARDS)
    rows = sized(docs, seed)
    blocks = plan(rows, seed=seed, **settings)
    own = docs.select(whole(docs), "source", F.col("doc_id").alias("_id"), text_hash().alias("_th"), hashed(F.lit(seed), F.col("doc_id")).alias("h"), word_count().alias("size"))
    own = _placed(own, blocks)
    full = own.where("room is null").withColumn("d", F.explode("drawn")).select("row", F.col("d.shard").alias("shard"), local_order(seed, F.col("d")).alias("place"))
    ends = _last(_placed(rows, blocks).where("room is not null"), seed, cut=False)
    kept = F.slice("drawn", 1, F.size("drawn") - F.when(F.col("part") > 0, 0).otherwise(1))
    ends = stage(ends.withColumn("d", F.explode(kept)).select(F.col("doc_id").alias("_doc_id"), F.col("th").alias("_key"), F.col("d.shard").alias("shard"), local_order(seed, F.col("d")).alias("place")), "ends")
    cut = own.where("room is not null").select("row", "_id", "_th").dropDuplicates(["_id", "_th"])
    cut = cut.join(checked(ends), F.col("_id").eqNullSafe(F.col("_doc_id")) & (F.col("_th") == F.col("_key"))).select("row", "shard", "place")
    # as many pieces of a shard as there are tasks for it, and more where they would be large
    words = blocks.agg(F.sum(F.col("words") * F.size("drawn"))).first()[0] or 0
    pieces = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // shards, -(-words // (shards * PIECE_WORDS)))
    out = full.unionByName(cut).withColumn("piece", F.pmod(F.col("place"), F.lit(pieces)))
    out = out.repartitionById(shards * pieces, (F.col("shard") * pieces + F.col("piece")).cast("int")).sortWithinPartitions("shard", "piece", "place")
    return out.select("row.*", *([F.col("shard").alias(unused(docs, named))] if named else []))


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """arranged() with the columns of docs alone."""
    return arranged(docs, **settings).select(*[quoted(c) for c in docs.columns])
