"""Mixes sources to target weights: exact word quotas, split among shards block by block.

Main path: DataFrame and SQL functions only.

1. Every source is dealt into blocks of about equal words by a hash of its rows. A source's
   quota is its target in words: whole passes over it, and for the rest the first of its
   blocks in a permuted order. The row at the cut is drawn whole or not at all.
2. The drawn blocks are the balls of an urn. A binary tree over the output shards splits them:
   each node puts a multivariate-hypergeometric draw of its quota vector to the left, the rest
   to the right. A leaf's quotas are met with the next blocks of each source's permuted list,
   so shards are disjoint.
3. Within a shard, rows are ordered by a hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import WORD, settle

#: A text in words with the blanks before each.
_PREFIXED = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"


def _hash(*cols) -> Column:
    return F.xxhash64(*cols)


def targets(sizes: DataFrame, repeat: int, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """(source, source_size, target, quota) from (source, size) rows.

    Sources by code point, NULL last, weigh `weights` in turn and share the total size; a
    target stops at `repeat` times its source's size and the excess is shared by weight among
    the others. With sources sorted by cap a unit of weight, a source is capped if the level
    that is left for it and those behind it is above its cap. One row per source.
    """
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(order) - 1) % len(weights) + 1)
    by = by.withColumn("weight", weight.cast("double")).withColumn("cap", repeat * F.col("source_size").cast("double"))
    everything = Window.partitionBy()
    ranked = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, behind = ranked.rowsBetween(Window.unboundedPreceding, -1), ranked.rowsBetween(0, Window.unboundedFollowing)
    by = (
        by.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(behind))
        .withColumn("at", F.row_number().over(ranked))
        .withColumn("capped", F.col("level") * F.col("weight") > F.col("cap"))
    )
    final = F.min_by(F.when(~F.col("capped"), F.col("level")), F.when(~F.col("capped"), F.col("at"))).over(everything)
    target = F.when(F.col("capped"), F.col("cap")).otherwise(final * F.col("weight"))
    return by.withColumn("target", F.least(target, F.col("cap"))).select(
        "source", "source_size", "target", F.round("target").cast("long").alias("quota"), "total"
    )


def _cut(members: DataFrame, place: str) -> DataFrame:
    """Where the quota ends: per source the first `place`, in order, that goes beyond `left`.

    `members` has (source, left, size, place); returns (source, place, left, words): what is
    left of the quota in that place, and the words there. No row if all fits.
    """
    cells = members.groupBy("source", place).agg(F.sum("size").alias("words"), F.first("left").alias("left"))
    so_far = Window.partitionBy("source").orderBy(place).rowsBetween(Window.unboundedPreceding, 0)
    cells = cells.withColumn("end", F.sum("words").over(so_far)).where("end > left")
    first = F.min(F.struct(place, (F.col("left") - F.col("end") + F.col("words")).alias("left"), "words"))
    return cells.groupBy("source").agg(first.alias("m")).select("source", "m.*")


def _split(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """Leaf quotas (shard, source, n) of the tree; `quotas` has (source, n)."""
    nodes, wide = quotas.select(F.lit(0).alias("node"), F.lit(shards).alias("leaves"), "source", "n"), shards
    while wide > 1:
        # sorting the balls of a node by hash and taking the first ones is the hypergeometric draw
        balls = nodes.where("n > 0").withColumn("ball", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
        inside = Window.partitionBy("node")
        balls = balls.withColumn("all", F.count(F.lit(1)).over(inside)).withColumn(
            "rank", F.row_number().over(inside.orderBy(_hash("node", F.lit(wide), "source", "ball", F.lit(seed)), "source", "ball"))
        )
        half = F.floor(F.col("leaves") / 2).cast("int")
        left = F.col("rank") <= F.round(F.col("all") * half / F.col("leaves"))
        nodes = (
            balls.select(
                F.when(left, F.col("node")).otherwise(F.col("node") + half).alias("node"),
                F.when(left, half).otherwise(F.col("leaves") - half).alias("leaves"),
                "source",
            )
            .groupBy("node", "leaves", "source")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        done = nodes.where("leaves = 1")
        nodes = settle(done.unionByName(nodes.where("leaves > 1")), "tree")
        wide = (wide + 1) // 2
    return nodes.select(F.col("node").alias("shard"), "source", "n")


def decide(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    repeat: int = 3,
    blocks: int = 4096,
    shards: int = 16,
    seed: int = 7,
) -> DataFrame:
    """Adds to every row: size, source_size, target, draws, taken.

    `size` is the number of words (NULL text: 0). `draws` lists the row's places in the mix as
    (copy, shard, words). `taken` is the sum of their words. Sources share 100 % of all words by
    weight (see `targets`), and no row gives more than `repeat` times its size. The row at a
    source's cut is drawn whole or not at all, whichever is nearer to the target: the taken
    words of a source differ from its rounded target by half of that row at most. Rows without
    words take no part. Only rows equal in id and text share what falls to them at a cut
    evenly, rounded down, as a prefix each. Reruns agree: all draws are hashes. Tables that are
    sorted in one task have a row per source or per drawn block, `blocks` and one per source times
    the passes. Columns that have the name of a new one are replaced.
    """
    new = ["size", "source_size", "target", "draws", "taken"]
    size = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long")
    key = _hash(F.col(doc_id).cast("string"), F.coalesce(F.col(text), F.lit("")), F.lit(seed))
    sizes = settle(df.select(F.col(source).alias("source"), size.alias("size"), key.alias("key")), "sizes")
    total = F.greatest(F.lit(1), F.ceil(F.col("total") / blocks))
    plan = settle(
        targets(sizes, repeat)
        .withColumn("passes", F.coalesce(F.try_divide("quota", "source_size").cast("long"), F.lit(0)))
        .withColumn("left", F.col("quota") - F.col("passes") * F.col("source_size"))
        .withColumn("n_blocks", F.greatest(F.lit(1), F.ceil(F.col("source_size") / total)).cast("long")),
        "plan",
    )
    block = F.pmod(_hash("key", F.lit("block")), F.col("n_blocks"))
    place = {
        "p1": _hash("block", "n_blocks", F.lit(seed)),  # the permuted order of a source's blocks
        "p2": F.pmod(_hash("key", F.lit("cell")), F.lit(1024)),
        "p3": F.col("key"),
    }

    def with_plan(rows: DataFrame, on: DataFrame) -> DataFrame:
        on = on.withColumnRenamed("source", "_s")
        return rows.join(on, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")

    placed = with_plan(sizes.where("size > 0"), plan.select("source", "left", "n_blocks"))
    placed = placed.withColumn("block", block).withColumns(place)
    # the cut, narrowed from blocks to cells of a block to rows of a cell
    cuts, members = plan, placed
    for p in ("p1", "p2", "p3"):
        found = settle(_cut(members, p), "cut")
        at = found.select(F.col("source").alias("_s"), F.col(p).alias(f"cut_{p}"), F.col("left").alias("_left"), F.col("words").alias("_words"))
        cuts = cuts.drop("_left", "_words").join(at, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
        members = members.join(at.drop("_words"), F.col("source").eqNullSafe(F.col("_s")) & (F.col(p) == F.col(f"cut_{p}")))
        members = members.withColumn("left", F.col("_left")).drop("_s", "_left", f"cut_{p}")
    cuts = settle(cuts, "cuts")

    beyond = F.struct("p1", "p2", "p3") > F.struct("cut_p1", "cut_p2", "cut_p3")
    at_cut = (F.col("p1") == F.col("cut_p1")) & (F.col("p2") == F.col("cut_p2")) & (F.col("p3") == F.col("cut_p3"))
    share = F.floor(F.col("size") * (F.col("_left") / F.col("_words"))).cast("long")
    whole = F.when(2 * F.col("_left") >= F.col("size"), F.col("size")).otherwise(F.lit(0))
    exact = F.when(F.col("size") == F.col("_words"), whole).otherwise(share)
    # without a cut nothing of the source is left over: `left` is 0
    extra = F.when(F.col("cut_p1").isNull() | beyond, 0).when(at_cut, exact).otherwise(F.col("size"))

    # the urn: whole passes draw every block, the last pass those up to the cut
    drawn = with_plan(placed.select("source", "block", "p1").distinct(), cuts.select("source", "passes", "cut_p1"))
    last = F.col("cut_p1").isNotNull() & (F.col("p1") <= F.col("cut_p1"))
    drawn = drawn.withColumn("copies", F.col("passes") + F.when(last, 1).otherwise(0)).where("copies > 0")
    drawn = drawn.select("source", "block", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
    drawn = settle(
        drawn.withColumn(
            "at", F.row_number().over(Window.partitionBy("source").orderBy(_hash("block", "copy", F.lit(seed)), "block", "copy"))
        ),
        "drawn",
    )
    leaves = _split(drawn.groupBy("source").agg(F.count(F.lit(1)).alias("n")), shards, seed)
    upto = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    leaves = leaves.withColumn("last", F.sum("n").over(upto)).where("n > 0")
    leaves = leaves.select(
        F.col("source").alias("_s"), "shard", F.explode(F.sequence(F.col("last") - F.col("n") + 1, F.col("last"))).alias("_at")
    )
    shard_of = drawn.join(leaves, F.col("source").eqNullSafe(F.col("_s")) & (F.col("at") == F.col("_at")))
    shard_of = settle(
        shard_of.groupBy("source", "block").agg(F.array_sort(F.collect_list(F.struct("copy", "shard"))).alias("shards")), "shards"
    ).select(F.col("source").alias("_b"), F.col("block").alias("_block"), "shards")

    rows = df.drop(*[c for c in new if c not in (doc_id, text, source)])
    mine = {"_size": size, "key": key, "_source": F.col(source)}
    rows = rows.select(F.struct(*rows.columns).alias("_row"), *[c.alias(n) for n, c in mine.items()])
    rows = rows.withColumnRenamed("_size", "size").withColumnRenamed("_source", "source")
    rows = with_plan(rows, cuts.select("source", "source_size", "target", "n_blocks", "passes", "cut_p1", "cut_p2", "cut_p3", "_left", "_words"))
    rows = rows.withColumn("block", block).withColumns(place).withColumn("extra", extra)
    rows = rows.join(shard_of, F.col("source").eqNullSafe(F.col("_b")) & (F.col("block") == F.col("_block")), "left")
    words = lambda d: F.when(d["copy"] <= F.col("passes"), F.col("size")).otherwise(F.col("extra"))
    draws = F.transform(
        F.coalesce(F.col("shards"), F.array().cast("array<struct<copy:bigint,shard:int>>")),
        lambda d: F.struct(d["copy"].alias("copy"), d["shard"].alias("shard"), words(d).alias("words")),
    )
    rows = rows.withColumn("draws", F.filter(draws, lambda d: d["words"] > 0))
    taken = F.aggregate("draws", F.lit(0).cast("long"), lambda n, d: n + d["words"])
    return rows.select("_row.*", *new[:-1], taken.alias("taken"))


def mix(df: DataFrame, text: str = "text", n_chars: str | None = "n_chars", **how) -> DataFrame:
    """The mix itself: a row for every draw, shard by shard, shuffled within each.

    Columns of `df` and shard, copy, order. Texts are whole, but for rows equal in id and text at
    a cut (see `decide`): these have the prefix that holds their words, and `n_chars` follows.
    """
    columns = df.columns
    rows = decide(df, text=text, **how).withColumn("_d", F.explode("draws"))
    pieces = F.slice(F.regexp_extract_all(text, F.lit(_PREFIXED), F.lit(0)), 1, F.col("_d.words").cast("int"))
    part = F.when(F.col("_d.words") < F.col("size"), F.array_join(pieces, "")).otherwise(F.col(text))
    rows = rows.withColumn("shard", F.col("_d.shard")).withColumn("copy", F.col("_d.copy")).withColumn(text, part)
    if n_chars in columns:
        rows = rows.withColumn(n_chars, F.when(F.col("_d.words") < F.col("size"), F.length(text)).otherwise(F.col(n_chars)))
    rows = rows.withColumn("order", _hash("shard", "copy", text))
    rows = rows.select(*[F.col(c) for c in columns if c not in ("shard", "copy", "order")], "shard", "copy", "order")
    # ranges over shard and order: a shard larger than a task is spread over several
    return rows.repartitionByRange("shard", "order").sortWithinPartitions("shard", "order")
