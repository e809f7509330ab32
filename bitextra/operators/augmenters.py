"""Augmenters: DataFrame -> DataFrame of new rows with the input's columns.

Every random choice is a hashed draw keyed by the row id, so the result depends neither on
row order nor on partitioning, and a re-run task yields the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import constants as K, text as X
from ..functions.arrays import let
from ..functions.hashing import hash_key, pick, uniform
from ..registry import augmenters
from .sampling import indexed, sample_ranked

SEED = 42


def _seed(params: dict) -> int:
    return int(params.get("random_seed", SEED))


def _like(df: DataFrame, new: DataFrame) -> DataFrame:
    """The new rows in the input's shape; columns they do not define are NULL."""
    types = dict(df.dtypes)
    return new.select(
        *[F.col(c) if c in new.columns else F.lit(None).cast(types[c]).alias(c) for c in df.columns]
    )


def _choose(options: list[tuple[str, Column]], index: Column) -> Column:
    chosen = F.when(index == 0, options[0][1])
    for i, (_, c) in enumerate(options[1:], start=1):
        chosen = chosen.when(index == i, c)
    return chosen


def expand_ranges(ranges: list[str]) -> str:
    """'a-z' style ranges; anything else stands for its own characters."""
    out = ""
    for r in ranges:
        if len(r) == 3 and r[1] == "-":
            out += "".join(map(chr, range(ord(r[0]), ord(r[2]) + 1)))
        else:
            out += r
    return out


NOISE_TYPES = ["delete", "insert", "duplicate", "substitute", "swap"]


@augmenters("synthetic_noise", "Copies with one character edit")
def synthetic_noise(df: DataFrame, params: dict) -> DataFrame:
    seed, what = _seed(params), "synthetic_noise"
    name = params.get("target_column", "en")
    kinds = params.get("noise_types", NOISE_TYPES)
    alphabet = expand_ranges(params.get("char_ranges", ["a-z"]))
    key, c, n = F.col("id"), F.col(name), F.length(name)
    draw = lambda k: uniform(seed, what, key, k)

    def edit(kind: str) -> Column:
        places = {"insert": n + 1, "swap": n - 1}.get(kind, n)
        at = pick(draw(2), places)  # 0-based place of the edit
        letter = F.substr(F.lit(alphabet), pick(draw(3), len(alphabet)) + 1, F.lit(1))
        before, here = F.left(c, at), F.substr(c, at + 1, F.lit(1))
        if kind == "delete":
            return F.concat(before, F.substr(c, at + 2))
        if kind == "insert":
            return F.concat(before, letter, F.substr(c, at + 1))
        if kind == "duplicate":
            return F.concat(before, here, F.substr(c, at + 1))
        if kind == "substitute":
            return F.concat(before, letter, F.substr(c, at + 2))
        if kind == "swap":
            return F.concat(before, F.substr(c, at + 2, F.lit(1)), here, F.substr(c, at + 3))
        return c

    def safe(kind: str) -> Column:
        least = 1 if kind in ("delete", "swap") else 0
        return F.when(n > least, edit(kind)).otherwise(c)

    noisy = _choose([(k, safe(k)) for k in kinds], pick(draw(1), len(kinds)))
    chosen = df.where(draw(0) < F.lit(float(params.get("percentage", 0.1))))
    return chosen.withColumns({name: noisy, "id": F.concat("id", F.lit("_synthetic_noise"))})


@augmenters("sentence_concatenation", "Join consecutive rows into longer examples")
def sentence_concatenation(df: DataFrame, params: dict) -> DataFrame:
    """Row order is file order (`row_pos`) or, without it, id order."""
    seed, what = _seed(params), "sentence_concatenation"
    low = int(params.get("min_n", 2))
    high = int(params.get("max_n", low))
    if low < 2 or high < low:
        raise ValueError("sentence_concatenation needs 2 <= min_n <= max_n")
    sep = params.get("separator", " ")
    key = F.col("id")
    rows = indexed(df).withColumns(
        {
            "_wanted": F.lit(low) + pick(uniform(seed, what, key, 1), high - low + 1),
            "_starts": uniform(seed, what, key, 0) < F.lit(float(params.get("percentage", 0.1))),
        }
    )
    # Even blocks of rows, each with the first high - 1 rows of the next one, make every
    # group local to a block: one shuffle, no matter how many groups there are. No group
    # reaches beyond the next block.
    block = max(4096, high - 1)
    home = F.floor(F.col("idx") / block)
    also = F.when((F.col("idx") % block < high - 1) & (home > 0), F.array(home, home - 1)).otherwise(F.array(home))
    ahead = Window.partitionBy("_block").orderBy("idx").rowsBetween(0, high - 1)
    texts = rows.withColumn("_home", home).withColumn("_block", F.explode(also))
    texts = texts.withColumn("_next", F.collect_list(F.struct(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("en", "ka")])).over(ahead))
    chosen = texts.where(F.col("_starts") & (F.col("_block") == F.col("_home")))
    group = F.slice("_next", F.lit(1), F.col("_wanted"))
    joined = chosen.withColumn("_group", group).withColumns(
        {
            "en": F.array_join(F.col("_group.en"), sep),
            "ka": F.array_join(F.col("_group.ka"), sep),
            "id": F.concat("id", F.lit("_concat"), F.size("_group").cast("string")),
        }
    )
    return joined.select(*df.columns)


NUMBER_TYPES = ["integer", "float", "large", "small"]


def _number(kind: str, u: Column) -> Column:
    if kind == "integer":
        return (F.lit(1) + F.floor(u * 10000)).cast("string")
    if kind == "float":
        return F.format_string("%.2f", F.lit(1.0) + u * F.lit(999.0))
    if kind == "large":
        return (F.lit(1000000) + F.floor(u * 999000000)).cast("string")
    if kind == "small":
        return F.format_string("%.3f", F.lit(0.001) + u * F.lit(0.998))
    return (F.lit(1) + F.floor(u * 100)).cast("string")


@augmenters("number_copying", "Sentences that hold the same number on both sides")
def number_copying(df: DataFrame, params: dict) -> DataFrame:
    """Drawn numbers, `num_examples` of them; with `from_rows` the first number of each English text that has one."""
    seed, what = _seed(params), "number_copying"
    kinds = params.get("number_types", NUMBER_TYPES)
    key = F.col("id")
    if params.get("from_rows", False):
        found = F.regexp_extract("en", r"\d+(?:\.\d+)?", 0)
        rows = df.select("id", found.alias("_number")).where(F.col("_number") != "")
    else:
        rows = df.sparkSession.range(int(params.get("num_examples", 100)))
    draw = lambda k: uniform(seed, what, key, k)
    number = _choose([(k, _number(k, draw(1))) for k in kinds], pick(draw(0), len(kinds)))
    which = pick(draw(2), len(K.NUMBER_TEMPLATES))
    english = F.array(*[F.lit(en) for en, _ in K.NUMBER_TEMPLATES])
    georgian = F.array(*[F.lit(ka) for _, ka in K.NUMBER_TEMPLATES])
    fill = lambda templates: F.replace(F.get(templates, F.col("_which")), F.lit("{number}"), F.col("_number"))
    if "_number" not in rows.columns:
        rows = rows.withColumn("_number", number)
    made = rows.withColumn("_which", which).select(
        fill(english).alias("en"),
        fill(georgian).alias("ka"),
        F.lit("synthetic").alias("domain"),
        F.concat(F.lit("number_copy_"), key.cast("string")).alias("id"),
    )
    return _like(df, made)


@augmenters("georgian_text_copying", "Rows whose English equals the Georgian text")
def georgian_text_copying(df: DataFrame, params: dict) -> DataFrame:
    """Draws without replacement from the Georgian texts longer than two characters."""
    text = X.strip(F.col("ka"))
    pool = df.select("id", text.alias("_text"), F.lit(1).alias("_row")).where(F.length("_text") > 2)
    if params.get("num_examples") is not None:
        wanted = int(params["num_examples"])
    else:
        # the share refers to all rows, not to the pool
        wanted = int(df.count() * float(params.get("percentage", 0.05)))
    drawn = sample_ranked(pool, lambda total: F.lit(wanted).cast("long"), ["id"], f"{_seed(params)}|copy")
    made = drawn.select(
        F.col("_text").alias("en"),
        F.col("_text").alias("ka"),
        F.lit("synthetic_copying").alias("domain"),
        F.concat(F.lit("georgian_copy_"), F.col("_rank").cast("string")).alias("id"),
    )
    return _like(df, made)


def _spend(blocks: DataFrame, low: int, ratio: float, seed: str) -> DataFrame:
    """(_block, _take): rows each block merges; draws of all blocks go before rests of blocks.

    A running sum over at most 131,072 hash buckets says what is spent before a bucket, another
    one inside the buckets what is spent before a portion.
    """
    first = F.struct(F.lit("0").alias("part"), F.col("_drawn").alias("n"), F.col("_size").alias("size"))
    second = F.struct(F.lit("1").alias("part"), F.col("_rest").alias("n"), F.lit(0).cast("long").alias("size"))
    portions = blocks.select("_block", hash_key(seed, F.col("_block")).alias("_h"), F.inline(F.array(first, second)))
    portions = portions.withColumn("_bucket", F.concat("part", F.substring("_h", 1, 4)))
    earlier = (Window.unboundedPreceding, -1)
    spent = portions.groupBy("_bucket").agg(F.sum("n").alias("_n"), F.sum("size").alias("_rows"))
    spent = spent.withColumns(
        {
            "_before": F.coalesce(F.sum("_n").over(Window.orderBy("_bucket").rowsBetween(*earlier)), F.lit(0)),
            "_budget": F.floor(F.sum("_rows").over(Window.partitionBy()) * F.lit(ratio)),
        }
    )
    open_buckets = spent.where(F.col("_before") < F.col("_budget")).select("_bucket", "_before", "_budget")
    inside = Window.partitionBy("_bucket").orderBy("_h", "_block").rowsBetween(*earlier)
    placed = portions.join(F.broadcast(open_buckets), "_bucket")  # bounded, see above
    left = F.col("_budget") - F.col("_before") - F.coalesce(F.sum("n").over(inside), F.lit(0))
    placed = placed.withColumn("_used", F.least("n", F.greatest(left, F.lit(0))))
    taken = placed.where((F.col("part") == "1") | (F.col("_used") >= low))
    return taken.groupBy("_block").agg(F.sum("_used").alias("_take"))


@augmenters("restructure_to_longer_texts", "Merge rows into fewer, longer ones (replaces the table)")
def restructure_to_longer_texts(df: DataFrame, params: dict) -> DataFrame:
    """Merge groups of min..max rows until `concatenation_ratio` of all rows are merged.

    Rows stand in blocks of `max_group_size`, the last one shorter: neighbours in row order
    (`consecutive`) or in hash order (`random`). Blocks take from the budget in hash order: first
    min..max rows each (a hashed draw), then, if that leaves budget over, the rest of a block.
    The budget is met but for fewer than `min_group_size` rows; rows not taken stay.
    """
    seed, what = _seed(params), "restructure_to_longer_texts"
    low, high = int(params.get("min_group_size", 2)), int(params.get("max_group_size", 4))
    ratio, sep = float(params.get("concatenation_ratio", 0.3)), params.get("separator", " ")
    if params.get("strategy", "consecutive") == "random":
        rows = sample_ranked(df, lambda total: total, ["id"], f"{seed}|random").withColumnRenamed("_rank", "idx")
    else:
        rows = indexed(df)
    rows = rows.withColumn("_block", F.floor(F.col("idx") / high).cast("long"))
    blocks = rows.groupBy("_block").agg(F.count(F.lit(1)).alias("_size"))
    drawn = F.least("_size", F.lit(low) + pick(uniform(seed, what, F.col("_block")), high - low + 1)).cast("long")
    drawn = F.when(F.col("_size") >= low, drawn).otherwise(0)
    rest = F.when(F.col("_size") >= low, F.col("_size") - F.col("_drawn")).otherwise(0)
    merged_blocks = _spend(blocks.withColumn("_drawn", drawn).withColumn("_rest", rest), low, ratio, f"{seed}|blocks")
    marked = rows.join(merged_blocks, "_block", "left").withColumn("_in_block", F.col("idx") % high)
    member = F.coalesce(F.col("_in_block") < F.col("_take"), F.lit(False))
    rest = marked.where(~member).select(*df.columns)
    groups = (
        marked.where(member)
        .groupBy("_block")  # at most max_group_size rows
        .agg(F.array_sort(F.collect_list(F.struct("idx", *df.columns))).alias("_g"))
    )
    text = lambda c: F.array_join(F.transform(F.col(f"_g.{c}"), lambda x: F.coalesce(x, F.lit(""))), sep)
    first = F.get("_g", F.lit(0))
    made = groups.select(
        *[
            text(c).alias(c)
            if c in ("en", "ka")
            else F.concat(F.lit("restructured_"), F.array_join(F.slice("_g.id", 1, 3), "_")).alias(c)
            if c == "id"
            else first[c].alias(c)
            for c in df.columns
        ]
    )
    return made.unionByName(rest)


restructure_to_longer_texts.replaces = True


def swap_words(w: Column, u: Column) -> Column:
    """One neighbouring pair of the word array exchanged, when there are more than two."""
    both = F.struct(w.alias("w"), pick(u, F.size(w) - 1).alias("at"))
    swapped = let(
        both,
        lambda s: F.concat(
            F.slice(s["w"], F.lit(1), s["at"]),
            F.reverse(F.slice(s["w"], s["at"] + 1, F.lit(2))),
            F.slice(s["w"], s["at"] + 3, F.size(s["w"])),
        ),
    )
    return F.array_join(F.when(F.size(w) > 2, swapped).otherwise(w), " ")


def drop_articles(w: Column, draw, share: float = 0.7) -> Column:
    """`draw(i)` decides on the i-th word; only articles can go."""
    kept = F.filter(w, lambda x, i: ~(F.lower(x).isin(K.ARTICLES) & (draw(i) < F.lit(share))))
    return F.array_join(kept, " ")


def informal(c: Column) -> Column:
    for formal, short in K.INFORMAL:
        c = F.regexp_replace(c, rf"(?i)(?<![\p{{L}}\p{{N}}_]){formal}(?![\p{{L}}\p{{N}}_])", short)
    return c


VARIATIONS = ["word_order", "article_errors", "informal_style"]


@augmenters("natural_writing_variations", "Copies with casual English")
def natural_writing_variations(df: DataFrame, params: dict) -> DataFrame:
    seed, what, key = _seed(params), "natural_writing_variations", F.col("id")
    kinds = params.get("variation_types", VARIATIONS)
    draw = lambda k: uniform(seed, what, key, k)
    c, w = F.col("en"), X.words(F.col("en"))
    forms = {
        "word_order": swap_words(w, draw(2)),
        "article_errors": drop_articles(w, lambda i: uniform(seed, what, key, F.concat(F.lit("w"), i.cast("string")))),
        "informal_style": informal(c),
    }
    varied = _choose([(k, forms.get(k, c)) for k in kinds], pick(draw(1), len(kinds)))
    chosen = df.where(draw(0) < F.lit(float(params.get("percentage", 0.05))))
    return chosen.withColumns({"en": varied, "id": F.concat("id", F.lit("_natural_variation"))})


def _chosen(df: DataFrame, params: dict, what: str) -> tuple[DataFrame, list[str]]:
    """Rows that a share of `percentage` draws, and the columns to be changed that exist."""
    columns = params.get("target_column", params.get("columns", ["en"]))
    columns = [c for c in ([columns] if isinstance(columns, str) else columns) if c in df.columns]
    share = float(params.get("percentage", 0.05))
    return df.where(uniform(_seed(params), what, F.col("id")) < share), columns


@augmenters("sentence_reversal", "Words in reverse order")
def sentence_reversal(df: DataFrame, params: dict) -> DataFrame:
    """Words are what blanks divide; NULL stays NULL and a text without words becomes ''."""
    rows, columns = _chosen(df, params, "sentence_reversal")
    turned = rows.withColumns({c: F.when(F.col(c).isNotNull(), F.array_join(F.reverse(X.words(F.col(c))), " ")) for c in columns})
    return _like(df, turned.withColumn("id", F.concat("id", F.lit("_reversed"))))


@augmenters("random_word_replacement", "Some words replaced by words of a lexicon")
def random_word_replacement(df: DataFrame, params: dict) -> DataFrame:
    """A share of `word_percentage` of a text's words, each drawn by its place, becomes the word of
    `lexicon` (a list) at a place drawn likewise. Blanks become single spaces in changed rows."""
    lexicon = list(params.get("lexicon", []))
    if not lexicon:
        raise ValueError("random_word_replacement needs a lexicon")
    rows, columns = _chosen(df, params, "random_word_replacement")
    seed, share = _seed(params), float(params.get("word_percentage", 0.1))
    entries = F.array(*[F.lit(w) for w in lexicon])

    def other(c: str) -> Column:
        draw = lambda what, i: uniform(seed, f"{what}_{c}", F.col("id"), i)
        new = lambda w, i: F.when(draw("word", i) < share, F.get(entries, pick(draw("entry", i), len(lexicon)))).otherwise(w)
        return F.when(F.col(c).isNotNull(), F.array_join(F.transform(X.words(F.col(c)), new), " "))

    return _like(df, rows.withColumns({c: other(c) for c in columns}).withColumn("id", F.concat("id", F.lit("_replaced"))))
