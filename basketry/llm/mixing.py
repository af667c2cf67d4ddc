"""Mixes sources to target weights over a number of output shards, DataFrame functions only.

Documents of a source are dealt into blocks by a hash. The source's target in words
becomes a number of block draws: whole passes over its blocks and, of one more
pass in random order, as many blocks as the rest of the target needs (the last
one in part). How many draws of each source there are is the quota of the root of a
binary tree. Level by level, half the draws of a node are taken at random from the quotas it has, a
multivariate hypergeometric draw, and are its left child's, the others its right child's, down
to one node per output shard. The shards then take their blocks one after the
other from the source's permuted list, so no draw is used twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketry.llm.common import GAP, WORD, record
from basketry.session import written

WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
MOST = 2
# Levels of the tree at least; more for a mix of over so many words a shard.
DEPTH = 6
SHARD_WORDS = 1 << 24
# Documents of a block, and blocks of a source at most: a larger source gets larger
# blocks, so that neither a source's blocks nor a block's documents are many.
BLOCK_ROWS = 500
MAX_BLOCKS = 4096
SEED = "mix"
BIN_DIGITS = 3


def _hash(seed: str, *parts: Column | str) -> Column:
    """A random but repeatable text of 32 hexadecimal digits."""
    texts = [F.coalesce(F.col(p) if isinstance(p, str) else p, F.lit("-")) for p in parts]
    return F.md5(F.concat_ws("|", F.lit(seed), *(t.cast("string") for t in texts)))


def _number(digits: Column) -> Column:
    return F.conv(F.substring(digits, 1, 8), 16, 10).cast("long")


def _sized(docs: DataFrame, seed: str) -> DataFrame:
    """The rows as `doc`, with their source, their words and their random key."""
    doc_id = F.col("doc.doc_id").cast("string")
    return record(docs).select(
        "doc",
        F.col("doc.source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("doc.text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(doc_id, F.lit("-")))).alias("key"),
    )


def targets(
    rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, share_percent: int = SHARE_PERCENT,
    most: int = MOST,
) -> DataFrame:
    """Per source its size, its target and the passes and words that make it up.

    rows: source, size. One row per source, so the windows below see few rows.
    Sources in code point order, the null one last, take the weights in turn. Whatever
    a source's limit cuts off is shared by the others by weight: the targets are
    least(limit, weight * level) with one level for all. With the sources in order of
    limit / weight, the level is the largest of those that result
    when the sources before each one are held at their limits.
    """
    product = 1
    for weight in weights:
        product *= weight
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights) + 1
    by_limit = W.orderBy(F.col("source_size") * F.expr(f"{product} div weight"), "turn", "source")
    table = (
        rows.groupBy("source")
        .agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
        .withColumn("turn", F.row_number().over(by_name))
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn).cast("long"))
    )
    before = F.coalesce(
        F.sum(F.col("source_size") * most).over(by_limit.rowsBetween(W.unboundedPreceding, -1)),
        F.lit(0),
    )
    open_weight = F.sum("weight").over(by_limit.rowsBetween(0, W.unboundedFollowing))
    whole = W.partitionBy()
    total = F.sum("source_size").over(whole)
    level = (total * share_percent - before * 100) / (open_weight * 100)
    table = table.withColumn("level", level).withColumn("level", F.max("level").over(whole))
    target = F.least(F.col("source_size") * float(most), F.col("weight") * F.col("level"))
    words = F.floor(target + F.lit(0.5)).cast("long")
    passes = F.when(F.col("source_size") > 0, F.expr("words div source_size")).otherwise(F.lit(0))
    return (
        table.withColumn("target", target)
        .withColumn("words", words)
        .withColumn("passes", passes)
        .withColumn("rest", F.col("words") - F.col("passes") * F.col("source_size"))
        .select("source", "source_size", "n_docs", "target", "passes", "rest")
    )


def _blocked(rows: DataFrame, sources: DataFrame, block_rows: int) -> DataFrame:
    """The rows with the block of their source they are dealt to."""
    count = F.least(F.expr(f"(n_docs + {block_rows - 1}) div {block_rows}"), F.lit(MAX_BLOCKS))
    return _by_source(rows, sources.withColumn("blocks", count)).withColumn(
        "block", _number(F.col("key")) % F.col("blocks")
    )


def _by_source(left: DataFrame, right: DataFrame) -> DataFrame:
    right = right.withColumnRenamed("source", "_source")
    same = F.col("source").eqNullSafe(F.col("_source"))
    return left.join(right, same).drop("_source")


def _draws(blocked: DataFrame, seed: str) -> DataFrame:
    """One row per draw of a block: source, block, words, turn (the pass), portion, draw_no."""
    blocks = blocked.groupBy("source", "block").agg(
        F.sum("size").alias("words"),
        F.first("passes").alias("passes"),
        F.first("rest").alias("rest"),
    )
    turns = F.sequence(F.lit(0).cast("long"), F.col("passes"))
    order = W.partitionBy("source", "turn").orderBy("order", "block")
    before = F.coalesce(
        F.sum("words").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
    )
    portion = F.when(F.col("turn") < F.col("passes"), F.col("words")).otherwise(
        F.least("words", F.col("rest") - before)
    )
    return (
        blocks.withColumn("turn", F.explode(turns))
        .withColumn("order", _hash(seed, "source", F.lit("block"), "block", "turn"))
        .withColumn("portion", portion)
        .filter("portion > 0")
        .withColumn(
            "draw_no",
            F.row_number().over(W.partitionBy("source").orderBy("turn", "order", "block")),
        )
    )


def _split(quotas: DataFrame, level: int, seed: str) -> DataFrame:
    """node, source, quota of the next level, drawn from the quotas of this one.

    The node's draws are numbered by source and ordered by random digits; the first half goes left.
    A draw's place is the number of draws in the bins before plus its rank inside its bin,
    so no task ranks all draws of a node.
    """
    slots = quotas.select("node", "source", F.explode(F.sequence(F.lit(1).cast("long"), "quota")).alias("number"))
    key = _hash(seed, "source", F.lit("slot"), F.lit(level), "node", "number")
    slots = slots.withColumn("key", key).withColumn("bin", F.substring("key", 1, BIN_DIGITS))
    node = W.partitionBy("node")
    before = F.sum("n").over(node.orderBy("bin").rowsBetween(W.unboundedPreceding, -1))
    bins = slots.groupBy("node", "bin").agg(F.count(F.lit(1)).alias("n")).select(
        "node", "bin", F.coalesce(before, F.lit(0)).alias("ahead"), F.sum("n").over(node).alias("size")
    )
    rank = F.row_number().over(W.partitionBy("node", "bin").orderBy("key", "source", "number"))
    right = F.col("ahead") + F.col("rank") > F.expr("size div 2")
    return (
        slots.withColumn("rank", rank)
        .join(bins, ["node", "bin"])
        .groupBy((F.col("node") * 2 + right.cast("long")).alias("node"), "source")
        .agg(F.count(F.lit(1)).alias("quota"))
    )


def splitting_tree(draws: DataFrame, depth: int = DEPTH, seed: str = SEED) -> list[DataFrame]:
    """By level, node, source, quota: how many draws of the source each node holds.

    Every level is written down and the next one drawn from it.
    """
    root = draws.groupBy("source").agg(F.count(F.lit(1)).alias("quota"))
    levels = [written(root.select(F.lit(0).cast("long").alias("node"), "source", "quota"))]
    for level in range(depth):
        levels.append(written(_split(levels[-1], level, seed)))
    return levels


def _dealt(draws: DataFrame, leaves: DataFrame) -> DataFrame:
    """The draws with the shard that takes them: quota by quota along the permuted list."""
    ends = F.sum("quota").over(W.partitionBy("source").orderBy("node"))
    taken = leaves.withColumn("last", ends).select(
        F.col("source").alias("_source"),
        F.col("node").alias("shard"),
        F.explode(F.expr("sequence(last - quota + 1, last)")).alias("number"),
    )
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("draw_no") == F.col("number"))
    return draws.join(taken, same).drop("_source", "number")


def _depth(sources: DataFrame) -> int:
    """Levels that give a shard SHARD_WORDS words at most, DEPTH at least."""
    total = sources.agg(F.sum(F.col("passes") * F.col("source_size") + F.col("rest"))).first()[0] or 0
    return max(DEPTH, (-(-total // SHARD_WORDS) - 1).bit_length())


def mixed(docs: DataFrame, **choices: object) -> DataFrame:
    """The rows of `mix_plan`, without the depth."""
    return mix_plan(docs, **choices)[0]


def mix_plan(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share_percent: int = SHARE_PERCENT,
    most: int = MOST, depth: int | None = None, block_rows: int = BLOCK_ROWS, seed: str = SEED,
) -> tuple[DataFrame, int]:
    """Every document as `doc`, with size, source_size, target and its draws; and the tree's depth.

    draws: array of (turn, shard, place, words), one entry for each time the mix takes
    the document: the pass over the source, the output shard, the key by which
    the shard is shuffled, and the words taken (all of them but for one
    document per source at most). Null texts have size 0, null sources are one source.
    Documents without words are never drawn. Repeated rows are rows of their own. Documents without an
    id are dealt to one block of their source, the same for all. There are 2 ** depth shards; unless
    it is given, the depth follows the words of the mix.
    """
    rows = _sized(docs, seed)
    narrow = written(rows.select("source", "size", "key"))
    sources = written(targets(narrow, weights, share_percent, most))
    draws = written(_draws(_blocked(narrow, sources, block_rows), seed))
    depth = _depth(sources) if depth is None else depth
    dealt = _dealt(draws, splitting_tree(draws, depth, seed)[-1])
    blocks = dealt.groupBy("source", "block").agg(
        F.sort_array(
            F.collect_list(
                F.struct("turn", "shard", (F.col("portion") < F.col("words")).alias("part"), "portion")
            )
        ).alias("drawn"),
    )
    blocks = written(blocks.withColumn("cut", F.exists("drawn", lambda d: d["part"])))
    rows = _blocked(rows, sources, block_rows)
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("block") == F.col("_block"))
    rows = rows.join(
        blocks.withColumnsRenamed({"source": "_source", "block": "_block"}), same, "left"
    )
    order = W.partitionBy("source", "block").orderBy("key", "size")
    before = F.coalesce(F.sum("size").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    cut = F.coalesce(F.col("cut"), F.lit(False))
    # Only the last block of a source's last pass is taken in part, and only there the order matters.
    rows = (
        rows.filter(~cut)
        .withColumn("before", F.lit(0).cast("long"))
        .unionByName(rows.filter(cut).withColumn("before", before))
    )
    words = F.transform(
        F.coalesce("drawn", F.array().cast(blocks.schema["drawn"].dataType)),
        lambda d: F.struct(
            d["turn"].alias("turn"),
            d["shard"].alias("shard"),
            F.md5(F.concat_ws("|", F.lit(seed), d["turn"].cast("string"), "key")).alias("place"),
            F.when(
                d["part"],
                F.greatest(F.least(F.col("size"), d["portion"] - F.col("before")), F.lit(0)),
            )
            .otherwise(F.col("size"))
            .alias("words"),
        ),
    )
    drawn = F.filter(words, lambda d: d["words"] > 0).alias("draws")
    return rows.select("doc", "size", "source_size", "target", drawn), depth


def with_taken(rows: DataFrame) -> DataFrame:
    """size, source_size, target, taken (words, repeats counted) and the shards, in turn, as text."""
    taken = F.aggregate("draws", F.lit(0).cast("long"), lambda total, d: total + d["words"])
    shards = F.concat_ws(",", F.transform("draws", lambda d: d["shard"].cast("string")))
    return rows.select(
        "doc", "size", "source_size", "target", taken.alias("taken"), shards.alias("shards")
    )


def mixture(docs: DataFrame, **choices: object) -> DataFrame:
    """The documents mixed and carried out, as `shards` gives them."""
    return shards(*mix_plan(docs, **choices))


def shards(rows: DataFrame, depth: int) -> DataFrame:
    """The mix itself: a row per draw; partition n is shard n, shuffled inside.

    The text of a document taken in part ends after the words that are taken.
    """
    pieces = F.regexp_extract_all("doc.text", F.lit(f"(?:{GAP})?{WORD}"), F.lit(0))
    begin = F.array_join(F.slice(pieces, F.lit(1), F.col("words").cast("int")), "")
    text = F.when(F.col("words") < F.col("size"), begin).otherwise(F.col("doc.text"))
    return (
        rows.select("doc", "size", F.explode("draws").alias("draw"))
        .select("draw.shard", "draw.turn", "draw.place", "draw.words", "size", "doc")
        .withColumn("doc", F.col("doc").withField("text", text))
        .drop("size")
        .repartitionById(2**depth, F.col("shard").cast("int"))
        .sortWithinPartitions("shard", "place")
    )
