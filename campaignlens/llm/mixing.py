"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Every source's documents, in a seeded order, form one stream of words cut into blocks of equal length.
Targets share the corpus size by weight, stop at a multiple of the source's size and pass their excess
on. The blocks of the mix go to the sources by the highest quotients ``target / (2k + 1)``, which
gives integer quotas per output shard. A source's quota is met by whole passes over its blocks and one run
of blocks from a seeded start, so only documents at the ends of that run are cut. Everything is DataFrame
functions.

Defined results: a null text has size 0 and is never taken; a null source is a source of its own, ordered
last; repeated rows follow each other in the stream; an empty table gives no rows; other columns are ignored.

Scale: a source may hold any share of the rows. Places in a stream are running sums over at most 4,096
hash cells per source and then within one cell; equal rows are counted before they are ordered.
Apportionment works on one row per source and about two quotients per source and shard.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from campaignlens.llm.common import WORD, Workspace

SEED = 42
WEIGHTS = (5, 2, 1)
CAP = 3
BLOCK_TOKENS = 16
SHARDS = 8
_COPIES_PER_STEP = 65536


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _seeded(*parts: Column, seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts]).cast("binary"))


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """Adds ``place``, ``weight`` and ``target`` to one row ``(source, source_size)`` per source.

    Sources are filled in order of capacity per weight: whoever would exceed its cap at the level of
    those left is capped, and the level for the rest rises.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    kinds = F.array(*[F.lit(w) for w in weights])
    ranked = sources.withColumn("place", F.row_number().over(ordered))
    ranked = ranked.withColumn("weight", F.element_at(kinds, (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1)))
    everything = Window.partitionBy()
    filling = Window.orderBy((F.col("source_size") / F.col("weight")).asc(), "place")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    after = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    limit = F.col("source_size") * cap
    levels = ranked.select(
        "*",
        F.sum("source_size").over(everything).alias("total"),
        F.coalesce(F.sum(limit).over(before), F.lit(0)).alias("capped_before"),
        F.sum("weight").over(after).alias("weight_left"),
    )
    capped = limit * F.col("weight_left") < F.col("weight") * (F.col("total") - F.col("capped_before"))
    marked = levels.withColumn("capped", capped)
    rest = F.col("total") - F.coalesce(F.sum(F.when(F.col("capped"), limit)).over(everything), F.lit(0))
    shares = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(everything)
    target = F.when(F.col("capped"), limit.cast("double")).otherwise(rest * F.col("weight") / shares)
    return marked.select("source", "source_size", "place", "weight", "total", F.coalesce(target, F.lit(0.0)).alias("target"))


def quotas(
    targeted: DataFrame, block_tokens: int = BLOCK_TOKENS, cap: int = CAP, shards: int = SHARDS
) -> DataFrame:
    """Blocks that each source gets in each output shard: ``(source, shard, quota)`` and the source's columns.

    For the first s shards together, the highest quotients get the blocks. Each source's number of
    blocks is known beforehand up to a few, from the divisors that surely give too few and too many, so only
    about two quotients per source are ranked. The rule is house-monotone: differences are the shards' quotas.
    """
    whole = F.floor((2 * F.col("total") + block_tokens) / (2 * block_tokens)).cast("bigint")
    seats = targeted.withColumn("n_sources", F.count(F.lit(1)).over(Window.partitionBy())).select(
        "*",
        F.ceil(F.col("source_size") / block_tokens).alias("blocks"),
        F.explode(F.sequence(F.lit(1), F.lit(shards))).alias("upto"),
    )
    seats = seats.withColumn("house", F.floor(whole * F.col("upto") / shards).cast("bigint"))
    share = F.coalesce(F.col("target") / F.when(F.col("total") > 0, F.col("total")), F.lit(0.0))
    half = F.col("n_sources") / 2
    low = F.greatest(F.lit(0), F.floor(share * (F.col("house") - half) + 0.5) - 1)
    high = F.least(F.col("blocks") * cap, F.floor(share * (F.col("house") + half) + 0.5) + 1)
    seats = seats.withColumn("high", high).withColumn("low", F.least(low, F.col("high")))
    open_quotients = seats.filter("low < high").select(
        "place", "upto", "target", F.explode(F.expr("sequence(low, high - 1)")).alias("k")
    )
    by_house = Window.partitionBy("upto")
    given = seats.select("upto", "place", (F.col("house") - F.sum("low").over(by_house)).alias("left"))
    best = Window.partitionBy("upto").orderBy((F.col("target") / (2 * F.col("k") + 1)).desc(), "place")
    won = (
        open_quotients.withColumn("rank", F.row_number().over(best))
        .join(given, ["upto", "place"])
        .groupBy("upto", "place")
        .agg(F.count(F.when(F.col("rank") <= F.col("left"), 1)).alias("won"))
    )
    upto = Window.partitionBy("place").orderBy("upto")
    total = F.col("low") + F.coalesce(F.col("won"), F.lit(0))
    counted = seats.join(won, ["upto", "place"], "left").withColumn("upto_quota", total)
    return counted.select(
        "source",
        "place",
        "source_size",
        "target",
        "blocks",
        (F.col("upto") - 1).alias("shard"),
        (F.col("upto_quota") - F.coalesce(F.lag("upto_quota").over(upto), F.lit(0))).alias("quota"),
    )


def stream_places(sized: DataFrame, seed: int = SEED) -> DataFrame:
    """Distinct ``(doc_id, source, size)`` with ``copies`` and the word ``start`` in the source's stream."""
    order = _seeded(F.col("source"), F.col("doc_id"), F.col("size"), seed=seed)
    groups = sized.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("copies"))
    groups = groups.withColumn("order", order).withColumn("cell", F.substring("order", 1, 3))
    words = F.col("size") * F.col("copies")
    cells = groups.groupBy("source", "cell").agg(F.sum(words).alias("words"))
    before = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(
        F.col("source").alias("cell_source"), F.col("cell").alias("cell_name"),
        F.coalesce(F.sum("words").over(before), F.lit(0)).alias("cell_start"),
    )
    inside = Window.partitionBy("source", "cell").orderBy("order", "doc_id", "size")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = groups.withColumn("inside", F.coalesce(F.sum(words).over(inside), F.lit(0)))
    same = F.col("source").eqNullSafe(F.col("cell_source")) & (F.col("cell") == F.col("cell_name"))
    return placed.join(cells, same).select(
        "doc_id", "source", "size", "copies", (F.col("cell_start") + F.col("inside")).alias("start")
    )


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    cap: int = CAP,
    block_tokens: int = BLOCK_TOKENS,
    shards: int = SHARDS,
    seed: int = SEED,
    workspace: Workspace | None = None,
) -> DataFrame:
    """One row per document: sizes, its source's target, and what the mix takes of it.

    ``passes`` counts whole passes; ``cut_1`` and ``cut_2`` are the half-open ranges of its words (from 0)
    that one more, partial pass takes; ``taken`` counts the words of both. ``copy`` numbers equal rows.
    """
    workspace = workspace or Workspace(docs.sparkSession)
    sized = workspace.table(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    shared = quotas(targets(sources, weights, cap), block_tokens, cap, shards)
    plan = shared.groupBy("source", "source_size", "target", "blocks").agg(F.sum("quota").alias("quota"))
    plan = workspace.table(plan, "plan")
    start_draw = F.conv(F.substring(_seeded(F.col("source"), F.lit("start"), seed=seed), 1, 8), 16, 10).cast("bigint")
    some = F.when(F.col("blocks") > 0, F.col("blocks"))
    plan = plan.select(
        F.col("source").alias("plan_source"), "source_size", "target", "blocks",
        F.coalesce(F.expr("quota div nullif(blocks, 0)"), F.lit(0)).alias("passes"),
        F.coalesce(F.col("quota") % some, F.lit(0)).alias("run"),
        F.coalesce(start_draw % some, F.lit(0)).alias("first"),
    )
    from_word = F.col("first") * block_tokens
    to_word = F.least((F.col("first") + F.col("run")) * block_tokens, F.col("source_size"))
    wrapped = F.greatest(F.col("first") + F.col("run") - F.col("blocks"), F.lit(0)) * block_tokens
    plan = plan.select("*", from_word.alias("from_1"), to_word.alias("to_1"), wrapped.alias("to_2"))
    joined = stream_places(sized, seed).join(plan, F.col("source").eqNullSafe(F.col("plan_source")))
    steps = F.expr(f"explode(sequence(0, (copies - 1) div {_COPIES_PER_STEP}))")
    within = F.expr(f"explode(sequence(0, least(copies - step * {_COPIES_PER_STEP}, {_COPIES_PER_STEP}) - 1))")
    copies = joined.withColumn("step", steps).withColumn("inner", within)
    copies = copies.withColumn("copy", F.col("step") * _COPIES_PER_STEP + F.col("inner"))
    copies = copies.withColumn("at", F.col("start") + F.col("copy") * F.col("size"))

    def overlap(low: Column, high: Column) -> Column:
        return F.struct(
            F.least(F.greatest(low - F.col("at"), F.lit(0)), F.col("size")).alias("from"),
            F.least(F.greatest(high - F.col("at"), F.lit(0)), F.col("size")).alias("to"),
        )

    cut = copies.withColumns({"cut_1": overlap(F.col("from_1"), F.col("to_1")), "cut_2": overlap(F.lit(0), F.col("to_2"))})
    parts = F.col("cut_1.to") - F.col("cut_1.from") + F.col("cut_2.to") - F.col("cut_2.from")
    return cut.select(
        "doc_id", "source", "size", "copy", "source_size", "target", "passes", "cut_1", "cut_2",
        (F.col("passes") * F.col("size") + parts).cast("bigint").alias("taken"),
    )


def mixed_documents(docs: DataFrame, workspace: Workspace | None = None, **options) -> DataFrame:
    """The mix as documents: whole texts once per pass, and the words of the partial pass.

    Rows of equal id, source and size are matched with their takes by a number that salted
    counts give them, so no group is ordered in one task; texts move once, after that. ``n_chars`` is recounted.
    """
    workspace = workspace or Workspace(docs.sparkSession)
    taken = mix(docs, workspace=workspace, **options).filter("taken > 0")
    record = F.struct(*[docs[c] for c in docs.columns]).alias("record")  # other columns' names can't clash in it
    number = F.monotonically_increasing_id()
    held = docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), number.alias("row_number"),
        F.pmod(F.xxhash64(number), F.lit(256)).alias("salt"), F.xxhash64("text").alias("text_hash"), record,
    )
    held = workspace.table(held, "records")
    key = ["doc_id", "source", "size"]
    salts = held.groupBy(*key, "salt").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(*key).orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    salts = salts.select(*[F.col(c).alias(f"s_{c}") for c in (*key, "salt")], F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    same = F.col("salt") == F.col("s_salt")
    for c in key:
        same = same & F.col(c).eqNullSafe(F.col(f"s_{c}"))
    place = F.row_number().over(Window.partitionBy(*key, "salt").orderBy("text_hash", "row_number"))
    slim = held.select(*key, "salt", "row_number", "text_hash").withColumn("place", place)
    numbered = slim.join(salts, same).withColumn("copy", F.col("first") + F.col("place") - 1)
    takes = taken.select(*[F.col(c).alias(f"t_{c}") for c in (*key, "copy")], "passes", "cut_1", "cut_2")
    match = F.col("copy") == F.col("t_copy")
    for c in key:
        match = match & F.col(c).eqNullSafe(F.col(f"t_{c}"))
    chosen = numbered.join(takes, match).select("row_number", "passes", "cut_1", "cut_2")
    # only here texts move
    joined = held.select("row_number", "size", "record").join(chosen, "row_number").withColumn("text", F.col("record.text"))
    words = F.regexp_extract_all(F.col("text"), F.lit(WORD), F.lit(0))
    pieces = [F.slice("words", (F.col(f"{c}.from") + 1).cast("int"), (F.col(f"{c}.to") - F.col(f"{c}.from")).cast("int")) for c in ("cut_2", "cut_1")]
    cut_words = (F.col("cut_1.to") - F.col("cut_1.from")) + (F.col("cut_2.to") - F.col("cut_2.from"))
    partial = F.when(cut_words == F.col("size"), F.col("text")).otherwise(F.array_join(F.concat(*pieces), " "))
    joined = joined.withColumn("words", F.when((cut_words > 0) & (cut_words < F.col("size")), words).otherwise(F.array().cast("array<string>")))
    texts = F.concat(
        F.array_repeat(F.col("text"), F.col("passes").cast("int")),
        F.when(cut_words > 0, F.array(partial)).otherwise(F.array().cast("array<string>")),
    )
    exploded = joined.select("record", F.explode(texts).alias("clean"))
    new = {"text": F.col("clean"), "n_chars": F.char_length("clean").cast("bigint")}
    return exploded.select(*[new.get(c, F.col("record").getField(c)).alias(c) for c in docs.columns])
