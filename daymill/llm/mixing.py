"""Mixing sources to target weights by Sainte-Laguë apportionment of equal blocks. DataFrame operations only."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymill import workspace

BLOCK_WORDS = 16
SHARD_WORDS = 1 << 18
LEVELS = 256
WEIGHTS = (3, 1, 2)


def targets(sources: DataFrame, weights=WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """Sources (source, source_size, ...) with `source_no` by code point, null last, and `target`.

    Targets share `share` times all sizes by weight; none goes beyond `cap` times its source's size, and what is
    above is shared again by weight. The fixed point is min(cap * size, level * weight) with one level for all:
    with sources in order of cap * size / weight, it is the largest level that follows from capping those before a
    source and does not go beyond the source's own bound. The windows run over one row per source.
    """
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(w) for w in weights])
    bound = F.col("source_size") * F.lit(cap)
    order = Window.orderBy("_ratio", "source_no")
    before = F.coalesce(F.sum("_bound").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("_weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(Window.partitionBy())
    numbered = sources.withColumn("source_no", number).withColumns(
        {"_weight": F.get(cycle, F.col("source_no") % len(weights)), "_bound": bound}
    )
    levels = numbered.withColumn("_ratio", F.col("_bound") / F.col("_weight")).withColumn(
        "_level", (total * F.lit(share) - before) / left
    )
    level = F.max(F.when(F.col("_level") <= F.col("_ratio"), F.col("_level"))).over(Window.partitionBy())
    return levels.withColumn("_common", level).withColumn(
        "target", F.least("_bound", F.coalesce(F.col("_common") * F.col("_weight"), F.lit(0.0)))
    ).drop("_weight", "_bound", "_ratio", "_level", "_common")


def _with_totals(rows: DataFrame, keys: list[str], **totals: Column) -> DataFrame:
    """Rows with aggregates of their group, combined in tasks before they meet. Without keys the rows are few."""
    if keys:
        return rows.join(rows.groupBy(*keys).agg(*[total.alias(name) for name, total in totals.items()]), keys)
    return rows.withColumns({name: total.over(Window.partitionBy()) for name, total in totals.items()})


def _levels(quotients: DataFrame, keys: list[str]) -> DataFrame:
    """Quotients with the part of their group they fall in, from the highest down, and the number of rows in higher
    parts. The bounds are about quantiles, so that no task ranks more than about one in LEVELS of a group besides equal
    quotients; whatever the bounds, the numbers are exact."""
    shares = F.array(*[F.lit(k / LEVELS) for k in range(1, LEVELS)])
    bounds = quotients.groupBy(*keys).agg(F.percentile_approx("_quotient", shares, F.lit(16 * LEVELS)).alias("_bounds"))
    level = F.size(F.filter("_bounds", lambda bound: bound > F.col("_quotient")))
    levelled = quotients.join(bounds, keys).withColumn("_level", level).drop("_bounds")
    higher = Window.partitionBy(*keys).orderBy("_level").rowsBetween(Window.unboundedPreceding, -1)
    numbers = levelled.groupBy(*keys, "_level").agg(F.count(F.lit(1)).alias("_here"))
    numbers = numbers.withColumn("_before", F.coalesce(F.sum("_here").over(higher), F.lit(0))).drop("_here")
    return levelled.join(numbers, [*keys, "_level"])


def sainte_lague(parties: DataFrame, keys: list[str], party: str, votes: Column, seats: Column) -> DataFrame:
    """(keys, party, seats): per group of `keys`, its seats go to the highest quotients votes / (2k - 1).

    Only quotients near the ideal share are ranked. With n seats and p parties, the divisor at which seats add up
    lies within p / 2 seats of the ideal one, so each party's seats lie within ideal * p / (2n) + 1 of its ideal;
    that is a few rows per party, whatever the number of seats. Ties go to the smaller party.

    With keys a group may hold any number of parties: its quotients are parted by quantiles, counted, and ranked
    part by part in different tasks. Without keys all parties are ranked in one task: for sources, not for shards.
    """
    counted = parties.select(*keys, party, votes.cast("double").alias("_v"), seats.cast("long").alias("_n"))
    counted = _with_totals(counted, keys, _all=F.sum("_v"), _parties=F.count(F.lit(1)))
    ideal = F.coalesce(F.col("_n") * F.col("_v") / F.nullif(F.col("_all"), F.lit(0.0)), F.lit(0.0))
    slack = F.coalesce(F.col("_ideal") * F.col("_parties") / (2 * F.nullif(F.col("_n"), F.lit(0))), F.lit(0.0))
    bounded = counted.withColumn("_ideal", ideal).withColumn("_slack", slack).withColumns(
        {
            "_low": F.greatest(F.lit(0), F.floor(F.col("_ideal") - F.col("_slack")) - 1).cast("long"),
            "_high": (F.ceil(F.col("_ideal") + F.col("_slack")) + 1).cast("long"),
        }
    )
    bounded = _with_totals(bounded, keys, _sure=F.sum("_low")).withColumn("_open", F.col("_n") - F.col("_sure"))
    quotients = bounded.select(
        *keys, party, "_v", "_low", "_open", F.explode(F.sequence(F.col("_low") + 1, F.col("_high"))).alias("_k")
    ).withColumn("_quotient", F.col("_v") / (2 * F.col("_k") - 1))
    if keys:
        ranked = _levels(workspace.materialize(quotients, "quotients"), keys)
    else:
        ranked = quotients.withColumns({"_level": F.lit(0), "_before": F.lit(0)})
    order = Window.partitionBy(*keys, "_level").orderBy(F.col("_quotient").desc(), party, "_k")
    won = F.sum((F.col("_before") + F.col("_place") <= F.col("_open")).cast("long")) + F.first("_low")
    return ranked.withColumn("_place", F.row_number().over(order)).groupBy(*keys, party).agg(won.alias("seats"))


def mix(docs: DataFrame, size: Column, *, id_col: str = "doc_id", source_col: str = "source", weights=WEIGHTS,
        share: float = 1.5, cap: float = 2.0, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS,
        seed: int = 0) -> DataFrame:
    """`row` (the columns of `docs` as a struct), size, source_size, target, taken (words the mix takes of it).

    Blocks of `block_words` words are shared among sources by Sainte-Laguë with the targets as votes, and each
    source's blocks among its shards with their sizes as votes. Shards part a source by a seeded hash of the ids,
    about `shard_words` words each, so a source with a third of all rows is as many tasks as its size asks for.
    In a shard, documents in seeded order form one stream of blocks; the quota takes the whole stream as often as it
    fits and then the first blocks of another pass, so at most one document per shard is cut. No document is
    taken beyond `cap` times. Same input and seed, same result.

    Null sources are one source; null ids are hashed as a text of their own; documents without words take nothing;
    repeated rows count each. Sizes, sources and ids go to the shared folder once, whole rows with them.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    mark = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))).cast("binary"))
    sized = docs.select(row.alias("row"), F.col(source_col).alias("source"), size.alias("size"), mark.alias("mark"))
    sized = workspace.materialize(sized, "sized")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_rows"))
    sources = targets(sources, weights, share, cap)
    blocks = F.floor(F.sum("target").over(Window.partitionBy()) / block_words + 0.5)
    quotas = sainte_lague(sources.withColumn("_blocks", blocks), [], "source_no", F.col("target"), F.col("_blocks"))
    shards = F.ceil((F.col("source_size") + F.col("_rows")) / shard_words).cast("long")
    sources = sources.join(quotas, "source_no").select(
        F.col("source").alias("_source"), "source_no", "source_size", "target", "seats", shards.alias("_shards")
    )
    sources = workspace.materialize(sources, "sources")
    dealt = sized.join(sources, F.col("source").eqNullSafe(F.col("_source"))).withColumn(
        "shard", F.conv(F.substring("mark", 1, 8), 16, 10).cast("long") % F.col("_shards")
    )
    parts = dealt.groupBy("source_no", "shard").agg(F.sum("size").alias("shard_size"), F.first("seats").alias("_seats"))
    parts = workspace.materialize(parts, "shards")
    per_shard = sainte_lague(parts, ["source_no"], "shard", F.col("shard_size"), F.col("_seats"))
    quota = F.least(F.col("seats") * block_words, F.floor(F.col("shard_size") * cap)).alias("_quota")
    parts = parts.join(per_shard, ["source_no", "shard"]).select("source_no", "shard", "shard_size", quota)
    order = Window.partitionBy("source_no", "shard").orderBy("mark", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.drop("seats").withColumn("_at", F.coalesce(F.sum("size").over(order), F.lit(0)))
    whole = F.coalesce(F.floor(F.col("_quota") / F.nullif(F.col("shard_size"), F.lit(0))), F.lit(0))
    extra = F.greatest(F.lit(0), F.least(F.col("size"), F.col("_quota") - whole * F.col("shard_size") - F.col("_at")))
    return placed.join(parts, ["source_no", "shard"]).select(
        "row", "size", "source_size", "target", (whole * F.col("size") + extra).cast("long").alias("taken")
    )


def mixed_rows(mixed: DataFrame) -> DataFrame:
    """The rows of the mix, whole documents: each as often as its taken words are nearest to; none of those left out."""
    copies = F.floor(F.col("taken") / F.nullif(F.col("size"), F.lit(0)) + 0.5).cast("int")
    repeated = mixed.select("row", F.explode(F.array_repeat(F.lit(0), F.coalesce(copies, F.lit(0)))).alias("_"))
    return repeated.select("row.*")


def oracle(block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: int = 0) -> str:
    """The query's rows in SQL: targets by the level, seats by ranking every quotient that could win."""
    return f"""
    WITH sized AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
               md5('{seed}:' || coalesce(doc_id::VARCHAR, 'null')) AS mark FROM documents),
    s0 AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n FROM sized GROUP BY source),
    s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS no FROM s0),
    s2 AS (SELECT *, [3, 1, 2][1 + no % 3] AS w, source_size * 2.0::DOUBLE AS bound FROM s1),
    s3 AS (SELECT *, ((sum(source_size) OVER ()) * 1.5::DOUBLE - coalesce(sum(bound) OVER (ORDER BY bound / w, no
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / (sum(w) OVER (ORDER BY bound / w, no
               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS level FROM s2),
    s4 AS (SELECT *, least(bound, coalesce(max(CASE WHEN level <= bound / w THEN level END) OVER () * w, 0)) AS target FROM s3),
    s5 AS (SELECT *, floor(sum(target) OVER () / {block_words} + 0.5)::BIGINT AS blocks,
               sum(target) OVER () AS votes, ceil((source_size + n) / {shard_words}.0)::BIGINT AS shards FROM s4),
    q1 AS (SELECT no, target, blocks, unnest(range(1, (2 * blocks * target / votes)::BIGINT + 4)) AS k FROM s5),
    q2 AS (SELECT no, row_number() OVER (ORDER BY target / (2 * k - 1) DESC, no, k) <= blocks AS won FROM q1),
    q3 AS (SELECT no, count(*) FILTER (won) AS seats FROM q2 GROUP BY no),
    d1 AS (SELECT d.*, no, source_size, target, seats, ('0x' || substr(mark, 1, 8))::UBIGINT % shards AS shard
           FROM sized d JOIN s5 ON d.source IS NOT DISTINCT FROM s5.source JOIN q3 USING (no)),
    p1 AS (SELECT no, shard, sum(size)::BIGINT AS shard_size, any_value(seats) AS seats FROM d1 GROUP BY ALL),
    p2 AS (SELECT *, unnest(range(1, coalesce(2 * seats * shard_size / nullif(sum(shard_size) OVER (PARTITION BY no), 0), 0)::BIGINT + 4)) AS k FROM p1),
    p3 AS (SELECT *, row_number() OVER (PARTITION BY no ORDER BY shard_size::DOUBLE / (2 * k - 1) DESC, shard, k) <= seats AS won FROM p2),
    p4 AS (SELECT no, shard, any_value(shard_size) AS shard_size, least(count(*) FILTER (won) * {block_words}, 2 * any_value(shard_size)) AS quota
           FROM p3 GROUP BY ALL),
    d2 AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY no, shard ORDER BY mark, size
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d1)
    SELECT doc_id, size::BIGINT AS size, source_size, target,
           (coalesce(quota // nullif(shard_size, 0), 0) * size + greatest(0, least(size,
               quota - coalesce(quota // nullif(shard_size, 0), 0) * shard_size - before)))::BIGINT AS taken
    FROM d2 JOIN p4 USING (no, shard)"""
