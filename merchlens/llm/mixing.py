"""Mixing sources to target weights by temperature, in DataFrame operations only.

Source shares of the corpus are raised to a common exponent between 0 (all sources alike) and 1 (as they are) and
normalised. The exponent is bisected until the weights meet a target entropy or keep every source within a repetition
limit. The weights become token budgets, and each budget is filled with passes over the source's documents in blocks,
the blocks of every pass in an order of their own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from merchlens.llm.shared import written

LEVELS = 6
ROUNDS = 6


@dataclass(frozen=True)
class Settings:
    """What the mix should meet.

    `entropy` is the wanted entropy of the weights as a share of that of equal weights, `repetitions` the most often a
    source may be read; with both, the limit wins. `budget` is the number of tokens, by default those of the corpus.
    `block_rows` is the number of documents in a block, on average.
    """

    entropy: float | None = 0.97
    repetitions: float | None = 4.0
    budget: int | None = None
    block_rows: int = 2000
    seed: int = 1


def token_counts(documents: DataFrame) -> DataFrame:
    """(doc_id, source, tokens) per row: white-space separated words; a NULL source is the source ''."""
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("tokens"),
    )


def exponent(sources: DataFrame, settings: Settings = Settings()) -> float:
    """The exponent for (source, tokens): bisected, with all nodes of several bisection levels in one job.

    Both the entropy and the largest number of repetitions fall as the exponent rises. The largest exponent
    whose entropy is at least the target is taken, or the smallest one within the repetition limit if that is larger.
    Where even exponent 1 breaks the limit, 1 is taken. Sources without tokens have no weight.
    """
    logs = sources.where("tokens > 0").select("tokens", F.log("tokens").alias("l"))
    facts = logs.agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("tokens"), F.max("l").alias("top")).first()
    if not facts.n or facts.n == 1:
        return 1.0
    budget = settings.budget if settings.budget is not None else facts.tokens
    # Shares relative to the largest source, so that no power overflows.
    relative = logs.select((F.col("l") - facts.top).alias("l"))

    def bisect(meets: Column) -> float:
        """The boundary below which `meets` fails and above which it holds, within [0, 1]."""
        low, high = 0.0, 1.0
        for _ in range(ROUNDS):
            nodes = [low + (high - low) * k / 2**LEVELS for k in range(1, 2**LEVELS)]
            tried = relative.select("l", F.explode(F.array(*[F.lit(x) for x in nodes])).alias("a"))
            power = F.exp(F.col("a") * F.col("l"))
            sums = tried.groupBy("a").agg(F.sum(power).alias("z"), F.sum(power * F.col("a") * F.col("l")).alias("e"), F.min("l").alias("small"))
            # One row per tried exponent, 63 in all.
            holds = {r.a: r.ok for r in sums.select("a", meets.alias("ok")).collect()}
            low = max([low, *[a for a in nodes if not holds[a]]])
            high = min([high, *[a for a in nodes if holds[a] and a > low]])
        return high

    # H = ln z - e / z for weights exp(a * l) / z.
    entropy = F.log("z") - F.col("e") / F.col("z")
    result = 1.0
    if settings.entropy is not None:
        result = bisect(entropy < settings.entropy * F.log(F.lit(float(facts.n))))
    if settings.repetitions is not None:
        # The smallest source is repeated most: weight * budget / tokens.
        most = F.exp(F.col("a") * F.col("small")) / F.col("z") * budget / F.exp(F.col("small") + facts.top)
        limit = bisect(most <= settings.repetitions)
        result = max(result, limit) if settings.entropy is not None else limit
    return result


def weights(sources: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(source, tokens, rows, weight, budget, exponent) per source; budgets are whole tokens, rounded down."""
    chosen = exponent(sources, settings)
    power = F.when(F.col("tokens") > 0, F.exp(F.lit(chosen) * F.log("tokens"))).otherwise(F.lit(0.0))
    totals = sources.agg(F.sum(power).alias("z"), F.sum("tokens").alias("all_tokens"))
    total = F.lit(settings.budget).cast("long") if settings.budget is not None else F.col("all_tokens")
    # One row is joined to the sources.
    return sources.crossJoin(F.broadcast(totals)).select(
        "source", "tokens", "rows",
        F.when(F.col("z") > 0, power / F.col("z")).otherwise(F.lit(0.0)).alias("weight"),
        F.when(F.col("z") > 0, F.floor(power / F.col("z") * total)).otherwise(F.lit(0)).cast("long").alias("budget"),
        F.lit(chosen).alias("exponent"),
    )


def mix(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per reading of a document: doc_id, source, tokens, pass, place, weight, exponent.

    A source with budget b and size t is read floor(b / t) whole times, and once more up to the document in which the
    rest of the budget ends, that one included. `pass` counts from 0. `place`, in 0..1, is where in the mix the reading
    begins: sorting all rows by place gives a sequence with the target weights throughout. Documents without tokens
    are never read. Rows that repeat an id are documents of their own; between equal rows the order is arbitrary and
    the result the same. No rows give no rows.

    Blocks are dealt by hash and hold a bounded number of documents, whatever the source's size, so no task sorts a
    source: only the list of blocks is ordered per source and pass, and documents within their block.
    """
    counts = written(token_counts(documents).where("tokens > 0"), "tokens")
    sources = written(counts.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")), "sources")
    plan = written(weights(sources, settings), "weights").withColumn("blocks", F.ceil(F.col("rows") / settings.block_rows))
    seeded = plan.select("source", F.col("tokens").alias("size"), "weight", "budget", "exponent", "blocks")
    placed = counts.join(seeded, "source").withColumn(
        "block", F.pmod(F.xxhash64(F.lit(settings.seed), F.col("doc_id"), F.col("source"), F.col("tokens")), F.col("blocks"))
    )
    inside = placed.groupBy("source", "block").agg(
        F.sum("tokens").alias("held"), F.first("size").alias("size"), F.first("budget").alias("budget"), F.first("blocks").alias("blocks")
    )
    passes = F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0), F.ceil(F.col("budget") / F.col("size")) - 1).cast("long"))
    ordered = inside.where("budget > 0").select("source", "block", "held", "size", "budget", F.explode(passes).alias("pass"))
    order = Window.partitionBy("source", "pass").orderBy(F.xxhash64(F.lit(settings.seed), "pass", "block"), "block")
    starts = ordered.withColumn(
        "start", F.col("pass") * F.col("size") + F.sum("held").over(order.rowsBetween(Window.unboundedPreceding, -1))
    ).select("source", "block", "pass", F.coalesce("start", F.col("pass") * F.col("size")).alias("start"))
    read = placed.join(starts.where("start IS NOT NULL"), ["source", "block"]).where(F.col("start") < F.col("budget"))
    within = Window.partitionBy("source", "block", "pass").orderBy(
        F.xxhash64(F.lit(settings.seed), "pass", "doc_id", "tokens"), "doc_id", "tokens"
    ).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begun = read.withColumn("begin", F.col("start") + F.sum("tokens").over(within) - F.col("tokens"))
    return begun.where("begin < budget").select(
        "doc_id", "source", "tokens", F.col("pass").cast("int").alias("pass"),
        (F.col("begin") / F.col("budget")).alias("place"), "weight", "exponent",
    )
