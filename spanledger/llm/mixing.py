"""Mixing sources to target weights by temperature; DataFrame functions only."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanledger.llm.common import whole_row
from spanledger.session import materialize

#: One pass over the source table tries this many exponents, which halves the interval five times.
_TRIES = 31
_PASSES = 8
#: Exponents beyond 1 sharpen the weights; powers of any share stay above the least double.
_LARGEST = 32.0
#: Sources beyond this are joined by a shuffle instead of a broadcast.
BROADCAST_SOURCES = 100_000


@dataclass(frozen=True)
class MixTarget:
    """Either ``entropy``: of the weights, as a share of the largest possible; or ``max_epochs``: the most often that any
    source may be repeated. Budget in tokens: ``budget``, or what gives the least repeated source ``least_epochs``, or all tokens
    once."""

    entropy: float | None = None
    max_epochs: float | None = None
    budget: int | None = None
    least_epochs: float | None = None
    blocks: int = 1024
    seed: int = 17

    def __post_init__(self):
        if (self.entropy is None) == (self.max_epochs is None):
            raise ValueError("give either an entropy or a limit of epochs")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _marked(docs: DataFrame, target: MixTarget, source_col: str, text_col: str, id_col: str) -> DataFrame:
    """doc (the row), _source (null is a source of its own), _tokens, _at (place in its block's permutation), _block and _turn (the
    block's place in its source's permutation). Stored, as the place depends on the row's number, which another read may deal
    differently."""
    source = F.struct(F.col(source_col).isNull().alias("missing"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("name"))
    at = F.xxhash64(F.lit(target.seed), F.col(id_col), F.monotonically_increasing_id())
    marked = (
        docs.select(whole_row(docs), source.alias("_source"), word_count(F.col(text_col).cast("string")).alias("_tokens"), at.alias("_at"))
        .withColumn("_block", F.pmod(F.shiftright("_at", 20), F.lit(target.blocks)))
        .withColumn("_turn", F.xxhash64(F.lit(target.seed + 1), "_source", "_block"))
    )
    return materialize(marked, "marked-documents")


def find_exponent(shares: DataFrame, target: MixTarget) -> tuple[float, float]:
    """(exponent, sum of the powers) for ``shares`` (share > 0 per source).

    The weights p^a / sum p^a get more even as a falls: their entropy rises, and so do the epochs of small sources. Bisection
    finds the exponent from 0 to ``_LARGEST`` at which the entropy equals its target (the largest that reaches it), or the smallest from 0 to 1
    within the limit of epochs; a target that neither end can meet gives the nearer one.
    """
    low, high = 0.0, 1.0 if target.entropy is None else _LARGEST
    for _ in range(_PASSES):
        tries = [low + (high - low) * k / (_TRIES + 1) for k in range(_TRIES + 2)]
        rows = _tried(shares, tries).collect()  # one row per exponent tried
        if not rows:
            return 1.0, 1.0
        meets = {r.a: _meets(r, target) for r in rows}
        if target.entropy is not None:
            good = [a for a in tries if meets[a]]
            best = max(good, default=low)
            low, high = best, min([a for a in tries if a > best], default=best)
        else:
            good = [a for a in tries if meets[a]]
            best = min(good, default=high)
            low, high = max([a for a in tries if a < best], default=best), best
        if low == high:
            break
    exponent = low if target.entropy is not None else high
    return exponent, _tried(shares, [exponent]).first().z


def _tried(shares: DataFrame, tries: list[float]) -> DataFrame:
    power = F.pow("share", F.col("a"))
    return (
        shares.withColumn("a", F.explode(F.array(*map(F.lit, tries)))).groupBy("a")
        .agg(F.sum(power).alias("z"), F.sum(power * F.log("share")).alias("s"), F.count("*").alias("n"),
             F.max(F.pow("share", F.col("a") - 1)).alias("most"), F.min(F.pow("share", F.col("a") - 1)).alias("least"),
             F.max("total").alias("total"))
    )


def _budget(row, target: MixTarget) -> float:
    if target.budget is not None:
        return float(target.budget)
    if target.least_epochs is not None:
        return target.least_epochs * row.total * row.z / row.least
    return float(row.total)


def _meets(row, target: MixTarget) -> bool:
    if target.entropy is not None:
        return math.log(row.z) - row.a * row.s / row.z >= target.entropy * math.log(max(row.n, 1)) - 1e-12
    return row.most * _budget(row, target) / (row.total * row.z) <= target.max_epochs * (1 + 1e-12)


def source_plan(marked: DataFrame, target: MixTarget) -> DataFrame:
    """One row per source: _source, tokens, weight, epochs, _full (copies of every document), _last_turn, _last_at (documents up to
    there in the permutation get one more)."""
    blocks = materialize(
        marked.groupBy("_source", "_block", "_turn").agg(F.sum("_tokens").alias("tokens")), "source-blocks"
    )
    totals = blocks.groupBy("_source").agg(F.sum("tokens").alias("tokens"))
    total = totals.agg(F.sum("tokens")).first()[0] or 0
    totals = totals.withColumn("total", F.lit(float(total))).withColumn("share", F.col("tokens") / F.lit(float(max(total, 1))))
    totals = materialize(totals, "source-tokens")
    shares = totals.filter("tokens > 0")
    exponent, z = find_exponent(shares, target)
    found = _tried(shares, [exponent]).first()
    budget = _budget(found, target) if found else 0.0
    weight = F.when(F.col("tokens") > 0, F.pow("share", F.lit(exponent)) / z).otherwise(0.0)
    # a source without tokens costs nothing and is kept once
    epochs = F.when(F.col("tokens") > 0, F.col("weight") * budget / F.col("tokens")).otherwise(1.0)
    # whole epochs up to rounding errors
    full = F.floor(F.col("epochs") + 1e-9).cast("long")
    extra = F.greatest(F.lit(0), F.floor(F.col("weight") * budget + 1e-6).cast("long") - F.col("_full") * F.col("tokens"))
    plan = totals.withColumn("weight", weight).withColumn("epochs", epochs).withColumn("_full", full).withColumn("_extra", extra)
    # at most ``blocks`` rows of a source
    order = Window.partitionBy("_source").orderBy("_turn", "_block")
    placed = blocks.withColumn("_sum", F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    first_over = (
        placed.join(plan.select("_source", "_extra"), "_source").filter(F.col("_sum") > F.col("_extra")).groupBy("_source")
        .agg(F.min_by(F.struct("_turn", "_block", (F.col("_extra") - F.col("_sum") + F.col("tokens")).alias("_left")), F.struct("_turn", "_block")).alias("cut"))
        .select("_source", "cut.*")
    )
    cut = materialize(first_over, "cut-blocks")
    inside = marked.join(_small(cut), ["_source", "_turn", "_block"]).select("_source", "_at", "_tokens", "_left")
    within = Window.partitionBy("_source").orderBy("_at").rangeBetween(Window.unboundedPreceding, 0)
    last = (
        inside.withColumn("_sum", F.sum("_tokens").over(within)).filter("_sum <= _left").groupBy("_source")
        .agg(F.max("_at").alias("_last_at"))
    )
    return (
        plan.join(cut.select("_source", F.col("_turn").alias("_last_turn"), F.col("_block").alias("_last_block")), "_source", "left")
        .join(last, "_source", "left")
        .select("_source", "tokens", "weight", "epochs", "_full", "_extra", "_last_turn", "_last_block", "_last_at")
    )


def _small(sources: DataFrame) -> DataFrame:
    return F.broadcast(sources) if sources.count() <= BROADCAST_SOURCES else sources


def _mixed(docs: DataFrame, target: MixTarget, source_col: str = "source", text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    marked = _marked(docs, target, source_col, text_col, id_col)
    plan = materialize(source_plan(marked, target), "source-plan")
    taken = (
        F.col("_last_turn").isNull()
        | (F.struct("_turn", "_block") < F.struct("_last_turn", "_last_block"))
        | ((F.col("_turn") == F.col("_last_turn")) & (F.col("_block") == F.col("_last_block"))
           & F.coalesce(F.col("_at") <= F.col("_last_at"), F.lit(False)))
    )
    more = F.when((F.col("_extra") > 0) & taken, 1).otherwise(0)
    return marked.join(_small(plan), "_source").select(
        "doc", (F.col("_full") + more).alias("mix_copies"), F.col("_tokens").alias("mix_tokens"),
        F.col("weight").alias("mix_weight"), F.col("_turn").alias("mix_turn"),
    )


def mix_sources(docs: DataFrame, target: MixTarget, **columns: str) -> DataFrame:
    """``docs`` with mix_copies (how often each row occurs in the mix), mix_tokens, mix_weight (of its source) and mix_turn
    (order of its block in the permutation), which replace columns of these names; rows with no copies are kept with 0.
    ``columns``: source_col, text_col, id_col.

    Token shares are tempered to the target; a source's budget gives every row its whole epochs, and the rest goes to blocks in a
    seeded permutation, and within the block where the budget ends to rows in a seeded order, so that a source misses its
    budget by less than one document. A null source is a source of its own; null and empty texts cost nothing, and a source
    of only such texts, or a table without any token, is kept once; repeated rows are rows of their own; an empty table gives an
    empty one. A source of any size is dealt over all tasks: windows see its block sums, and the rows of one block of many.
    """
    mixed = _mixed(docs, target, **columns)
    added = mixed.columns[1:]
    return mixed.select(*[F.col(f"doc.`{c}`") for c in docs.columns if c.lower() not in added], *added)


def mixed_documents(docs: DataFrame, target: MixTarget, **columns: str) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as ``mix_sources`` says, with the columns of ``docs``, whatever their names.
    Null and empty texts, null sources, repeated rows and empty tables as there."""
    mixed = _mixed(docs, target, **columns).filter("mix_copies > 0")
    copies = F.explode(F.sequence(F.lit(1), F.col("mix_copies").cast("int")))
    return mixed.select("doc", copies).select("doc.*")
