"""Mixing sources to target weights: iterative proportional fitting, then sampling by calibrated probabilities."""

from __future__ import annotations

import warnings
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import small_frame
from .common import Scratch, fresh, text_hash

SWEEPS, BLOCK = 60, 6      # sweeps over all margins at most, and between two looks at the error
CLOSE = 1e-6               # largest relative error of a margin at which fitting ends


def _value(name: str) -> Column:
    """A margin's value as text; null differs from every text."""
    return F.when(F.col(name).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(name).cast("string")))


Target = float | Mapping[str | None, float]


def _targets(cells: DataFrame, margin: str, target: Target, whole: int) -> DataFrame:
    """(margin's value, target tokens) for each value of a margin; the targets add up to ``whole``."""
    held = cells.groupBy(margin).agg(F.sum("tokens").alias("held"))
    if isinstance(target, Mapping):
        given = sum(target.values())
        if min(target.values(), default=0.0) < 0 or given > 1 + 1e-9:
            raise ValueError(f"shares must not be negative or add up to more than 1: {dict(target)}")
        rows = [("" if value is None else f"={value}", float(share)) for value, share in target.items()]
        held = held.join(small_frame(cells.sparkSession, rows, f"{margin} string, share double"), margin, "left")
        others = held.agg(F.sum(F.when(F.col("share").isNull(), F.col("held")))).first()[0] or 0
        rest = F.col("held") * F.lit(max(0.0, 1 - given) / max(others, 1))
        power = F.when(F.col("held") > 0, F.coalesce("share", rest)).otherwise(0.0)
    else:
        power = F.when(F.col("held") > 0, F.pow(F.col("held").cast("double"), F.lit(float(target)))).otherwise(0.0)
    total = held.agg(F.sum(power)).first()[0] or 1.0
    return held.select(margin, (power * F.lit(float(whole)) / F.lit(total)))


def rake(cells: DataFrame, margins: list[str], scratch: Scratch, sweeps: int = SWEEPS,
         trim: float | None = None, strict: bool = False) -> DataFrame:
    """Adds ``weight`` to cells (margin values m0.., tokens, targets t0..): tokens raked to the targets.

    Each step scales the cells of one margin's value to that value's target;
    a sweep does so for every margin. Steps are not clamped, so rare values
    reach their targets too; with ``trim`` the fitted weights are cut once, at
    the end, to within ``trim`` times, and one part in ``trim`` of, a cell's
    tokens. Cells without tokens keep weight 0. Where the targets contradict
    each other the fit ends after ``sweeps``, near the closest mix, with a
    warning; with ``strict`` it raises ValueError instead.
    """
    state = cells.withColumn("weight", F.col("tokens").cast("double"))
    for done in range(0, sweeps, BLOCK):
        for _ in range(BLOCK):
            for i in range(len(margins)):
                held = F.sum("weight").over(Window.partitionBy(f"m{i}"))
                scaled = F.when(held > 0, F.col("weight") * F.col(f"t{i}") / held).otherwise(F.col("weight"))
                state = state.withColumn("weight", scaled)
        new = scratch.write(state, f"sweep{done}")
        if done:
            scratch.drop(state)
        state = new
        error = None
        for i in range(len(margins)):
            one = state.groupBy(f"m{i}").agg(F.sum("weight").alias("w"), F.max(f"t{i}").alias("t")).where("t > 0").agg(
                F.max(F.abs(F.col("w") / F.col("t") - 1)).alias("e"))
            error = one if error is None else error.unionByName(one)
        left = error.agg(F.max("e")).first()[0] or 0
        if left < CLOSE:
            break
    else:
        open_fit = f"raking ended after {sweeps} sweeps with a margin {left:.2g} of its target away"
        if strict:
            raise ValueError(open_fit)
        warnings.warn(open_fit, stacklevel=2)
    if trim is not None:
        state = state.withColumn("weight", F.least(F.greatest("weight", F.col("tokens") / trim), F.col("tokens") * trim))
    return state


def mix(df: DataFrame, margins: Mapping[str, Target], tokens: Column, doc_id: str = "doc_id", sweeps: int = SWEEPS,
        trim: float | None = None, seed: int = 0, name: str = "mixing",
        content: Column | None = None, strict: bool = False) -> tuple[DataFrame, dict[str, str]]:
    """Adds tokens, weight, probability, sampled and shares to every row; returns the names of the new columns.

    ``margins`` gives for each column its target. A mapping gives shares by
    value (as text; None for null): values it does not list divide what is left
    of 1 in proportion to their tokens, so shares that add up to 1 leave them
    out; a listed value that holds no tokens yields its share to the others in
    proportion. A number is an exponent: a value that holds tokens T gets a
    share in proportion to T ** exponent (1 keeps the mix, 0 makes all values
    equal). With ``strict`` targets that contradict each other raise. The tokens of all cells of the margins are
    raked to these targets; ``weight`` is a cell's calibrated tokens over its
    tokens. The largest weight is sampled with probability 1, the others in
    proportion, so the expected sample has the target margins. ``shares`` tells
    for each margin the target share of the row's value and the share that the
    weights give it; they differ where the targets cannot be met. Rows are drawn
    by a hash of seed, id, content (a hash of the text; ``text``'s own where
    there is such a column), values and the row's number among the rows equal
    in these, however the input is split: the same in every run.

    Only the table of cells (combinations of values) is fitted; rows meet it
    in one join that Spark broadcasts where the cells are small. Nulls are a
    value of their own. Rows without tokens follow their cell; a cell without
    tokens has weight 1. Rows with a null id and rows that repeat an id
    have draws of their own. An empty table gives no rows.
    """
    scratch = Scratch(df.sparkSession, name)
    columns = list(margins)
    new = ("tokens", "weight", "probability", "sampled", "shares")
    names = dict(zip(new, fresh(df, *new)))
    at = [f"m{i}" for i in range(len(columns))]
    *keys, row, part = fresh(df.withColumns({n: F.lit(0) for n in names.values()}), *at, "row", "part")
    if content is None:
        content = text_hash("text") if "text" in df.columns else F.lit(0)
    rows = df.withColumns({names["tokens"]: F.coalesce(tokens.cast("long"), F.lit(0)), part: F.spark_partition_id(),
                           row: F.xxhash64(F.col(doc_id).isNull(), F.col(doc_id), content, *[_value(c) for c in columns]),
                           **{k: _value(c) for c, k in zip(columns, keys)}})
    rows = scratch.write(rows, "rows")              # stored, so that a row's part is the same for all readers
    counted = rows.select(*[F.col(k).alias(m) for k, m in zip(keys, at)], F.col(names["tokens"]).alias("tokens"))
    cells = scratch.write(counted.groupBy(*at).agg(F.sum("tokens").cast("long").alias("tokens")), "cells")
    whole = cells.agg(F.sum("tokens")).first()[0] or 0
    for i, c in enumerate(columns):
        cells = cells.join(_targets(cells, at[i], margins[c], whole).toDF(at[i], f"t{i}"), at[i])
    cells = scratch.write(cells, "targets")
    raked = rake(cells, columns, scratch, sweeps, trim, strict)
    weight = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(F.lit(1.0))
    fitted = raked.agg(F.sum("weight")).first()[0] or 1.0
    shares = F.array(*[F.struct(
        F.lit(c).alias("margin"), (F.col(f"t{i}") / F.lit(float(whole or 1))).alias("target"),
        (F.sum("weight").over(Window.partitionBy(at[i])) / F.lit(float(fitted))).alias("achieved"))
        for i, c in enumerate(columns)])
    raked = scratch.write(raked.select(*at, weight.alias("weight"), shares.alias("shares")), "weights")
    top = raked.agg(F.max("weight")).first()[0] or 1.0

    found = raked.select(*[F.col(a).alias(k) for a, k in zip(at, keys)], F.col("weight").alias(names["weight"]),
                         (F.col("weight") / F.lit(top)).alias(names["probability"]),
                         F.col("shares").alias(names["shares"]))
    # equal rows are numbered in each input part; the rows of earlier parts come before
    number, before = fresh(rows, "number", "before")
    earlier = Window.partitionBy(row).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (rows.groupBy(row, part).agg(F.count("*").alias("n")).withColumn(before, F.sum("n").over(earlier))
               .where(F.col(before) > 0).select(row, part, before))
    offsets = scratch.write(offsets, "offsets")
    rows = rows.withColumn(number, F.row_number().over(Window.partitionBy(row, part).orderBy(row))).join(
        offsets, [row, part], "left")
    place = F.col(number) + F.coalesce(F.col(before), F.lit(0))
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(row), place), 11) / F.lit(float(1 << 53))
    rows = rows.join(found, keys).withColumn(names["sampled"], draw < F.col(names["probability"]))
    return rows.select(*[F.col(f"`{c}`") for c in df.columns], *names.values()), names


def word_count(text: str = "text") -> Column:
    """Words of a text, the tokens of a mix."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def style_topic(text: str = "text") -> Column:
    """A topic told by the form of a text: table, decorated, loud, short or prose; null texts are short."""
    t = F.coalesce(F.col(text), F.lit(""))
    size = F.greatest(F.length(t), F.lit(1))

    def share(pattern: str) -> Column:
        return F.length(F.regexp_replace(t, pattern, "")) / size
    return (F.when(size < 200, "short").when(share(r"[^|]+") > 0.02, "table")
            .when(share(r"[^#*$%&<>]+") > 0.05, "decorated").when(share(r"[^A-Z]+") > 0.4, "loud").otherwise("prose"))


def sampled_documents(df: DataFrame, margins: Mapping[str, Target], text: str = "text", **options) -> DataFrame:
    """The drawn rows of ``df``, its columns unchanged; ``topic`` among the margins means style_topic."""
    topic, = fresh(df, "topic")
    rows, names = mix(df.withColumn(topic, style_topic(text)),
                      {topic if c == "topic" else c: e for c, e in margins.items()}, word_count(text), **options)
    return rows.where(F.col(names["sampled"])).select(*[F.col(f"`{c}`") for c in df.columns])
