"""Mixing sources to target weights by iterative proportional fitting.

Documents are summed to cells (source, language, topic); the cells' token weights are raked in turn
to the target marginals; a document is sampled with the probability its cell then has.  Documents are
only ever aggregated.  The cells, one row per combination, are raked in one task up to ``TASK_CELLS`` of
them; more are raked by DataFrame sweeps that aggregate them per dimension, with map-side partial sums,
and join the factors back, one written table per dimension and sweep.  Both do the same arithmetic.
"""

from __future__ import annotations

import logging
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mqtable.llm.common import hash128, materialize
from mqtable.session import workers_import_package

log = logging.getLogger(__name__)
DIMENSIONS = ("source", "lang", "topic")
#: The largest relative error of a marginal at which raking stops, and the share of it that a sweep
#: must move of all weight; below, full cells hold what error is left.
TOLERANCE, STILL = 1e-3, 1e-3
#: Up to so many cells are raked in one task; more are written once per dimension and sweep.
TASK_CELLS = 1 << 16


def tokens_of(text: Column) -> Column:
    """Words between ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def topic_of(text: Column) -> Column:
    """A coarse topic by layout: ``table`` (bars), ``data`` (digits), ``legal``, ``web`` (addresses), ``prose``."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    size = F.greatest(F.lit(1), F.char_length(t))
    bars = F.octet_length(t) - F.octet_length(F.replace(t, F.lit("|"), F.lit("")))
    lower = F.lower(t)
    return (
        F.when(bars * 50 >= size, "table")
        .when(F.regexp_count(t, F.lit("[0-9]")) * 20 >= size, "data")
        .when(lower.contains("license") | lower.contains("copyright") | lower.contains("rights reserved"), "legal")
        .when(lower.contains("http://") | lower.contains("https://") | lower.contains("@"), "web")
        .otherwise("prose")
    )


def flattened(cells: DataFrame, dimension: str, power: float) -> DataFrame:
    """Target shares of a dimension in proportion to its tokens to a power; below 1 favours small values."""
    sums = cells.groupBy(dimension).agg(F.pow(F.sum("tokens").cast("double"), F.lit(power)).alias("raw"))
    total = sums.agg(F.sum("raw").alias("all_raw"))
    return sums.join(F.broadcast(total)).select(dimension, (F.col("raw") / F.col("all_raw")).alias("share"))  # one row


def _goals(cells: DataFrame, dimension: str, shares: DataFrame, budget: float) -> DataFrame:
    """``dimension, want``: ``least(tokens, scale * share)`` with the scale at which they sum to ``budget``.

    The scale rises while values without enough tokens leave more to the others; every step is a sum
    over the values, and at least one more value is full after each, usually many.
    """
    there = cells.groupBy(dimension).agg(F.sum("tokens").cast("double").alias("there"))
    values = materialize(there.join(shares, dimension).where("share > 0 and there > 0"), "mix-targets")
    scale = 0.0
    while True:
        full = F.col("there") <= F.col("share") * scale
        taken, open_share = values.agg(F.sum(F.when(full, F.col("there"))), F.sum(F.when(~full, F.col("share")))).first()
        raised = (budget - (taken or 0.0)) / open_share if open_share else scale
        if raised <= scale * (1 + 1e-12):
            break
        scale = raised
    return values.select(dimension, F.least("there", F.col("share") * scale).alias("want"))


def _in_task(dimensions: list[str], sweeps: int | None, tolerance: float):
    """Rakes a whole table of ``tokens``, dimensions and their ``want_`` columns; adds ``weight, error``."""

    def run(table):
        import pyarrow as pa

        tokens = table.column("tokens").to_numpy().astype(float)
        values = []
        for d in dimensions:
            coded = table.column(d).combine_chunks().dictionary_encode()
            code = coded.indices.to_numpy()
            want = np.zeros(len(coded.dictionary))
            want[code] = table.column(f"want_{d}").to_numpy()
            values.append((code, want))

        def have(code: np.ndarray, want: np.ndarray) -> np.ndarray:
            return np.bincount(code, weight, len(want))

        def ratio(above: np.ndarray, below: np.ndarray) -> np.ndarray:
            return np.divide(above, below, out=np.zeros(len(below)), where=below > 0)

        def error() -> float:
            return max(ratio(np.abs(have(*v) - v[1]), v[1]).max(initial=0.0) for v in values)

        weight, done = tokens.copy(), 0
        while sweeps is None or done < sweeps:
            before, done = weight, done + 1
            for code, want in values:
                weight = np.minimum(tokens, weight * ratio(want, have(code, want))[code])
            if error() <= tolerance or np.abs(weight - before).sum() <= STILL * tolerance * weight.sum():
                break
        out = {"weight": pa.array(weight), "error": pa.array(np.full(len(weight), error()))}
        return pa.table({**{c: table.column(c) for c in (*dimensions, "tokens")}, **out})

    return run


def rake(
    cells: DataFrame, targets: dict[str, DataFrame], budget: float, sweeps: int | None = None,
    tolerance: float = TOLERANCE, task_cells: int = TASK_CELLS,
) -> DataFrame:
    """``cells`` with ``weight``: tokens to take, whose sums meet ``budget`` times each target share.

    A cell never gives more than its tokens, so ``weight <= tokens``.  What a value lacks is spread over
    the others by their shares; values without a target give nothing.  Sweeps end when every
    marginal is within ``tolerance`` of its goal, or when they move no weight any more, because full
    cells hold the rest; ``sweeps`` may limit them.  ``error`` is the largest relative error left.
    """
    now = materialize(cells.where("tokens > 0").withColumn("weight", F.col("tokens") * 1.0), "mix-cells")
    goals = {d: _goals(now, d, target, budget) for d, target in targets.items()}
    for d, goal in goals.items():
        now = now.join(goal.withColumnRenamed("want", f"want_{d}"), d, "left").na.fill(0.0, [f"want_{d}"])
    now = materialize(now, "mix-goals")
    n = now.count()
    if n <= task_cells:
        workers_import_package(now.sparkSession)
        given = [f for f in now.schema.fields if f.name in (*goals, "tokens")]
        order = {f.name: f.dataType.simpleString() for f in given}
        schema = ", ".join(f"{c} {order[c]}" for c in (*goals, "tokens")) + ", weight double, error double"
        raked = now.groupBy().applyInArrow(_in_task(list(goals), sweeps, tolerance), schema)
        return materialize(raked, "mix-raked")

    done, error = 0, 0.0
    while sweeps is None or done < sweeps:
        now, done = now.withColumn("before", F.col("weight")), done + 1
        for d in goals:
            have = now.groupBy(d).agg(F.sum("weight").alias("have"))
            factor = F.coalesce(F.col(f"want_{d}") / F.when(F.col("have") > 0, F.col("have")), F.lit(0.0))
            # written after each dimension: the next would compute this join for its sums and again for its rows
            now = materialize(
                now.join(have, d).withColumn("weight", F.least(F.col("tokens") * 1.0, F.col("weight") * factor)).drop("have"),
                "mix-sweep",
            )
        off = [
            now.groupBy(d).agg(F.sum("weight").alias("have"), F.first(f"want_{d}").alias("want"))
            .select(F.when(F.col("want") > 0, F.abs(F.col("have") - F.col("want")) / F.col("want")).alias("off"))
            for d in goals
        ]
        moved = now.agg(F.sum(F.abs(F.col("weight") - F.col("before"))).alias("moved"), F.sum("weight").alias("all"))
        error, moved, total = reduce(DataFrame.unionByName, off).agg(F.max("off").alias("off")).join(moved).first()
        error, now = error or 0.0, now.drop("before")
        if error <= tolerance or moved <= STILL * tolerance * total:
            break
    return now.select(*goals, "tokens", "weight", F.lit(error).alias("error"))


def mix(
    docs: DataFrame,
    keep: float = 0.8,
    power: float = 0.8,
    targets: dict[str, DataFrame] | None = None,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    lang_col: str = "lang",
    topic: Column | None = None,
    hashes: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, source, lang, topic, tokens, probability, selected``;
    with ``hashes`` also ``h1, h2`` of the text.

    ``keep`` of all tokens are to be taken.  ``targets`` gives shares ``(dimension, share)`` for
    ``source``, ``lang`` and ``topic``; by default each value's tokens to ``power``, normalised.  The
    probability is the cell's raked weight over its tokens; a row is selected where a hash of its id
    and ``seed`` falls below it, so repeated rows are taken or left together.  Null and empty labels
    count as the value ``''``; null or wordless text has no tokens and the probability ``keep``; without an
    id the text is hashed.  An empty table gives no rows.  Other columns are not read.
    """
    def label(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    text = F.col(text_col)
    key = hash128(text.cast("string"))
    drawn = F.coalesce(F.col(id_col).cast("string"), F.concat_ws(" ", F.lit("text"), *[h.cast("string") for h in key]))
    rows = materialize(
        docs.select(
            F.col(id_col).alias("doc_id"), label(source_col).alias("source"), label(lang_col).alias("lang"),
            (topic if topic is not None else topic_of(text)).alias("topic"), tokens_of(text).alias("tokens"),
            F.xxhash64(F.lit(seed), drawn).alias("hashed"), *(key if hashes else []),
        ),
        "mix-rows",
    )
    cells = materialize(rows.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")), "mix-counts")
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    wanted = {d: (targets or {}).get(d) for d in DIMENSIONS}
    wanted = {d: flattened(cells.where("tokens > 0"), d, power) if t is None else t for d, t in wanted.items()}
    raked = rake(cells, wanted, keep * total) if total else cells.withColumn("weight", F.lit(0.0)).withColumn("error", F.lit(0.0))
    left = raked.agg(F.max("error")).first()[0] or 0.0
    if left > TOLERANCE:
        log.warning("full cells leave a marginal %.2f%% off its target", 100 * left)
    chances = raked.select(*DIMENSIONS, (F.col("weight") / F.when(F.col("tokens") > 0, F.col("tokens"))).alias("chance"))
    draw = F.shiftrightunsigned("hashed", 11) / float(1 << 53)
    return (
        rows.join(materialize(chances, "mix-chances"), list(DIMENSIONS), "left")
        .withColumn("probability", F.when(F.col("tokens") == 0, F.lit(float(keep))).otherwise(F.coalesce("chance", F.lit(0.0))))
        .select("doc_id", *DIMENSIONS, "tokens", "probability", (draw < F.col("probability")).alias("selected"), *(["h1", "h2"] if hashes else []))
    )
