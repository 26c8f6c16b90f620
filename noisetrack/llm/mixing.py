"""Mixing sources to target weights by iterative proportional fitting.

Token counts of the cells (source, language, topic) are raked: expected kept tokens start at the same share of every cell
and are scaled to the targets of the three marginals in turn, a cell never beyond its tokens, until all three are met
within ``TOLERANCE`` of the budget (looked at every ten rounds) or ``ROUNDS`` rounds are done.  A cell that is full stays so and the next round takes what is missing
from the others.  A target is the flattened share of the budget, or all tokens of a value that has fewer, its rest going to
the other values.  Where no weights meet all three marginals at once (full cells may leave none), what is left is reported
as ``residual``, the largest deviation of a marginal relative to the budget.  Expected kept tokens by tokens are the
probability with which a document of the cell is kept; the draw is a hash of doc_id, so it is the same on every run.

Documents are read twice, for the cells (pre-aggregated) and for the decision; only cells, whose number does not depend
on the number of documents, are iterated over.  DataFrame operations only.

Edge cases: null text has no tokens; null source, lang or doc_id count as the empty text; repeated rows share a decision;
an empty table gives an empty result; texts without tokens belong to their cell and are drawn like its others, those of a
cell without tokens are all kept; extra columns are kept by ``sample_documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noisetrack.llm.common import stored

DIMENSIONS = ("source", "lang", "topic")
#: Exponents that flatten each marginal: 1 keeps the shares as they are, 0 makes them equal.
FLATTEN = {"source": 0.5, "lang": 0.7, "topic": 0.7}
ROUNDS, ROUNDS_A_PLAN, TOLERANCE, KEEP, CELLS_PER_TASK = 200, 10, 1e-4, 0.6, 200_000


def n_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def topic(text: Column, tokens: Column) -> Column:
    """A rule-based topic; ``sample_documents`` takes any other column instead."""
    return (
        F.when(F.contains(text, F.lit("icense")), "legal")
        .when(F.contains(text, F.lit(" | ")), "tables")
        .when(F.contains(text, F.lit("%%%")) | F.contains(text, F.lit("###")), "markup")
        .when(tokens < 50, "short")
        .when(tokens >= 800, "long")
        .otherwise("prose")
    )


def uniform(doc_id: Column) -> Column:
    """A number in [0, 1) from doc_id."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 8), 16, 10).cast("double") / 4294967296.0


def described(docs: DataFrame) -> DataFrame:
    """_row with all columns, _id, _tokens and the three dimensions as _source, _lang and _topic."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("doc_id").alias("_id"), text.alias("_text"), n_tokens(text).alias("_tokens"), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"_{c}") for c in ("source", "lang")])
    return rows.withColumn("_topic", topic(F.col("_text"), F.col("_tokens"))).drop("_text")


def targets(cells: DataFrame, dim: str, flatten: float, keep: float) -> DataFrame:
    """(dim, target): each value's flattened share of the budget, ``keep`` of all tokens, but not more than its tokens.

    min(tokens, level * share) has to add up to the budget.  Values are filled up in the order of tokens by share; before
    the first one that the level leaves unfilled, the level is what is left of the budget by what is left of the shares."""
    values = cells.groupBy(dim).agg(F.sum("tokens").alias("t")).withColumn("share", F.pow("t", F.lit(flatten)))
    order = Window.orderBy((F.col("t") / F.col("share")), dim)
    before, rest, all_ = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.currentRow, Window.unboundedFollowing), Window.partitionBy(F.lit(1))
    level = F.greatest(F.lit(0.0), F.lit(keep) * F.sum("t").over(all_) - F.coalesce(F.sum("t").over(before), F.lit(0.0))) / F.sum("share").over(rest)
    some = values.where("t > 0").withColumn("level", level)
    fits = F.when(F.col("level") * F.col("share") <= F.col("t"), F.col("level"))
    return some.withColumn("level", F.max(fits).over(all_)).select(dim, F.least("t", F.coalesce(F.col("level") * F.col("share"), F.col("t"))).alias(f"target_{dim}"))


def residual(raked: DataFrame) -> DataFrame:
    """One row: the largest deviation of any marginal from its target, relative to the budget."""
    gaps = [F.abs(F.sum("weight").over(Window.partitionBy(d)) - F.col(f"target_{d}")).alias(d) for d in DIMENSIONS]
    budget = F.sum("weight")
    rows = raked.select("weight", *gaps)
    return rows.agg(F.coalesce(F.try_divide(F.greatest(*[F.max(d) for d in DIMENSIONS]), budget), F.lit(0.0)).alias("residual"))


def rake(cells: DataFrame, flatten: dict[str, float] = FLATTEN, keep: float = KEEP, rounds: int = ROUNDS, tolerance: float = TOLERANCE, parts: int = 1) -> DataFrame:
    """Adds ``weight`` (expected kept tokens) and a target for each dimension to the cells (one row per source, lang, topic
    with ``tokens``), which lie in ``parts`` partitions.  In one partition a round is three windows and no shuffle."""
    out = cells.coalesce(parts).withColumn("weight", F.col("tokens") * keep)
    for dim in DIMENSIONS:
        # As many rows as cells at most, which ``decide`` bounds for a broadcast.
        side = targets(cells, dim, flatten[dim], keep)
        out = out.join(F.broadcast(side) if parts == 1 else side, dim, "left").withColumn(f"target_{dim}", F.coalesce(f"target_{dim}", F.lit(0.0)))
    out = stored(out, "mixing-start").coalesce(parts)
    for done in range(0, rounds, ROUNDS_A_PLAN):
        for _ in range(min(ROUNDS_A_PLAN, rounds - done)):
            for dim in DIMENSIONS:
                now = F.sum("weight").over(Window.partitionBy(dim))
                out = out.withColumn("weight", F.when(now > 0, F.least(F.col("tokens"), F.col("weight") * F.col(f"target_{dim}") / now)).otherwise(0.0))
        out = stored(out, "mixing-round").coalesce(parts)
        if residual(out).first()[0] <= tolerance:
            break
    return out


def keep_probabilities(raked: DataFrame, keep: float = KEEP) -> DataFrame:
    """Adds ``keep_prob``, ``ratio`` (by the plain share) and ``residual`` to raked cells."""
    prob = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(F.lit(1.0))
    return raked.withColumn("keep_prob", prob).withColumn("ratio", F.col("keep_prob") / keep).join(F.broadcast(residual(raked)))  # one row


def decide(docs: DataFrame, flatten: dict[str, float] = FLATTEN, keep: float = KEEP) -> DataFrame:
    """_row, _id, _tokens, _topic of each row with ratio, keep_prob, residual and kept."""
    rows = described(docs)
    cells = rows.groupBy(*[F.col(f"_{d}").alias(d) for d in DIMENSIONS]).agg(F.sum("_tokens").cast("double").alias("tokens"))
    cells = stored(cells, "mixing-cells")
    # Cells don't grow with the documents; in one partition (200,000 cells) no round needs a shuffle.
    n_cells = cells.count()
    parts = max(1, -(-n_cells // CELLS_PER_TASK))
    cells = keep_probabilities(rake(cells, flatten, keep, parts=parts), keep).select(*[F.col(d).alias(f"_{d}") for d in DIMENSIONS], "ratio", "keep_prob", "residual")
    # So many cells are some 20 MB; more are joined by a shuffle.
    side = F.broadcast(cells) if n_cells <= CELLS_PER_TASK else cells
    return rows.join(side, [f"_{d}" for d in DIMENSIONS]).withColumn("kept", uniform(F.col("_id")) < F.col("keep_prob"))


def sample_documents(docs: DataFrame, flatten: dict[str, float] = FLATTEN, keep: float = KEEP) -> DataFrame:
    """The rows of ``docs`` that are drawn, with all their columns."""
    return decide(docs, flatten, keep).where("kept").select(*[F.col("_row")[c].alias(c) for c in docs.columns])


def oracle(flatten: dict[str, float] = FLATTEN, keep: float = KEEP, source: str = "documents") -> str:
    """The same in DuckDB's SQL."""
    cte = [
        f"d AS MATERIALIZED (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang, coalesce(text, '') AS t, CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\v\\f\\r]+')) AS BIGINT) AS n_tokens FROM {source})",
        "e AS MATERIALIZED (SELECT doc_id, source, lang, n_tokens, CASE WHEN contains(t, 'icense') THEN 'legal' WHEN contains(t, ' | ') THEN 'tables' WHEN contains(t, '%%%') OR contains(t, '###') THEN 'markup' WHEN n_tokens < 50 THEN 'short' WHEN n_tokens >= 800 THEN 'long' ELSE 'prose' END AS topic FROM d)",
        "c AS MATERIALIZED (SELECT source, lang, topic, CAST(sum(n_tokens) AS DOUBLE) AS tokens FROM e GROUP BY ALL)",
    ]
    for d in DIMENSIONS:
        cte.append(
            f"l_{d} AS MATERIALIZED (SELECT {d}, t, share, greatest(0.0, {keep} * sum(t) OVER () - coalesce(sum(t) OVER (ORDER BY t / share, {d} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) / sum(share) OVER (ORDER BY t / share, {d} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level"
            f" FROM (SELECT {d}, sum(tokens) AS t, pow(sum(tokens), {flatten[d]}) AS share FROM c GROUP BY {d}) WHERE t > 0)"
        )
        cte.append(f"t_{d} AS MATERIALIZED (SELECT {d}, least(t, coalesce(max(CASE WHEN level * share <= t THEN level END) OVER () * share, t)) AS target_{d} FROM l_{d})")
    names = "source, lang, topic, tokens, " + ", ".join(f"target_{d}" for d in DIMENSIONS)
    step = f"(SELECT * FROM w WHERE k < {ROUNDS} AND NOT (k % {ROUNDS_A_PLAN} = 0 AND residual <= {TOLERANCE}))"
    for d in DIMENSIONS:
        step = f"(SELECT k, {names}, CASE WHEN s > 0 THEN least(tokens, weight * target_{d} / s) ELSE 0.0 END AS weight FROM (SELECT k, {names}, weight, sum(weight) OVER (PARTITION BY {d}) AS s FROM {step}))"
    first = f"SELECT 0 AS k, c.source, c.lang, c.topic, tokens, {', '.join(f'coalesce(target_{d}, 0.0) AS target_{d}' for d in DIMENSIONS)}, tokens * {keep} AS weight, 1e0 AS residual FROM c {' '.join(f'LEFT JOIN t_{d} ON t_{d}.{d} = c.{d}' for d in DIMENSIONS)}"
    gaps = ", ".join(f"abs(sum(weight) OVER (PARTITION BY {d}) - target_{d}) AS g_{d}" for d in DIMENSIONS)
    worst = f"greatest({', '.join(f'g_{d}' for d in DIMENSIONS)})"
    cte.append(f"w AS ({first} UNION ALL SELECT k + 1, {names}, weight, max({worst}) OVER () / sum(weight) OVER () FROM (SELECT *, {gaps} FROM {step}))")
    cte.append("r AS MATERIALIZED (SELECT * FROM w WHERE k = (SELECT max(k) FROM w))")
    cte.append("p AS (SELECT *, CASE WHEN tokens > 0 THEN weight / tokens ELSE 1.0 END AS keep_prob FROM r)")
    return (
        "WITH RECURSIVE " + ",\n".join(cte) + f"\nSELECT e.doc_id, e.n_tokens, e.topic, round(p.keep_prob / {keep}, 6) AS ratio, round(p.keep_prob, 6) AS keep_prob, round(coalesce(p.residual, 0.0), 6) AS residual,"
        " CAST('0x' || substr(md5(coalesce(CAST(e.doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) / 4294967296.0 < p.keep_prob AS kept"
        " FROM e JOIN p ON e.source = p.source AND e.lang = p.lang AND e.topic = p.topic"
    )
