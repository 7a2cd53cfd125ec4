"""Mixing sources to target weights by iterative proportional fitting.

The corpus is folded to its cells (source, language, topic). Each margin's targets are first made
reachable: a category with fewer tokens than its share of the budget is taken whole, and the others of
the margin take the rest of the budget in proportion to their shares, until nothing changes. Raking
then moves the cells' weights, one margin after the other, until the tokens expected of every
source, language and topic are its target; a cell's inclusion probability is its
weight, 1 at most. Targets of two margins that exclude each other (a source that holds more of a
category taken whole than its own target) are met as far as they can be. Documents are sampled by
their cell's probability with a number drawn from a hash of their id. Only built-in expressions run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltline.llm.common import WORD, Workspace, fresh, quoted, table

MARGINS = ("source", "lang", "topic")
SMOOTHING = 0.8  # a target share is the observed share to this power, normalised
BUDGET = 0.8  # tokens to keep, as a share of all
SWEEPS = 12
SEED = "mix-1"
WHOLE = 1e12  # weight of a category that is taken whole: it outweighs what the other margins do

# Topics by marker, the first that a text shows; the rest by length in words.
TOPICS = (
    ("legal", r"(?i)licensed under|all rights reserved|copyright"),
    ("table", r" \| [^|\n]* \| "),
    ("contact", r"[0-9A-Za-z]@[0-9A-Za-z]"),
)
LENGTHS = (("note", 60), ("article", 1000))


def n_tokens(text: Column) -> Column:
    """Words, as a stand-in for tokens where no token counts are given."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def topic_of(text: Column, words: Column) -> Column:
    found = F.when(F.lit(False), "")
    for name, pattern in TOPICS:
        found = found.when(F.coalesce(text, F.lit("")).rlike(pattern), name)
    for name, most in LENGTHS:
        found = found.when(words < most, name)
    return found.otherwise("book")


def reachable(shares: DataFrame, goal: float) -> DataFrame:
    """``shares`` (``held`` tokens and ``share``) with ``goal`` tokens, and ``whole`` where all are taken.

    Goals are ``held`` at most. What a category lacks goes to the others by share, round by round until no
    further one is capped; the driver sees three numbers a round.
    """
    scale, before = 0.0, -1
    while True:
        capped = F.col("share") * scale >= F.col("held")
        row = shares.agg(
            F.count_if(capped).alias("n"),
            F.coalesce(F.sum(F.when(capped, F.col("held"))), F.lit(0.0)).alias("taken"),
            F.coalesce(F.sum(F.when(~capped, F.col("share"))), F.lit(0.0)).alias("share"),
        ).first()
        if row.n == before:
            break
        before = row.n
        if row.share > 0:
            scale = max(scale, (goal - row.taken) / row.share)
    whole = (F.col("share") > 0) & capped
    return shares.withColumn("whole", whole).withColumn("goal", F.when(whole, F.col("held")).otherwise(F.col("share") * scale))


def rake(cells: DataFrame, keep: Workspace, margins: tuple[str, ...] = MARGINS, targets: dict[str, dict[str, float]] | None = None,
         budget: float = BUDGET, sweeps: int = SWEEPS) -> DataFrame:
    """``cells`` (margins and ``tokens``) with ``probability``.

    ``targets`` names shares per margin (categories not named get none of it); a margin without
    targets takes its observed shares to the power ``SMOOTHING``. Null is a category like others.
    A step sums the cells by category, folded before the shuffle, and joins the sums back. Each is stored:
    it reads the one before twice, so a plan over a sweep would hold the first step's joins four times,
    and the driver a thread and its memory for each of their exchanges.
    """
    total = cells.agg(F.sum("tokens").cast("double")).first()[0] or 0.0
    state = cells.withColumn("w", F.lit(float(budget)))
    for m in margins:
        observed = cells.groupBy(F.col(m).alias("of")).agg(F.sum("tokens").cast("double").alias("held"))
        if targets and m in targets:
            listed = F.create_map(*[x for k, v in targets[m].items() for x in (F.lit(k), F.lit(float(v)))])
            share = F.coalesce(F.element_at(listed, F.coalesce(F.col("of").cast("string"), F.lit(""))), F.lit(0.0))
        else:
            share = F.pow(F.col("held") / max(total, 1.0), F.lit(SMOOTHING))
        shares = keep.keep(observed.withColumn("share", share), f"shares-{m}")
        goals = reachable(shares, budget * total).select("of", F.col("goal").alias(f"goal_{m}"), F.col("whole").alias(f"whole_{m}"))
        state = state.join(goals, F.col(m).eqNullSafe(F.col("of"))).drop("of")
        state = state.withColumn("w", F.when(F.col(f"whole_{m}"), F.col("w") * WHOLE).otherwise(F.col("w")))
    state, step = keep.keep(state, "cells-0"), 0
    for m in margins * sweeps:
        sums = state.groupBy(F.col(m).alias("of")).agg(F.sum(F.col("tokens") * F.least(F.lit(1.0), "w")).alias("got"))
        summed = state.join(sums, F.col(m).eqNullSafe(F.col("of")))
        moved = F.when(~F.col(f"whole_{m}") & (F.col("got") > 0), F.col("w") * F.col(f"goal_{m}") / F.col("got"))
        step += 1
        state = keep.keep(summed.withColumn("w", moved.otherwise(F.col("w"))).drop("of", "got"), f"cells-{step}")
        keep.drop(f"cells-{step - 1}")
    return state.select(*margins, "tokens", F.round(F.least(F.lit(1.0), "w"), 6).alias("probability"))


def draw(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that the document's id and the seed fix; rows without id use their text."""
    name = F.coalesce(doc_id.cast("string"), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), name).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(1 << 32)


def described(docs: DataFrame, seed: str = SEED, names: dict[str, str] | None = None) -> DataFrame:
    """``docs`` with columns for tokens, topic and drawn number (``names`` tells what they are called)."""
    taken, called = list(docs.columns), names if names is not None else {}
    for c in ("n_tokens", "topic", "drawn"):
        called[c] = fresh(taken, c)
        taken.append(called[c])
    text = F.col("text")
    counted = docs.withColumn(called["n_tokens"], n_tokens(text)).withColumn(called["topic"], topic_of(text, quoted(called["n_tokens"])))
    return counted.withColumn(called["drawn"], draw(F.col("doc_id"), text, seed))


def weigh(rows: DataFrame, names: dict[str, str], place: Workspace, targets: dict[str, dict[str, float]] | None = None, budget: float = BUDGET) -> DataFrame:
    """Rows that ``described`` made, stored, with their cell's probability and verdict (called as ``names`` then tells)."""
    taken = list(rows.columns)
    for c in ("probability", "kept"):
        names[c] = fresh(taken, c)
        taken.append(names[c])
    keys = {"source": F.col("source"), "lang": F.col("lang"), "topic": quoted(names["topic"])}
    cells = place.keep(
        rows.select(*[k.alias(n) for n, k in keys.items()], quoted(names["n_tokens"]).alias("tokens"))
        .groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens")),
        "cells",
    )
    of = {m: fresh(taken, f"cell_{m}") for m in MARGINS}
    raked = rake(cells, place, targets=targets, budget=budget)
    raked = place.keep(raked.select(*[F.col(m).alias(of[m]) for m in MARGINS], F.col("probability").alias(names["probability"])), "raked")
    on = [keys[m].eqNullSafe(quoted(of[m])) for m in MARGINS]
    joined = rows.join(raked, on[0] & on[1] & on[2]).drop(*of.values())
    return joined.withColumn(names["kept"], quoted(names["drawn"]) < quoted(names["probability"])).drop(names["drawn"])


def mix(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, budget: float = BUDGET, seed: str = SEED,
        names: dict[str, str] | None = None) -> DataFrame:
    """``docs`` with columns for tokens, topic, probability and verdict (``names`` tells what they are called).

    Null sources and languages are categories; null and empty texts have no tokens and are kept with
    their cell's probability; equal rows are drawn alike; an empty table gives no rows. The rows are
    stored once with their tokens and topic, so texts are searched in one pass.
    """
    called = names if names is not None else {}
    place = Workspace(docs.sparkSession, "mixing")
    return weigh(place.keep(described(docs, seed, called), "rows"), called, place, targets, budget)


def sample_mixture(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, budget: float = BUDGET, seed: str = SEED) -> DataFrame:
    """The rows of ``docs``, with their columns, that the mixture takes."""
    names: dict[str, str] = {}
    found = mix(docs, targets, budget, seed, names)
    return found.where(quoted(names["kept"])).drop(*names.values())


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's cell, probability and verdict; nulls, empty texts and repeats as in ``mix``."""
    names: dict[str, str] = {}
    place = Workspace(spark, "mixing")
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    rows = place.keep(described(docs, names=names).drop("text"), "rows")
    return weigh(rows, names, place).select("doc_id", "source", "lang", "topic", "n_tokens", "probability", "kept")


def mixing_sql(documents: str = "documents") -> str:
    """The same in SQL, one expression per margin and sweep."""
    cases = " ".join(f"WHEN regexp_matches(coalesce(text, ''), '{p}') THEN '{n}'" for n, p in TOPICS)
    cases += "".join(f" WHEN n_tokens < {most} THEN '{n}'" for n, most in LENGTHS)
    parts = [
        rf"t0 AS (SELECT *, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n_tokens FROM {documents})",
        f"t AS (SELECT *, CASE {cases} ELSE 'book' END AS topic FROM t0)",
        "c AS (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens FROM t GROUP BY ALL)",
    ]
    for m in MARGINS:
        parts += [
            f"s_{m} AS (SELECT {m} AS k, sum(tokens) AS held, pow(sum(tokens) / greatest((SELECT sum(tokens) FROM c), 1), {SMOOTHING}) AS share FROM c GROUP BY {m})",
            # Categories by how early a growing scale takes them whole; the scale that spends the budget once those before are.
            f"o_{m} AS (SELECT *, held / share AS full_at, ({BUDGET} * (SELECT sum(tokens) FROM c) - sum(held) OVER w + held) / (sum(share) OVER () - sum(share) OVER w + share) AS scale"
            f" FROM s_{m} WHERE share > 0 WINDOW w AS (ORDER BY held / share, k NULLS FIRST))",
            f"l_{m} AS (SELECT arg_min(scale, full_at) FILTER (scale < full_at) AS scale FROM o_{m})",
            f"g_{m} AS (SELECT k, coalesce(share > 0 AND share * (SELECT scale FROM l_{m}) >= held, share > 0) AS whole_{m},"
            f" coalesce(least(held, share * (SELECT scale FROM l_{m})), held) AS goal_{m} FROM s_{m})",
        ]
    joins = " ".join(f"JOIN g_{m} ON c.{m} IS NOT DISTINCT FROM g_{m}.k" for m in MARGINS)
    columns = ", ".join(f"c.{m}, goal_{m}, whole_{m}" for m in MARGINS)
    start = " * ".join(f"CASE WHEN whole_{m} THEN {WHOLE:.1f} ELSE 1.0::DOUBLE END" for m in MARGINS)
    parts.append(f"r0 AS (SELECT {columns}, tokens, {BUDGET}::DOUBLE * {start} AS p FROM c {joins})")
    n = 0
    for _ in range(SWEEPS):
        for m in MARGINS:
            got = f"sum(tokens * least(1.0, p)) OVER (PARTITION BY {m})"
            # Each step is computed once and kept, or the steps before would be unfolded again and again.
            parts.append(f"r{n + 1} AS MATERIALIZED (SELECT * REPLACE (CASE WHEN NOT whole_{m} AND {got} > 0 THEN p * goal_{m} / {got} ELSE p END AS p) FROM r{n})")
            n += 1
    name = "coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))"
    return (
        "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, t.source, t.lang, t.topic, n_tokens, round(least(1.0, p), 6) AS probability,
  (('0x' || substr(md5('{SEED}:' || {name}), 1, 8))::BIGINT / 4294967296.0) < round(least(1.0, p), 6) AS kept
FROM t JOIN r{n} AS r ON t.source IS NOT DISTINCT FROM r.source AND t.lang IS NOT DISTINCT FROM r.lang AND t.topic = r.topic"""
    )


OP2_SQL = mixing_sql()
