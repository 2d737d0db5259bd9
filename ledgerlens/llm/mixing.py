"""Mixing sources to target weights by capped water-filling (DataFrame functions only).

Sources share a budget by weight. A source's target stops at ``max_epochs``
times its size; the excess goes to the others by weight until none is above
its cap. Clamping sources in ascending order of cap / weight gives that level
in one pass over the table of sources (a row each; their order by name, which
fixes the weights, is the only global order).

A target of e epochs takes every document floor(e) times. The rest is filled
once more in order of a seeded hash, up to the first document that would
exceed it. A document that is too long there is passed over: ``ROUNDS`` rounds
go on from it with the documents that still fit, and one last document, the
one nearest in size to what is then missing, closes the gap. No source is
sorted: the hash at which a round stops is found from sums by hash prefix
(12 bits, then 12 more, then the few documents that are left), all
pre-aggregated, so a source with a third of all rows is no special case.

Null text has size 0; a source of size 0 has target 0 and gives nothing; a
null source is a source, last in order. Documents of equal id and text have
equal hashes and are taken or left together. Reruns agree: the hash depends
on seed, id and text only. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import free_name, stored

WEIGHTS = (5, 2, 1)
SHARE, MAX_EPOCHS, SEED = 1.5, 2, "mix-1"
WORD = r"[^\x20\x09-\x0D]+"
#: Bits of the hash, and the shifts of the two prefixes.
BITS, SHIFTS = 48, (36, 24)
ROUNDS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def seeded_hash(seed: str, id_col: str, text_col: str) -> Column:
    """48 bits of a digest of seed, id and text."""
    parts = F.concat(F.lit(seed + ":"), F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit(":"), F.coalesce(F.col(text_col), F.lit("")))
    return F.conv(F.substring(F.md5(parts.cast("binary")), 1, BITS // 4), 16, 10).cast("long")


def source_key(source_col: str) -> Column:
    """The source as a key that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("null"))


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """key, source_size, target: a row per source, by water-filling. ``sized`` has key, source, size."""
    sources = sized.groupBy("key").agg(F.min("source").alias("source"), F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    nth = F.row_number().over(by_name)
    weight = F.element_at(F.array(*map(F.lit, weights)), ((nth - 1) % len(weights) + 1).cast("int"))
    everything = Window.partitionBy(F.lit(0))
    caps = sources.withColumns({"nth": nth, "weight": weight, "cap": F.col("source_size") * max_epochs}).withColumns(
        {"budget": F.sum("source_size").over(everything) * F.lit(share), "weights": F.sum("weight").over(everything)}
    )
    clamping = Window.orderBy(F.col("cap") / F.col("weight"), "nth")
    before = clamping.rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0))
    level = left / (F.col("weights") - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    leveled = caps.withColumn("level", level).withColumn("clamped", F.col("cap") / F.col("weight") <= F.col("level"))
    water = F.first(F.when(~F.col("clamped"), F.col("level")), ignorenulls=True).over(clamping.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return leveled.select("key", "source_size", F.when(F.col("clamped"), F.col("cap").cast("double")).otherwise(water * F.col("weight")).alias("target"))


def stop_at(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """key, stop, rest: the smallest hash whose rows exceed ``need``, and what the rows below it leave open.

    ``rows`` has key, size, u (the hash); sources whose rows do not exceed their need are missing.
    """
    state, done = wanted.withColumns({"before": F.lit(0).cast("long"), "prefix": F.lit(0).cast("long")}), BITS
    for shift in SHIFTS:
        # sums by the next bits of the hash, within the prefix that the level before has found
        inside = rows.join(state.select("key", "prefix"), "key").where(F.shiftright("u", done) == F.col("prefix"))
        sums = inside.groupBy("key", F.shiftright("u", shift).alias("p")).agg(F.sum("size").alias("s"))
        run = Window.partitionBy("key").orderBy("p").rowsBetween(Window.unboundedPreceding, 0)
        reached = sums.withColumn("upto", F.sum("s").over(run)).join(state, "key").where(F.col("before") + F.col("upto") > F.col("need"))
        first = reached.groupBy("key").agg(F.min_by(F.struct("p", (F.col("before") + F.col("upto") - F.col("s")).alias("b")), "p").alias("f"))
        state = stored(state.drop("before", "prefix").join(first.select("key", F.col("f.b").alias("before"), F.col("f.p").alias("prefix")), "key"), "mix_prefixes")
        done = shift
    last = rows.join(state.select("key", "prefix"), "key").where(F.shiftright("u", done) == F.col("prefix")).groupBy("key", "u").agg(F.sum("size").alias("s"))
    run = Window.partitionBy("key").orderBy("u").rowsBetween(Window.unboundedPreceding, -1)
    upto = last.withColumn("upto", F.coalesce(F.sum("s").over(run), F.lit(0))).join(state, "key").withColumn("reached", F.col("before") + F.col("upto"))
    over = upto.where(F.col("reached") + F.col("s") > F.col("need"))
    return over.groupBy("key").agg(F.min_by(F.struct(F.col("u").alias("stop"), (F.col("need") - F.col("reached")).alias("rest")), "u").alias("o")).select("key", "o.*")


def filling() -> Column:
    """Whether a row (u, size) is taken once more by a round of its source's ``fill``."""
    return F.exists("fill", lambda f: (F.col("u") >= f["start"]) & (F.col("u") < f["stop"]) & (F.col("size") <= f["most"]))


def stops(sized: DataFrame, wanted: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Per source: whole repetitions, ``fill`` (start, stop and largest size of each round) and ``extra`` (hash of one more).

    ``sized`` has key, size, u (the hash); ``wanted`` is a table of targets.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    state = wanted.withColumn("whole", whole).withColumn("need", F.col("target") - F.col("whole") * F.col("source_size"))
    none = F.array().cast("array<struct<start:bigint,stop:bigint,most:double>>")
    state = stored(state.withColumns({"open": F.col("need"), "start": F.lit(0).cast("long"), "most": F.lit(2.0**62), "fill": none}), "mix_targets")
    for _ in range(rounds):
        fitting = sized.join(state.select("key", "start", "most"), "key").where("size > 0 and u >= start and size <= most").select("key", "size", "u")
        stop, rest = F.coalesce("stop", F.lit(1 << BITS)), F.coalesce("rest", F.lit(0.0))
        fill = F.array_append("fill", F.struct("start", stop.alias("stop"), "most")).alias("fill")
        found = state.join(stop_at(fitting, state.select("key", F.col("open").alias("need"))), "key", "left")
        state = stored(found.select("key", "source_size", "target", "whole", "need", rest.alias("open"), stop.alias("start"), rest.alias("most"), fill), "mix_rounds")
    state = state.select("key", "source_size", "target", "whole", "need", "fill")
    filled = sized.join(state.select("key", "fill"), "key").where(filling()).groupBy("key").agg(F.sum("size").alias("filled"))
    state = stored(state.join(filled, "key", "left").withColumn("rest", F.col("need") - F.coalesce("filled", F.lit(0))).drop("need", "filled"), "mix_filled")
    # of the rows left out, those that bring the source nearer to its target, by what they leave open
    gap = F.abs(F.col("size") - F.col("rest"))
    near = sized.join(state.select("key", "fill", "rest"), "key").where(~filling()).where("size > 0 and size < 2 * rest").select("key", "u", gap.alias("gap"))
    least = near.groupBy("key").agg(F.min("gap").alias("gap"))
    extra = near.join(least, ["key", "gap"]).groupBy("key").agg(F.min("u").alias("extra"))
    return stored(state.drop("rest").join(extra, "key", "left"), "mix_stops")


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED, **rule) -> tuple[DataFrame, DataFrame]:
    """Sizes and hashes of all documents (narrow), and per source its target and where to stop."""
    sized = stored(
        docs.select(
            F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), source_key(source_col).alias("key"), word_count(F.col(text_col)).alias("size"), seeded_hash(seed, id_col, text_col).alias("u")
        ),
        "mix_sizes",
    )
    return sized, stops(sized, targets(sized, **rule))


def repetitions() -> Column:
    return (F.col("whole") + F.when(filling() | (F.col("u") == F.col("extra")), 1).otherwise(0)).cast("long")


def shares(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED, **rule) -> DataFrame:
    """id, size, source_size, target (its source's), taken (words that the mix takes, repeats counted)."""
    sized, stop = plan(docs, id_col, text_col, source_col, seed, **rule)
    return sized.join(stop, "key").select(F.col("id").alias(id_col), "size", "source_size", "target", (F.col("size") * repetitions()).alias("taken"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED, **rule) -> DataFrame:
    """The mixture: each input row as often as it is taken, with its columns."""
    _, stop = plan(docs, id_col, text_col, source_col, seed, **rule)
    row = free_name(docs, "row")
    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias(row), source_key(source_col).alias("key"), word_count(F.col(text_col)).alias("size"), seeded_hash(seed, id_col, text_col).alias("u"))
    times = keyed.join(stop, "key").select(row, F.explode(F.array_repeat(F.lit(1), repetitions().cast("int"))))
    return times.select(*(F.col(row)[c].alias(c) for c in docs.columns))


def _round_sql(k: int) -> str:
    return f"""
run{k} AS (
  SELECT key, u, s, need, COALESCE(sum(s) OVER (PARTITION BY key ORDER BY u ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS upto
  FROM (SELECT key, u, any_value(need) AS need, sum(size)::BIGINT AS s FROM sized JOIN fill{k - 1} USING (key)
        WHERE size > 0 AND u >= start AND size <= most GROUP BY key, u)),
stop{k} AS (
  SELECT key, min(u) AS stop, min_by(need - upto, u) AS rest FROM run{k} WHERE upto + s > need GROUP BY key),
fill{k} AS (
  SELECT key, COALESCE(rest, 0) AS need, COALESCE(stop, {1 << BITS}) AS start, COALESCE(rest, 0) AS most FROM fill{k - 1} LEFT JOIN stop{k} USING (key)),"""


#: DuckDB SQL of ``shares`` over documents.
SHARES_SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, COALESCE('=' || source, 'null') AS key,
         COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('{SEED}:' || COALESCE(doc_id::VARCHAR, 'null') || ':' || COALESCE(text, '')), 1, {BITS // 4}))::BIGINT AS u
  FROM documents),
sources AS (
  SELECT key, min(source) AS source, sum(size)::BIGINT AS source_size FROM sized GROUP BY key),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source IS NULL, source) AS nth FROM sources),
caps AS (
  SELECT *, ([5, 2, 1])[((nth - 1) % 3 + 1)::INT] AS weight, source_size * {MAX_EPOCHS} AS cap,
         (sum(source_size) OVER ())::BIGINT * {SHARE}::DOUBLE AS budget FROM ranked),
leveled AS (
  SELECT *, (budget - COALESCE(sum(cap) OVER b, 0)::BIGINT::DOUBLE) / ((sum(weight) OVER ()) - COALESCE(sum(weight) OVER b, 0))::DOUBLE AS level
  FROM caps WINDOW b AS (ORDER BY cap::DOUBLE / weight, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
clamped AS (
  SELECT *, cap::DOUBLE / weight <= level AS clamped FROM leveled),
targets AS (
  SELECT key, source_size, CASE WHEN clamped THEN cap::DOUBLE ELSE weight * (SELECT level FROM clamped WHERE NOT clamped ORDER BY cap::DOUBLE / weight, nth LIMIT 1) END AS target
  FROM clamped),
needs AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM targets),
fill0 AS (
  SELECT key, target - whole * source_size AS need, 0::BIGINT AS start, 4611686018427387904::DOUBLE AS most FROM needs),{"".join(map(_round_sql, range(1, ROUNDS + 1)))}
filled AS (
  SELECT sized.*, {" OR ".join(f"(u >= f{k - 1}.start AND u < f{k}.start AND size <= f{k - 1}.most)" for k in range(1, ROUNDS + 1))} AS more
  FROM sized {" ".join(f"JOIN fill{k} f{k} USING (key)" for k in range(ROUNDS + 1))}),
rests AS (
  SELECT key, any_value(target - whole * source_size) - COALESCE(sum(size) FILTER (more), 0)::BIGINT AS rest FROM filled JOIN needs USING (key) GROUP BY key),
near AS (
  SELECT key, u, abs(size - rest) AS gap FROM filled JOIN rests USING (key) WHERE NOT more AND size > 0 AND size < 2 * rest),
extras AS (
  SELECT key, min(u) AS extra FROM near JOIN (SELECT key, min(gap) AS gap FROM near GROUP BY key) USING (key, gap) GROUP BY key)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN more OR u = extra THEN 1 ELSE 0 END))::BIGINT AS taken
FROM filled JOIN needs USING (key) LEFT JOIN extras USING (key)
"""
