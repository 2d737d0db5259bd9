"""Cleaning stage (C1-C12): raw feed -> cleaned sales + a cleaning report.

The reference removes rows step by step and counts each step. Here every raw
row is tagged once with the *first* step that rejects it (``drop_reason``):

    C1 duplicate order_id (keep the first by arrival order)
    C2 NULL total_amount / order_id / sale_date
    C5 sale_date outside [min_date, as_of]
    C6 total_amount <= 0
    C7 total_amount outside the IQR fences of the rows that survived C1-C6

so the per-step report (C11) is one conditional aggregate, not one job per
step, and ``rows_in = kept + sum(removed)`` holds by construction.
Step order matters (a first copy with a NULL amount removes the order
altogether), so the tags are evaluated in the reference's order.

Scale notes: C1 is a pre-aggregated first-arrival key per ``order_id``
joined back to the rows (a hot id never lands whole on one task: partial
aggregation collapses it map-side and AQE splits it in the join). The
fences (C7) are a one-row aggregate joined back as a broadcast scalar.
Everything else is narrow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens import schema as S
from ledgerlens.functions import calendar_columns, pct, revenue_band, standardise
from ledgerlens.operators.quantile import iqr_fences
from ledgerlens.sources import files

REASONS = ("duplicate", "null_critical", "invalid_date", "non_positive", "outlier")
#: The report's names.
REPORT_KEYS = {
    "duplicate": "duplicates_removed",
    "null_critical": "nulls_dropped",
    "invalid_date": "invalid_dates_removed",
    "non_positive": "negative_amounts_removed",
    "outlier": "outliers_removed",
}


def as_of_col(params: S.Params) -> Column:
    return F.lit(params.as_of) if params.as_of is not None else F.current_date()


# Rows a block of ``rejected_blocks`` stands for: words of a BIGINT's bits.
WORD_BITS, BLOCK_WORDS = 64, 8
# Most blocks that are broadcast (some 100 bytes each, 512 million rows in all).
BROADCAST_BLOCKS = 1_000_000
# Most distinct values of a text column that are broadcast with their standard form.
BROADCAST_VALUES = 100_000

_LONG_SHIFT = 2**64
_LONG_OFFSET = 2**63
_FIRST_SLOT_MAX = 5_400_000_000_000_000_000


def _as_long(df: DataFrame, c: str) -> Column | None:
    """An order-preserving BIGINT for timestamp/date/integral columns, else None."""
    t = df.schema[c].dataType
    if isinstance(t, T.TimestampType):
        return F.unix_micros(F.col(c))
    if isinstance(t, T.TimestampNTZType):
        # wall-clock micros, independent of the session time zone
        x = F.col(c)
        day = F.unix_date(x.cast("date")).cast("long") * F.lit(86_400_000_000)
        secs = (F.hour(x) * 3600 + F.minute(x) * 60).cast("long") * F.lit(1_000_000)
        frac = (F.date_part(F.lit("SECOND"), x) * 1_000_000).cast("long")
        return day + secs + frac
    if isinstance(t, T.DateType):
        return F.unix_date(F.col(c)).cast("long")
    if isinstance(t, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return F.col(c).cast("long")
    return None


def _arrival_columns(params: S.Params, df: DataFrame | None) -> tuple[str, ...]:
    """The ``dedup_order`` columns; ``row_id`` only where the feed has it."""
    return tuple(c for c in params.dedup_order if c != "row_id" or df is not None and c in df.columns)


def arrival_key(params: S.Params, df: DataFrame | None = None) -> Column:
    """Sortable arrival position (NULLs last) from the ``dedup_order`` columns.

    Two numeric/temporal columns pack into one DECIMAL(38,0) (a * 2^64 +
    b + 2^63), which hash aggregation can ``min`` in place; any other shape
    falls back to a struct (sort-based aggregation).
    """
    cols = _arrival_columns(params, df)
    if df is not None and cols == ("load_seq", "row_id") and isinstance(df.schema["load_seq"].dataType, T.LongType):
        # row numbers are not negative, so 63 bits hold them and any BIGINT fits in front of them
        big = T.DecimalType(38, 0)
        seq = F.coalesce(F.col("load_seq"), F.lit(_LONG_OFFSET - 1).cast("long")).cast(big)
        return seq * F.lit(str(_LONG_OFFSET)).cast(big) + F.col("row_id").cast(big)
    if df is not None and len(cols) <= 2:
        longs = [_as_long(df, c) for c in cols]
        # a BIGINT in the first of two slots could be too large to pack
        wide = len(cols) == 2 and isinstance(df.schema[cols[0]].dataType, T.LongType)
        if not wide and all(x is not None for x in longs):
            big = T.DecimalType(38, 0)
            # NULL sorts last: the first slot's sentinel is beyond any timestamp in
            # microseconds and small enough for a * 2^64 + b to fit 38 digits
            hi = [F.lit(_FIRST_SLOT_MAX if i == 0 and len(longs) > 1 else _LONG_OFFSET - 1).cast("long") for i in range(len(longs))]
            vals = [F.coalesce(x, h).cast(big) for x, h in zip(longs, hi)]
            if len(vals) == 1:
                return vals[0]
            return vals[0] * F.lit(str(_LONG_SHIFT)).cast(big) + (vals[1] + F.lit(str(_LONG_OFFSET)).cast(big))
    parts = []
    for c in cols:
        parts += [F.col(c).isNull().alias(f"{c}_isnull"), F.col(c).alias(c)]
    return F.struct(*parts)


def arrival_rank(params: S.Params) -> Column:
    """Position of a row among the rows sharing its order_id (1 = first arrival).

    Window form, for small inputs and tests; ``mark_first_arrival`` is the
    skew-safe form the cleaning stage uses.
    """
    w = Window.partitionBy("order_id").orderBy(*[F.col(c).asc_nulls_last() for c in _arrival_columns(params, None)])
    return F.row_number().over(w)


def mark_first_arrival(raw: DataFrame, params: S.Params) -> DataFrame:
    """Add ``_first`` = the row is the first arrival of its order_id (NULL ids form one group).

    A window partitioned by order_id would put every copy of a hot id on one
    task. Instead the first arrival key per id is an aggregate (``min``, which
    partial aggregation collapses map-side, so a hot id ships one row per map
    task), joined back null-safely; AQE's skew-join handling splits a hot id's
    rows on the large side across tasks. The ids are shuffled a second time
    for the join on purpose: AQE splits a partition only where both sides of a
    join come straight from an exchange, so an aggregate that shared the
    join's partitioning would leave a hot id's rows in one task. Only ids
    that come more than once are shuffled again; a row without a partner there
    is the only one of its id.

    The arrival key must be unique within an order_id: ``row_id`` of the stored
    raw table makes it so when a feed's own ``load_seq`` repeats; the fixture's
    (loaded_at, load_seq) is checked in the tests.
    """
    arrival = arrival_key(params, raw)
    firsts = raw.select(F.col("order_id").alias("_oid"), arrival.alias("_arrival")).groupBy("_oid").agg(F.min("_arrival").alias("_min_arrival"), F.count(F.lit(1)).alias("_copies"))
    several = firsts.where("_copies > 1")
    j = raw.join(several, raw["order_id"].eqNullSafe(several["_oid"]), "left")
    # the key again, so that its wide number is not shuffled beside its columns
    first = F.col("_copies").isNull() | arrival.eqNullSafe(F.col("_min_arrival"))
    return j.withColumn("_first", first).drop("_oid", "_min_arrival", "_copies")


def fill_defaults(df: DataFrame) -> DataFrame:
    """Non-critical NULLs get fixed defaults."""
    return df.withColumns(
        {
            "customer_email": F.coalesce(F.col("customer_email"), F.lit(S.FILL_EMAIL)),
            "customer_phone": F.coalesce(F.col("customer_phone"), F.lit(S.FILL_PHONE)),
            "discount_pct": F.coalesce(F.col("discount_pct"), F.lit(0).cast(S.PCT)),
            "discount_amt": F.coalesce(F.col("discount_amt"), F.lit(0).cast(S.MONEY)),
            "payment_method": F.coalesce(F.col("payment_method"), F.lit(S.FILL_PAYMENT)),
        }
    )


def with_pre_fence_reason(raw: DataFrame, params: S.Params) -> DataFrame:
    """C1, C2, C5, C6 as a ``drop_reason`` column (NULL = still kept)."""
    null_crit = F.col("total_amount").isNull() | F.col("order_id").isNull() | F.col("sale_date").isNull()
    bad_date = (F.col("sale_date") < F.lit(params.min_date)) | (F.col("sale_date") > as_of_col(params))
    reason = (
        F.when(~F.col("_first"), "duplicate")
        .when(null_crit, "null_critical")
        .when(bad_date, "invalid_date")
        .when(F.col("total_amount") <= 0, "non_positive")
    )
    return mark_first_arrival(raw, params).withColumn("drop_reason", reason).drop("_first")


def tag_pre_fence(raw: DataFrame, params: S.Params) -> DataFrame:
    """Whole rows with their ``drop_reason`` and defaults."""
    return fill_defaults(with_pre_fence_reason(raw, params).drop("row_id"))


def fences(pre: DataFrame, params: S.Params) -> DataFrame:
    """C7 fences over the rows that survived C1-C6 (one row)."""
    return iqr_fences(pre.where(F.col("drop_reason").isNull()), "total_amount", params.iqr_k, params.quantile_mode)


def apply_fences(pre: DataFrame, fence: DataFrame) -> DataFrame:
    """C7 tag: rows that survived C1-C6 but fall outside the fences become 'outlier'."""
    f = fence.select(F.col("lower").alias("_lo"), F.col("upper").alias("_hi"))
    amt = F.col("total_amount").cast("double")
    outlier = (amt < F.col("_lo")) | (amt > F.col("_hi"))
    # one-row fence table: broadcast is bounded by construction
    out = pre.crossJoin(F.broadcast(f)).withColumn(
        "drop_reason", F.coalesce(F.col("drop_reason"), F.when(outlier, F.lit("outlier")))
    )
    return out.drop("_lo", "_hi")


def tag(raw: DataFrame, params: S.Params) -> DataFrame:
    """Every raw row with its ``drop_reason`` (NULL = kept); only the fences are computed at once.

    Fine for small inputs; the batch job uses ``write_reasons`` so the fence
    passes read a written table instead of re-planning the whole feed.
    """
    pre = tag_pre_fence(raw, params)
    return apply_fences(pre, fences(pre, params))


def write_reasons(raw: DataFrame, params: S.Params, path: str) -> DataFrame:
    """row_id, order_id, total_amount, drop_reason of every raw row (NULL = kept): C1-C7 on narrow rows.

    C1-C6 are written once to ``path`` (shared storage); the fence passes
    read that table, and so does all that asks for reasons. Whole rows are
    not stored a second time: ``kept_rows`` fetches the survivors by
    ``row_id``. The table cuts lineage (a lost executor recomputes from it).
    """
    spark = raw.sparkSession
    needed = dict.fromkeys(["row_id", "order_id", "total_amount", "sale_date", *_arrival_columns(params, raw)])
    with_pre_fence_reason(raw.select(*needed), params).select("row_id", "order_id", "total_amount", "drop_reason").write.option("compression", files.CODEC).parquet(path)
    return read_reasons(spark, path, params)


def read_reasons(spark: SparkSession, path: str, params: S.Params) -> DataFrame:
    """The written reasons with the fences (C7) applied; the fences are five numbers, computed here."""
    pre = spark.read.parquet(path)
    f = fences(pre, params).first()
    return apply_fences(pre, spark.createDataFrame([tuple(f)], "q1 double, q3 double, iqr double, lower double, upper double"))


def rejected_blocks(reasons: DataFrame) -> DataFrame:
    """block, w0, w1, ...: a bit for every row of the block, set where the row has a reason; blocks without one are left out."""
    rows = reasons.where(F.col("drop_reason").isNotNull()).select("row_id")
    bit = F.expr(f"shiftleft(1L, cast(row_id % {WORD_BITS} as int))")
    words = [F.coalesce(F.bit_or(F.when(_word() == i, bit)), F.lit(0).cast("long")).alias(f"w{i}") for i in range(BLOCK_WORDS)]
    return rows.groupBy(_block().alias("block")).agg(*words)


def _block() -> Column:
    return F.expr(f"row_id div {WORD_BITS * BLOCK_WORDS}")


def _word() -> Column:
    return F.expr(f"row_id div {WORD_BITS} % {BLOCK_WORDS}")


def kept_rows(raw: DataFrame, reasons: DataFrame) -> DataFrame:
    """Whole raw rows without a reason, with defaults.

    ``row_id`` numbers the rows of a task one after the other, so the rejected
    ones fit a bit each. Up to ``BROADCAST_BLOCKS`` blocks of bits go to the
    tasks that scan the raw table, and whole rows are not moved; more are
    joined by shuffle, by the block (no hot key).
    """
    blocks = files.scratch_table(rejected_blocks(reasons), "rejected_blocks")
    if blocks.count() <= BROADCAST_BLOCKS:
        blocks = F.broadcast(blocks)
    word = F.coalesce(*[F.when(_word() == i, F.col(f"w{i}")) for i in range(BLOCK_WORDS)])
    rejected = F.coalesce(F.getbit(word, F.expr(f"cast(row_id % {WORD_BITS} as int)")) == 1, F.lit(False))
    joined = raw.join(blocks, _block() == F.col("block"), "left").where(~rejected)
    return fill_defaults(joined.select(*[c for c in raw.columns if c != "row_id"]))


def text_values(df: DataFrame) -> DataFrame:
    """column, value, standard: the distinct values of the categorical text columns, standardised once each, as a table."""
    some = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in S.TEXT_COLUMNS])).alias("v")
    values = df.select(some).select("v.*").where("value is not null").distinct()
    return files.scratch_table(values.withColumn("standard", standardise("value")), "text_values")


def standardise_text(df: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """Strip + title-case the categorical text columns.

    ``texts`` (``text_values`` of the rows) has the results; a column of up to
    ``BROADCAST_VALUES`` values looks them up, another is standardised row by row.
    """
    counts = {r["column"]: r["count"] for r in texts.groupBy("column").count().collect()} if texts is not None else {}
    known = [c for c in S.TEXT_COLUMNS if 0 < counts.get(c, 0) <= BROADCAST_VALUES]
    out = df.withColumns({c: standardise(c) for c in S.TEXT_COLUMNS if c not in known})
    for c in known:
        pairs = texts.where(F.col("column") == c).select(F.col("value").alias(c), F.col("standard").alias(f"_{c}"))
        out = out.join(F.broadcast(pairs), c, "left").withColumn(c, F.col(f"_{c}")).drop(f"_{c}")
    return out


def derive_columns(df: DataFrame) -> DataFrame:
    """C9 calendar columns and C10 revenue band."""
    cols = calendar_columns("sale_date")
    cols["revenue_band"] = revenue_band("total_amount")
    return df.withColumns(cols)


def finish(kept: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """C8-C10 and the cleaned projection (S7 column set plus the arrival-order columns)."""
    out = derive_columns(standardise_text(kept, texts))
    order_cols = [c for c in ("loaded_at", "load_seq") if c in out.columns]
    return out.select(*S.CLEANED_COLUMNS, *order_cols)


def clean(raw: DataFrame, params: S.Params) -> DataFrame:
    """The cleaned sales table."""
    return finish(tag(raw, params).where(F.col("drop_reason").isNull()).drop("drop_reason"))


def cleaning_report(tagged: DataFrame) -> DataFrame:
    """C11: one row with rows removed per step, final rows, % removed and quality %."""
    aggs = [F.count(F.lit(1)).alias("original_rows")]
    aggs += [F.count_if(F.col("drop_reason") == r).alias(REPORT_KEYS[r]) for r in REASONS]
    aggs.append(F.count_if(F.col("drop_reason").isNull()).alias("final_rows"))
    rep = tagged.agg(*aggs)
    rep = rep.withColumn("rows_removed", F.col("original_rows") - F.col("final_rows"))
    rep = rep.withColumn("cleaning_pct", pct("rows_removed", "original_rows"))
    return rep.withColumn("data_quality_pct", F.bround(F.lit(100.0) - F.col("cleaning_pct"), 1))


def numeric_profile(cleaned: DataFrame) -> DataFrame:
    """min/max/NULL count of the money columns, min/max/type of the int columns, long form."""
    money = ["unit_price", "discount_pct", "discount_amt", "total_amount"]
    ints = ["quantity", "year", "month", "quarter", "is_weekend"]
    aggs = []
    for c in money + ints:
        v = F.col(c).cast("int") if c == "is_weekend" else F.col(c)
        aggs += [F.min(v).cast("double").alias(f"{c}__min"), F.max(v).cast("double").alias(f"{c}__max")]
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"{c}__nulls"))
    wide = cleaned.agg(*aggs)
    types = {f.name: f.dataType.simpleString() for f in cleaned.schema.fields}
    rows = []
    for c in money + ints:
        rows.append(
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"{c}__min").alias("min_value"),
                F.col(f"{c}__max").alias("max_value"),
                F.col(f"{c}__nulls").alias("null_count"),
                F.lit(types.get(c, "")).alias("dtype"),
            )
        )
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
