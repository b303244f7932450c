"""Append-only ledgers: latest state, references, overrides and replay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import OVERRIDABLE


def latest(df: DataFrame, keys: list[str], time: str, tie: str) -> DataFrame:
    """The last row of each key; its nulls count.  One aggregation, no sort."""
    rest = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(time, tie)).alias("last")
    return df.groupBy(*keys).agg(last).select(*keys, *(F.col(f"last.`{c}`").alias(c) for c in rest))


def active_suppressions(ledger: DataFrame) -> DataFrame:
    rows = ledger.select("voter_id", "suppression_id", "action", "requested_at")
    return latest(rows, ["voter_id"], "requested_at", "suppression_id").filter("action = 'suppress'")


def corrections_latest(ledger: DataFrame) -> DataFrame:
    rows = ledger.select("meeting_id", "target_column", "correction_id", "corrected_value", "corrected_by", "corrected_at", "reason")
    return latest(rows, ["meeting_id", "target_column"], "corrected_at", "correction_id")


def unlogged(batch: DataFrame, log: DataFrame, key: str) -> DataFrame:
    return batch.join(log.select(key), key, "left_anti")


def append(batch: DataFrame, log: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The ledger with what it didn't hold yet, and one row {logged, skipped}."""
    new = unlogged(batch, log, key)
    counts = batch.join(log.select(key, F.lit(True).alias("known")), key, "left").agg(F.count_if(F.col("known").isNull()).alias("logged"), F.count_if(F.col("known").isNotNull()).alias("skipped"))
    return log.unionByName(new), counts


def missing(rows: DataFrame, key: str, entities: DataFrame, entity_key: str) -> DataFrame:
    """Ledger rows whose entity doesn't exist."""
    return rows.join(entities.select(F.col(entity_key).alias(key)), key, "left_anti")


def unresolved(batch: DataFrame, log: DataFrame | None = None) -> DataFrame:
    """Rows that supersede an id neither in this batch nor logged before."""
    ids = batch.select(F.col("suppression_id").alias("supersedes"))
    ids = ids.unionByName(log.select(F.col("suppression_id").alias("supersedes"))) if log is not None else ids
    return batch.filter(F.col("supersedes").isNotNull()).join(ids.distinct(), "supersedes", "left_anti")


def snapshots(ledger: DataFrame, base: DataFrame, key: str = "meeting_id") -> DataFrame:
    """Each override with the value it replaced, earlier ones in the batch included."""
    columns = [c for c in OVERRIDABLE if c in base.columns]
    long = base.select(key, *(F.col(c).cast("string").alias(c) for c in columns)).unpivot(key, columns, "target_column", "base_value")
    order = Window.partitionBy(key, "target_column").orderBy("load_seq", "correction_id")
    rows = ledger.withColumns({"nth": F.row_number().over(order), "before": F.lag("corrected_value").over(order)})
    original = F.when(F.col("nth") == 1, F.col("base_value")).otherwise(F.col("before"))
    return rows.join(long, [key, "target_column"]).withColumn("original_value", original).drop("nth", "before", "base_value")


def applied(batch: DataFrame, log: DataFrame, base: DataFrame, key: str = "meeting_id") -> DataFrame:
    """The batch with ``known`` (its id is logged), ``lost`` (a new one for no entity) and ``original_value``.

    The original of the first new override of a cell is the value in effect,
    with the logged ones applied; that of a later one is what the one before it
    in the batch wrote.  Known and lost rows have none.
    """
    marked = batch.join(log.select("correction_id", F.lit(True).alias("known")), "correction_id", "left").select(*batch.columns, F.coalesce("known", F.lit(False)).alias("known"))
    return valued(marked, log, base, key)


def applied_within(batch: DataFrame, log: DataFrame, base: DataFrame, key: str = "meeting_id") -> DataFrame:
    """``applied`` with ids looked up among those of the same entity only, and ``_times`` a row's id occurs there in the batch.

    Batch, log and entities meet once, by entity.  If no id is then held twice
    by log and new rows together, the rows are those of ``applied``.
    """
    marks = log.select(key, "correction_id", F.lit(True).alias("_logged")).repartition(key)
    both = batch.withColumn("_logged", F.lit(False)).unionByName(marks, allowMissingColumns=True)
    of_id = Window.partitionBy(key, "correction_id")
    marked = both.withColumns({"known": F.max("_logged").over(of_id), "_times": F.count_if(~F.col("_logged")).over(of_id)})
    return valued(marked.filter("NOT _logged").drop("_logged"), log, base, key)


def valued(marked: DataFrame, log: DataFrame, base: DataFrame, key: str = "meeting_id") -> DataFrame:
    """A batch with ``known`` set: adds ``lost`` and ``original_value``, as in ``applied``.

    The batch, the log and the entities meet once, by entity.  The log is sent
    row by row: summed up before, its rows would be sorted twice, and an entity
    has few.
    """
    columns = [c for c in OVERRIDABLE if c in base.columns]
    now = effective(base, log.repartition(key), key)
    now = now.select(key, F.lit(True).alias("_there"), *(F.col(c).cast("string").alias(f"_now_{c}") for c in columns))
    rows = marked.join(now, key, "left").withColumn("lost", ~F.col("known") & F.col("_there").isNull())
    # Known and lost rows are no earlier ones; as keys of the window these filters are pushed below it.
    order = Window.partitionBy(key, "target_column", "known", "lost").orderBy("load_seq", "correction_id")
    present = F.coalesce(*(F.when(F.col("target_column") == c, F.col(f"_now_{c}")) for c in columns))
    rows = rows.withColumns({"_nth": F.row_number().over(order), "_before": F.lag("corrected_value").over(order)})
    original = F.when(F.col("known") | F.col("lost"), F.lit(None)).when(F.col("_nth") == 1, present).otherwise(F.col("_before"))
    return rows.select(*marked.columns, "lost", original.alias("original_value"))


def apply_counts() -> dict[str, Column]:
    """{logged, applied, skipped} and lost of ``applied`` rows; a new override of an entity is logged and applied at once."""
    new = F.count_if(~F.col("known") & ~F.col("lost"))
    return {"logged": new, "applied": new, "skipped": F.count_if("known"), "lost": F.count_if("lost")}


def effective(base: DataFrame, ledger: DataFrame, key: str = "meeting_id") -> DataFrame:
    """The entities with all overrides applied; a null override clears a value.

    One aggregation of the ledger makes one row for each entity, and one join
    brings it to the base.
    """
    columns = [c for c in OVERRIDABLE if c in base.columns]
    order = F.struct("load_seq", "correction_id")
    last = [F.max_by(F.when(F.col("target_column") == c, F.struct("corrected_value")), F.when(F.col("target_column") == c, order)).alias(f"_{c}") for c in columns]
    wide = ledger.groupBy(key).agg(*last)
    types = dict(base.dtypes)
    value = lambda c: F.when(F.col(f"_{c}").isNotNull(), F.col(f"_{c}.corrected_value").try_cast(types[c])).otherwise(F.col(c)).alias(c)
    return base.join(wide, key, "left").select(*(value(c) if c in columns else F.col(c) for c in base.columns))


def as_of(base: DataFrame, ledger: DataFrame, time, key: str = "meeting_id") -> DataFrame:
    """The entities as the ledger stood at ``time``."""
    return effective(base, ledger.filter(F.col("corrected_at") <= time), key)


#: Seconds of a span of time in ``as_of_each``, and rows of an entity beyond which it is cut into spans.
SPAN_S, HOT = 30 * 86400, 10_000


def as_of_each(base: DataFrame, ledger: DataFrame, asked: DataFrame, time: str = "at", key: str = "meeting_id", span: int = SPAN_S, most: int = HOT) -> DataFrame:
    """Each row of ``asked`` (key, ``time`` and any more) with its entity as the ledger stood then, in one pass.

    At a time the override of greatest (load_seq, correction_id) among those
    made by then counts, so what counts is a running maximum over the times of
    an entity.  Overrides, asked rows and entities meet once, by entity.  Only
    entities of more than ``most`` rows are cut into spans of time: the maxima
    of whole spans run over the spans, and single overrides only within their
    own, so the work of one is dealt out.  Asked rows for no entity have nulls;
    rows without a time have the entity as it was before all overrides.
    """
    columns = [c for c in OVERRIDABLE if c in base.columns]
    order = ["load_seq", "correction_id", "corrected_value"]
    cells = {f"_{c}": F.when(F.col("target_column") == c, F.struct(*order)) for c in columns}
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp")).alias("_t")
    made = ledger.filter(F.col("corrected_at").isNotNull() & F.col(key).isNotNull()).select(key, micros("corrected_at"), F.lit(0).alias("_asks"), "target_column", *order)
    both = made.unionByName(asked.select(key, micros(time), F.lit(1).alias("_asks"), F.struct(*asked.columns).alias("_row")), allowMissingColumns=True)
    # At most one in ``most`` rows, so few enough to broadcast.
    hot = F.broadcast(both.groupBy(F.col(key).alias("_hot")).agg(F.count("*").alias("n")).filter(F.col("n") > most).select("_hot"))
    is_hot = F.col(key).eqNullSafe(F.col("_hot"))

    def seen(rows: DataFrame, *by: str) -> DataFrame:
        """Asked rows with the running maxima within ``by``."""
        running = Window.partitionBy(*by).orderBy("_t", "_asks").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return rows.select(*by, "_row", "_asks", *(F.max(n).over(running).alias(n) for n in cells)).filter("_asks = 1")

    # Cells are made behind the exchange: before it they would widen every row.
    few = seen(both.join(hot, is_hot, "left_anti").repartition(key).withColumns(cells), key)
    many = both.join(hot, is_hot, "left_semi").withColumn("_span", F.floor(F.col("_t") / (span * 1_000_000))).repartition(key, "_span").withColumns(cells)
    # One row a span of an entity.  A null entity or span has nothing before it, so plain equality will do.
    earlier = Window.partitionBy(key).orderBy(F.col("_span").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    spans = many.groupBy(key, "_span").agg(*(F.max(n).alias(n) for n in cells))
    carried = spans.select(key, "_span", *(F.max(n).over(earlier).alias(f"_before{n}") for n in cells))
    cut = seen(many, key, "_span").join(carried, [key, "_span"], "left").select(key, "_row", *(F.greatest(n, f"_before{n}").alias(n) for n in cells))
    types = dict(base.dtypes)
    value = lambda c: F.when(F.col(f"_{c}").isNotNull() & F.col("_there"), F.col(f"_{c}.corrected_value").try_cast(types[c])).otherwise(F.col(f"b.{c}")).alias(c)
    there = base.withColumn("_there", F.lit(True)).alias("b")

    def valued(rows: DataFrame) -> DataFrame:
        out = rows.withColumnRenamed(key, "_key").join(there, F.col("_key") == F.col(f"b.{key}"), "left")
        return out.select("_row.*", *(value(c) if c in columns else F.col(f"b.{c}").alias(c) for c in base.columns if c not in asked.columns))

    return valued(few.select(key, "_row", *cells)).unionByName(valued(cut))
