"""Comparison with earlier runs: status, age, upsert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from siftworks.functions import identity as ident, text as tx, urls
from siftworks.functions.reasons import ladder
from siftworks.operators.skew import salted_left_join
from siftworks.rules import fixed_values as fv

HISTORY_FIELDS = ("job_id", "url", "title", "source", "first_seen", "last_seen", "last_sent",
                  "sent_count", "content_hash", "match_score")


def _join(left: DataFrame, right: DataFrame, key: str, order: str, spread: bool) -> DataFrame:
    if spread:
        return salted_left_join(left, right, key, order)
    return left.join(right, key, "left")


def one_record(history: DataFrame, key: str = "job_id", latest: tuple[str, ...] = ("last_sent", "last_seen")) -> DataFrame:
    """One record per key: the one sent last, then seen last, then the greatest as a whole; records without a key go.

    Groups are made by the key that the joins below use, so this adds no exchange to theirs.
    """
    rest = [c for c in history.columns if c != key]
    by = F.struct(*[c for c in latest if c in rest], *rest)
    return history.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*rest), by).alias("_rec")).select(key, "_rec")


def annotate_history(df: DataFrame, history: DataFrame, now: Column, skip_days: int = fv.ROTATION_DAYS,
                     order: str = "seq", spread: bool = False, hashed: bool = False) -> DataFrame:
    """Attach the history record of each posting and derive its status.

    After dedup the key is (nearly) unique and a plain join is right; pass
    ``spread=True`` for tables that may hold many rows of one key, and ``hashed=True``
    for postings that have their job_id and content_hash.  Of several
    records of a job_id the one sent last counts.
    """
    left = df if hashed else tx.settle(df, {"job_id": ident.job_id(df), "content_hash": ident.content_hash(df)})
    record = one_record(history.select("job_id", "first_seen", "last_seen", "last_sent", "sent_count", "content_hash"))
    joined = _join(left, record, "job_id", order, spread)
    known, rec = F.col("_rec").isNotNull(), lambda name: F.col(f"_rec.{name}")
    found = tx.field(df, "found_at")

    def either(name: str, fallback: Column) -> Column:
        return F.when(known, tx.first_filled(tx.nz(rec(name)), fallback)).otherwise(
            tx.first_filled(tx.field(df, name), fallback))

    sent = either("last_sent", F.lit(""))
    count = F.when(known, tx.to_int(rec("sent_count"))).otherwise(tx.to_int(tx.field(df, "sent_count")))
    dated = joined.withColumns({
        "first_seen": either("first_seen", found),
        "last_seen": either("last_seen", found),
        "last_sent": sent,
        "sent_count": count,
        "_moment": ident.parse_time(sent),
    })
    age_seconds = F.unix_timestamp(now) - F.unix_timestamp(F.col("_moment"))
    days = ident.age_days(F.col("_moment"), now)
    return tx.settle(dated, {
        "history_status": ladder([
            (~known, "NEW"),
            (tx.nz(rec("content_hash")) != F.col("content_hash"), "UPDATED"),
            (age_seconds >= skip_days * 86400, "RESURFACED"),
        ], "SEEN"),
        "days_since_last_sent": days,
        "rotation_eligible": F.coalesce((F.col("sent_count") > 0) & (days >= skip_days), tx.no()),
    }).drop("_rec", "_moment")


def attach_pool_history(df: DataFrame, history: DataFrame, now: Column,
                        rotation_days: int = fv.ROTATION_DAYS) -> DataFrame:
    """History fields of pool rows; age and rotation are only filled when absent."""
    record = one_record(history.select("job_id", "first_seen", "last_seen", "last_sent", "sent_count"))
    joined = df.join(record, "job_id", "left")
    rec, found = lambda name: tx.nz(F.col(f"_rec.{name}")), tx.field(df, "found_at")
    out = joined.withColumns({
        "first_seen": tx.first_filled(rec("first_seen"), found),
        "last_seen": tx.first_filled(rec("last_seen"), found),
        "last_sent": rec("last_sent"),
        "sent_count": tx.to_int(F.col("_rec.sent_count")),
    }).drop("_rec")
    if "days_since_last_sent" not in df.columns:
        out = out.withColumn("days_since_last_sent", ident.age_days(ident.parse_time(F.col("last_sent")), now))
    if "rotation_eligible" not in df.columns:
        out = out.withColumn("rotation_eligible", F.coalesce(
            (F.col("sent_count") > 0) & (F.col("days_since_last_sent") >= rotation_days), tx.no()))
    return out


def annotate_sent_keys(df: DataFrame, sent: DataFrame, now: Column, rotation_days: int = fv.ROTATION_DAYS,
                       include_seen: bool = False, order: str = "seq", spread: bool = False) -> DataFrame:
    """Status against the small history (key, sent_at date, content_hash).

    An entry without hash counts as unchanged.  Unchanged rows that are not yet
    due get an empty selection_reason.
    """
    left = tx.settle(df, {"history_key": ident.sent_key(df), "row_hash": ident.sent_content_hash(df)})
    record = one_record(sent.select(F.col("key").alias("history_key"), "sent_at", "content_hash"), "history_key", ("sent_at",))
    joined = _join(left, record, "history_key", order, spread)
    known, old = F.col("_rec").isNotNull(), tx.nz(F.col("_rec.content_hash"))
    days = ident.calendar_age_days(F.col("_rec.sent_at"), now)
    due = F.coalesce(days >= rotation_days, tx.no())
    same = known & ((old == F.col("row_hash")) | (old == ""))
    waiting = tx.no() if include_seen else ~due
    state = ladder([
        (~known, "NEW"),
        (~same, "UPDATED"),
        (F.lit(include_seen) | waiting, "SEEN"),
    ], "RESURFACED")
    return joined.withColumns({
        "days_since_last_sent": days,
        "rotation_eligible": due,
        "history_status": state,
        "selection_reason": F.when(same & waiting, "").otherwise(state),
    }).drop("_rec")


def sent_records(sent: DataFrame, now: Column, order: str = "seq") -> DataFrame:
    """(job_id, _new): what the rows sent in a run say of each job.

    Rows of one job_id are sent one after the other: the last gives the fields,
    the first its found_at, and each counts.
    """
    row = F.struct(
        urls.canonical_url(tx.field(sent, "url")).alias("url"),
        tx.field(sent, "title").alias("title"),
        tx.field(sent, "source").alias("source"),
        sent["content_hash"].alias("content_hash"),
        (tx.to_int(sent["match_score"]) if "match_score" in sent.columns else F.lit(0)).alias("match_score"),
    )
    rows = sent.select("job_id", F.col(order).alias("_at"), tx.field(sent, "found_at").alias("found_at"), row.alias("_row"))
    return rows.groupBy("job_id").agg(
        F.max_by("_row", "_at").alias("_row"), F.min_by("found_at", "_at").alias("found_at"), F.count("*").cast("int").alias("times"),
    ).select("job_id", F.struct("_row.*", "found_at", "times", F.date_format(now, "yyyy-MM-dd'T'HH:mm:ssXXX").alias("sent_at")).alias("_new"))


def renewed(both: DataFrame) -> DataFrame:
    """Records of a join of ``_rec`` (the old record) and ``_new`` (what was sent); either may be null."""
    new = F.col("_new").isNotNull()
    keep = lambda name: F.col(f"_rec.{name}")
    take = lambda name: F.when(new, F.col(f"_new.{name}")).otherwise(keep(name)).alias(name)
    sent_at = F.col("_new.sent_at")
    first = tx.first_filled(tx.nz(keep("first_seen")), tx.nz(F.col("_new.found_at")), sent_at)
    return both.select(
        "job_id", take("url"), take("title"), take("source"),
        F.when(new, first).otherwise(keep("first_seen")).alias("first_seen"),
        F.when(new, sent_at).otherwise(keep("last_seen")).alias("last_seen"),
        F.when(new, sent_at).otherwise(keep("last_sent")).alias("last_sent"),
        F.when(new, F.coalesce(keep("sent_count").cast("int"), F.lit(0)) + F.col("_new.times")).otherwise(keep("sent_count").cast("int")).alias("sent_count"),
        take("content_hash"), take("match_score"),
    )


def upsert_history(history: DataFrame, sent: DataFrame, now: Column, order: str = "seq") -> DataFrame:
    """History after a run: sent rows replace or extend the record of their key.

    One full outer join of two keyed tables; the result is a new snapshot and
    must be written to a new folder.  ``sources.history_table`` keeps a history
    of which a run rewrites the touched parts only.
    """
    return renewed(one_record(history.select(*HISTORY_FIELDS)).join(sent_records(sent, now, order), "job_id", "full_outer"))


def upsert_sent_keys(sent: DataFrame, rows: DataFrame, now: Column, zone: str = "Europe/Rome") -> DataFrame:
    """Small history after a run: only date and hash of the sent keys change."""
    fresh = rows.select(
        F.col("history_key").alias("key"),
        F.to_date(F.from_utc_timestamp(now, zone)).alias("_day"), F.col("row_hash").alias("_hash"))
    both = sent.join(fresh, "key", "full_outer")
    return both.select(
        "key", F.coalesce("_day", "sent_at").alias("sent_at"), F.coalesce("_hash", "content_hash").alias("content_hash"))


def preserve_actions(pool: DataFrame, previous: DataFrame) -> DataFrame:
    """Carry user-entered actions of the previous pool over by job_id (non-empty only)."""
    noted = (
        previous.filter((tx.nz(F.col("job_id")) != "") & (tx.nz(F.col("action")) != ""))
        .groupBy("job_id").agg(F.max_by("action", "seq").alias("_action"))
    )
    joined = pool.join(noted, "job_id", "left")
    return joined.withColumn("action", F.coalesce("_action", tx.field(pool, "action"))).drop("_action")
