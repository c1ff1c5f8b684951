"""Ordering, limits, bucketed selection and quota selection."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from siftworks.functions import classify as cl, identity as ident, reasons as rs, text as tx
from siftworks.operators.dedup import keep_first
from siftworks.rules import WeightedRules, fixed_values as fv
from siftworks.session import cut, written

SCORES = ("match_score", "student_score", "candidate_score", "score")
# Every column that an order of this module looks at, besides the input order.
SORT_FIELDS = ("selection_reason", "history_status", "priority_bucket", "remote", "job_score", *SCORES)

# What to sort a table by; it is asked again for each form of the table.
Order = Callable[[DataFrame], list[Column]]


def by_scores(df: DataFrame, names=SCORES) -> list[Column]:
    return [rs.score_of(df, name).desc() for name in names if name in df.columns]


def status_order(df: DataFrame, order: str = "seq") -> list[Column]:
    """Selection reason, history status, four scores, then input order."""
    return [
        rs.position(tx.field(df, "selection_reason"), fv.SELECTION_ORDER),
        rs.position(tx.field(df, "history_status"), fv.STATUS_ORDER),
        *by_scores(df), F.col(order),
    ]


def _sort_columns(df: DataFrame) -> list[Column]:
    """What :func:`status_order` sorts by, as columns of a narrow table."""
    return [rs.position(tx.field(df, "selection_reason"), fv.SELECTION_ORDER).alias("_reason"),
            rs.position(tx.field(df, "history_status"), fv.STATUS_ORDER).alias("_status"),
            *[rs.score_of(df, n).alias(f"_{n}") for n in SCORES if n in df.columns]]


def _sorted(df: DataFrame) -> list[Column]:
    """The order of :func:`status_order` over the columns of :func:`_sort_columns` and ``_order``."""
    return [F.col("_reason"), F.col("_status"), *[F.col(f"_{n}").desc() for n in SCORES if n in df.columns], F.col("_order")]


def report_order(df: DataFrame, order: str = "seq") -> list[Column]:
    return [rs.position(tx.field(df, "selection_reason"), fv.SELECTION_ORDER), *by_scores(df), F.col(order)]


def pool_order(df: DataFrame, order: str = "seq") -> list[Column]:
    return [*by_scores(df), F.col(order)]


def local_part_time_order(df: DataFrame, names=("match_score", "student_score", "score"), order: str = "seq") -> list[Column]:
    """Local part-time rows, then remote rows, then by score."""
    return [
        (tx.field(df, "priority_bucket") == "campania_part_time").desc(),
        tx.flag(df, "remote").desc(), *by_scores(df, names), F.col(order),
    ]


def collector_top(df: DataFrame, top: int, part_time_first: bool = False,
                  names=("match_score", "student_score", "score"), order: str = "seq") -> DataFrame:
    """Best rows of one site collection."""
    sort = local_part_time_order(df, names, order) if part_time_first else [*by_scores(df, names), F.col(order)]
    return df.orderBy(*sort).limit(top)


# Rows that may be ordered in one task.
ONE_TASK = 50_000


def rank_rows(df: DataFrame, sort: list[Column], name: str = "rank") -> DataFrame:
    """Number the rows of an already limited table."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(*sort)))


def first_rows(df: DataFrame, sort: Order, top: int, columns: list[str], one_task: int = ONE_TASK) -> DataFrame:
    """Those columns of the first ``top`` rows of a total order, in no order.

    A small ``top`` is a sort with a limit, where each task sends its best rows.
    Beyond ``one_task`` rows the columns are written in ranges of the order instead:
    ranges that end within ``top`` are taken as they are, and only the range at the
    edge is ordered.  ``sort`` must be a total order over ``columns`` (it ends with the
    unique input order); fewer rows than ``top``, or none, are all taken.
    """
    top = max(top, 0)
    if top <= one_task:
        return df.orderBy(*sort(df)).limit(top).select(*columns)
    narrow = written(df.select(*columns), "narrow")  # ranges are drawn from a first look at the rows, which would compute them twice
    placed = written(narrow.repartitionByRange(*sort(narrow)).withColumn("_part", F.spark_partition_id()), "ranges")
    ends = placed.groupBy("_part").agg(F.count("*").alias("_size")).withColumn("_end", F.sum("_size").over(Window.orderBy("_part")))
    # One row per range; where the edge lies is all that the driver gets.
    edge = ends.filter(F.col("_end") > top).orderBy("_part").first()
    if edge is None:
        return placed.drop("_part")
    at = placed.filter(F.col("_part") == edge["_part"])
    rest = at.orderBy(*sort(at)).limit(top - edge["_end"] + edge["_size"])
    return placed.filter(F.col("_part") < edge["_part"]).unionByName(rest).drop("_part")


def rank_top(df: DataFrame, sort: Order, top: int, order: str = "seq", name: str = "rank", one_task: int = ONE_TASK) -> DataFrame:
    """The first ``top`` rows of a total order, whole and numbered.

    Beyond ``one_task`` rows only the columns that are sorted by travel: they are cut at
    ``top`` by ranges, numbered by ranges, and the rows are joined back by ``order``.
    """
    if top <= one_task:
        best = df.orderBy(*sort(df)).limit(max(top, 0))
        return rank_rows(best, sort(best), name)
    columns = [c for c in dict.fromkeys([*SORT_FIELDS, order]) if c in df.columns]
    first = first_rows(df.select(*columns), sort, top, columns, one_task)
    return df.join(rank_all(first, sort(first), [order], name), order)


def rank_all(df: DataFrame, sort: list[Column], columns: list[str], name: str = "rank",
             by: Sequence[str] = (*SORT_FIELDS, "seq")) -> DataFrame:
    """Number all rows of a table in sort order, without a global window.

    A range-partitioned sort is written once with the place of each row in its partition;
    the sizes of the partitions, one row each, add up to where a partition begins.
    ``sort`` names columns among ``columns`` and ``by``; only these are computed, once, and sorted.
    """
    spot = F.monotonically_increasing_id()
    # The sort looks at its rows twice, first for the ranges.
    narrow = written(df.select(*columns, *[c for c in by if c in df.columns and c not in columns]), "sorted")
    placed = written(narrow.orderBy(*sort).select(*columns, F.shiftright(spot, 33).alias("_part"), spot.bitwiseAND((1 << 33) - 1).alias("_spot")), "ranked")
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    return placed.join(starts, "_part").select(*columns, (F.col("_start") + F.col("_spot") + 1).cast("int").alias(name))


def top_report(df: DataFrame, rules: WeightedRules, order: str = "seq") -> DataFrame:
    """Rows of the short report: minimum score, best first, limited."""
    return (
        df.filter(F.col("job_score") >= rules.top_min_score)
        .orderBy(F.col("job_score").desc(), F.col(order)).limit(rules.top_limit)
    )


# --- history repeat ------------------------------------------------------------

def first_seen_cutoff(df: DataFrame, repeat: int, order: str = "seq") -> Column:
    """Order value of the last SEEN row that may be repeated (null when none)."""
    seen = df.filter(rs.status(df) == "SEEN").select(order).orderBy(order).limit(max(repeat, 0))
    return seen.agg(F.max(order)).scalar()


def repeat_filter(df: DataFrame, include_seen: bool = False, repeat: int = fv.MAX_SEEN_REPEAT,
                  order: str = "seq") -> DataFrame:
    """Drop SEEN rows, or keep the first ``repeat`` of them in input order."""
    seen = tx.field(df, "history_status") == "SEEN"
    if not include_seen:
        return df.filter(~seen)
    return df.filter(~seen | F.coalesce(F.col(order) <= first_seen_cutoff(df, repeat, order), tx.no()))


# --- bucketed selection ----------------------------------------------------------

def select_by_buckets(df: DataFrame, target: int = fv.SELECTION_TARGET, min_match: int = fv.SELECTION_MIN_MATCH,
                      include_seen: bool = False, repeat: int = fv.MAX_SEEN_REPEAT,
                      fallback: bool = False, order: str = "seq", one_task: int = ONE_TASK) -> DataFrame:
    """At most ``target`` rows from ordered buckets, one row per dedup key.

    Filling bucket after bucket and skipping taken keys gives the same rows as
    ranking every row by (bucket, sort order), keeping the first row of each key
    and cutting at the target, which needs no loop over rows.
    """
    buckets = rs.selection_buckets(df)
    seen = tx.no()
    if include_seen:
        seen = (rs.status(df) == "SEEN") & F.coalesce(F.col(order) <= first_seen_cutoff(df, repeat, order), tx.no())
    ordered = [(name, buckets[name]) for name in ("NEW", "UPDATED", "NEVER_SENT_FILL", "RESURFACED")]
    ordered.append(("SEEN", seen))
    ordered.append(("FALLBACK_ROTATION", buckets["FALLBACK_ROTATION"] if fallback else tx.no()))
    number = F.coalesce(*[F.when(test, F.lit(i)) for i, (_, test) in enumerate(ordered)])
    # Narrow first: only the key and the sort columns are ranked; the chosen rows, at most ``target``, are joined back.
    narrow = df.withColumn("_bucket", number).filter(F.col("_bucket").isNotNull() & rs.selectable(df, min_match)).select(
        F.col(order).alias("_order"), "_bucket", ident.dedup_key(df).alias("_key"), *_sort_columns(df))
    sort = [F.col("_bucket"), *_sorted(df)]
    firsts = keep_first(narrow, ["_key"], sort)
    chosen = first_rows(firsts, lambda _: sort, target, firsts.columns, one_task).select(F.col("_order").alias(order), "_bucket")
    names = F.array(*[F.lit(name) for name, _ in ordered])
    return df.join(chosen, order).withColumn("selection_reason", F.element_at(names, F.col("_bucket") + 1)).drop("_bucket")


def write_back_selection(df: DataFrame, selected: DataFrame, min_match: int = fv.SELECTION_MIN_MATCH,
                         include_seen: bool = False) -> DataFrame:
    """Selection reason of the chosen keys on every row, a rejection reason on the rest.

    The selection is bounded by its target; whether it is broadcast is left to its measured size.
    """
    chosen = selected.select(ident.dedup_key(selected).alias("_key"), F.col("selection_reason").alias("_reason"))
    keyed = df.withColumn("_key", ident.dedup_key(df)).join(chosen, "_key", "left")
    hit = F.col("_reason").isNotNull()
    return keyed.withColumns({
        "selection_reason": F.coalesce("_reason", tx.field(df, "selection_reason")),
        "selection_rejection_reason": rs.selection_rejection(keyed, hit, min_match, include_seen),
    }).drop("_key", "_reason")


def rotation_top(df: DataFrame, limit: int = fv.SENT_KEY_LIMIT, order: str = "seq") -> DataFrame:
    """Selected / waiting / over-limit reason of the small-history rows.

    Input: one row per sent key with ``selection_reason`` ('' = not due).
    """
    candidates = df.filter(tx.field(df, "selection_reason") != "")
    score = F.coalesce(df["job_score"].cast("int"), F.lit(0))
    rank = rs.position(tx.field(df, "selection_reason"), fv.STATUS_ORDER)
    chosen = candidates.orderBy(rank, score.desc(), order).limit(limit).select(order, F.lit(True).alias("_chosen"))
    return df.join(chosen, order, "left").withColumn(
        "selection_rejection_reason",
        F.when(F.col("_chosen"), "selected")
        .when(tx.field(df, "selection_reason") == "", "not_rotation_eligible")
        .otherwise("not_selected_due_to_limit"),
    ).drop("_chosen")


# --- quota selection -----------------------------------------------------------------

def quota_groups(df: DataFrame) -> dict[str, Column]:
    """Overlapping category groups, in order of their claim."""
    text = F.lower(F.concat_ws(" ", *[tx.field(df, n) for n in ("title", "company", "location", "category", "query")]))
    kind = F.lower(tx.field(df, "category"))
    groups = {"remote": (tx.field(df, "priority_bucket") == "remote_data") | tx.flag(df, "remote")}
    for name in ("data_office", "hospitality", "cleaning", "maintenance"):
        groups[name] = kind.isin(*fv.QUOTA_CATEGORIES[name]) | tx.has_any(text, fv.QUOTA_TERMS[name])
    return groups


def quota_top(df: DataFrame, top: int = fv.EXPORT_TOP, quotas: Mapping[str, int] | None = None,
              groups: Mapping[str, Column] | None = None, order: str = "seq", one_task: int = ONE_TASK) -> DataFrame:
    """Top rows with a minimum share per category group.

    Groups claim their best keys in turn, then the rest is filled by score.  A
    group can lose at most the keys claimed before it, so its first
    (earlier quotas + own quota) keys are all it ever needs: one cut by ``first_rows``
    per group over the narrow sort columns.  The claims are then replayed as one
    anti join and limit per group, and the chosen rows joined back.
    """
    quotas = dict(fv.QUOTA_SIZES if quotas is None else quotas)
    groups = quota_groups(df) if groups is None else groups
    near = tx.field(df, "location_fit") != "excluded_far"
    stages = [(near & groups[name], max(0, size)) for name, size in quotas.items()] + [(F.lit(True), top)]
    member = F.array_compact(F.array(*[F.when(test, F.lit(i)) for i, (test, _) in enumerate(stages)]))
    narrow = df.select(F.col(order).alias("_order"), ident.dedup_key(df).alias("_key"), member.alias("_stages"), *_sort_columns(df))
    sort = _sorted(df)
    best = written(keep_first(narrow.withColumn("_stage", F.explode("_stages")).drop("_stages"), ["_stage", "_key"], sort), "quota")
    claims, needed = None, 0
    for stage, (_, size) in enumerate(stages):
        needed += size
        pool = first_rows(best.filter(F.col("_stage") == stage), lambda _: sort, needed, best.columns, one_task)
        if claims is not None:
            pool = pool.join(claims.select("_key"), "_key", "left_anti")
        own = written(first_rows(pool, lambda _: sort, size, best.columns, one_task), "claims")
        claims = own if claims is None else claims.unionByName(own)
    chosen = first_rows(claims, lambda _: [F.col("_stage"), *sort], top, best.columns, one_task).select(F.col("_order").alias(order))
    result = df.join(chosen, order, "left_semi")
    return result.orderBy(*status_order(result, order))


# --- community and hit limits -----------------------------------------------------------

def community_top(df: DataFrame, top: int = fv.COMMUNITY_LIMIT, per_query: int | None = None, order: str = "seq") -> DataFrame:
    """Best posts overall, after an optional cap per query in input order."""
    if per_query is not None:
        window = Window.partitionBy("query").orderBy(order)
        df = df.withColumn("_n", F.row_number().over(window)).filter(F.col("_n") <= per_query).drop("_n")
    return df.orderBy(F.col("score").desc(), order).limit(top)


def top_paths(counts: DataFrame, limit: int = 10) -> DataFrame:
    """Most frequent path prefixes per collector; ties by first appearance."""
    window = Window.partitionBy("collector").orderBy(F.col("n").desc(), F.col("first_seq"), F.col("first_pos"))
    return counts.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= limit)


def hit_cap(df: DataFrame, limit: int, query_count: int) -> DataFrame:
    """First ``limit * query_count`` hits in query order."""
    return df.orderBy("query_seq", "hit_seq").limit(limit * query_count)
