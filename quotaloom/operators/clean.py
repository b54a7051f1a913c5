"""Cleansing transforms (raw extract → processed table) and data-quality checks.

Rules per dataset, in the reference's order: keep-first dedupe on the key (before any
validity rule, so a bad first copy hides a good second one), type coercion where bad
values become null, business rules, derived columns. Each function is a lazy
``DataFrame -> DataFrame``.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dedupe import keep_first
from ..functions.exprs import (
    VALID_STAGES, clip, month_key, rnd, safe_div, strip, title_case, title_case_text, to_date_lenient, to_number,
    to_text,
)
from ..functions.joins import small
from ..sources.schemas import FOREIGN_KEYS, MONEY, NOT_NULL, PRIMARY_KEYS


def _first(df: DataFrame, key: str, unique: bool = False) -> DataFrame:
    """Keep the first row per key in ingest order (``_seq``); the order column is dropped.

    ``unique``: the key is unique by construction (a derived extract), there is nothing to drop.
    """
    if unique:
        return df.drop("_seq")
    if "_seq" not in df.columns:
        raise ValueError(f"keep-first on {key} needs the input order in a column _seq")
    return keep_first(df, key, ["_seq"]).drop("_seq")


def _money(number: Column) -> Column:
    """The amount as stored; null where it does not fit, so that the rules judge what is stored."""
    return number.try_cast(MONEY)


def _key(df: DataFrame, name: str) -> Column:
    """Identifier column: text keys get the missing-token rule, typed keys stay as they are."""
    dt = df.schema[name].dataType.simpleString()
    return (to_text(df, name) if dt == "string" else F.col(name)).alias(name)


def _coerce_reps(d: DataFrame, flags: bool = False) -> DataFrame:
    cols = [
        _key(d, "rep_id"),
        *[title_case_text(c).alias(c) if dict(d.dtypes)[c] == "string" else title_case(strip(to_text(d, c))).alias(c)
          for c in ("rep_name", "region", "territory")],
        to_text(d, "manager").alias("manager"),
        to_date_lenient(d, "hire_date").alias("hire_date"),
    ]
    if flags:
        cols.append((to_text(d, "hire_date").isNotNull() & to_date_lenient(d, "hire_date").isNull()).alias("_hire_bad"))
    return d.select(*cols)


def clean_reps(raw: DataFrame) -> DataFrame:
    """TR1: dedupe; trim + title-case name, region, territory; hire date; drop incomplete rows."""
    return _coerce_reps(_first(raw, "rep_id")).na.drop(subset=["rep_id", "rep_name", "region", "territory"])


def _coerce_opportunities(d: DataFrame) -> DataFrame:
    """TR2 coercions and repairs on deduplicated rows (before the row filters)."""
    stage = to_text(d, "stage")
    return d.select(
        _key(d, "opportunity_id"), _key(d, "rep_id"), _key(d, "product_id"), _key(d, "campaign_id"),
        to_date_lenient(d, "created_date").alias("created_date"),
        to_date_lenient(d, "close_date").alias("close_date"),
        F.when(F.coalesce(stage.isin(VALID_STAGES), F.lit(False)), stage).otherwise("Prospecting").alias("stage"),
        to_number(d, "deal_value").alias("_number"),
        _money(to_number(d, "deal_value")).alias("_value"),
        clip(to_number(d, "probability"), 0.0, 100.0).alias("probability"),
        F.abs(to_number(d, "days_in_pipeline")).try_cast("int").alias("days_in_pipeline"),
        F.coalesce(to_number(d, "is_won").try_cast("int"), F.lit(0)).alias("is_won"),
        F.coalesce(to_number(d, "is_closed").try_cast("int"), F.lit(0)).alias("is_closed"),
        # what the repairs changed, for the per-rule DQ counts
        (~F.coalesce(stage.isin(VALID_STAGES), F.lit(False))).alias("_stage_repaired"),
        ((to_number(d, "probability") < 0) | (to_number(d, "probability") > 100)).alias("_prob_clipped"),
        (to_number(d, "days_in_pipeline") < 0).alias("_days_negative"),
        (to_number(d, "is_won").isNull() | to_number(d, "is_closed").isNull()).alias("_flag_defaulted"),
    )


def clean_opportunities(raw: DataFrame, unique: bool = False) -> DataFrame:
    """TR2: dedupe; coerce; clip probability; |days|; flags; stage repair; value > 0;
    closed rows need a close date; weighted value."""
    d = _coerce_opportunities(_first(raw, "opportunity_id", unique))
    d = d.filter(F.col("_value") > 0)
    d = d.filter(~((F.col("is_closed") == 1) & F.col("close_date").isNull()))
    return d.select(
        "opportunity_id", "rep_id", "product_id", "campaign_id", "created_date", "close_date", "stage",
        F.col("_value").alias("deal_value"),
        "probability", "days_in_pipeline", "is_won", "is_closed",
        rnd(F.col("_number") * F.col("probability") / F.lit(100.0), 2).alias("weighted_value"),
    )


def _any_null(*cols: str) -> Column:
    out = F.col(cols[0]).isNull()
    for c in cols[1:]:
        out = out | F.col(c).isNull()
    return out


def _rule_specs():
    """Per dataset: key, coercion, ordered drop rules (name, fails), repairs (name, flag)."""
    bad_value = ~F.coalesce(F.col("_value") > 0, F.lit(False))
    return {
        "reps": ("rep_id", lambda d: _coerce_reps(d, flags=True),
                 [("dropped_missing_required", _any_null("rep_id", "rep_name", "region", "territory"))],
                 [("repaired_invalid_hire_date", F.col("_hire_bad"))]),
        "opportunities": ("opportunity_id", _coerce_opportunities,
                          [("dropped_deal_value_not_positive", bad_value),
                           ("dropped_closed_without_close_date", (F.col("is_closed") == 1) & F.col("close_date").isNull())],
                          [("repaired_invalid_stage", F.col("_stage_repaired")),
                           ("repaired_probability_clipped", F.col("_prob_clipped")),
                           ("repaired_negative_days", F.col("_days_negative")),
                           ("repaired_missing_flag", F.col("_flag_defaulted"))]),
        "revenue": ("revenue_id", _coerce_revenue,
                    [("dropped_missing_required", _any_null("revenue_id", "rep_id", "_rev", "close_date")),
                     ("dropped_not_positive", ~(F.col("_rev") > 0))], []),
        "quotas": ("quota_id", _coerce_quotas,
                   [("dropped_missing_required", _any_null("quota_id", "rep_id", "month_year", "_q")),
                    ("dropped_not_positive", ~(F.col("_q") > 0))], []),
        "forecasts": ("forecast_id", _coerce_forecasts,
                      [("dropped_missing_required", _any_null("forecast_id", "rep_id", "month_year", "_f"))], []),
        "products": ("product_id", lambda d: d, [], []),
        "campaigns": ("campaign_id", lambda d: d, [], []),
    }


def dq_rule_counts(raws: Mapping[str, DataFrame], unique: Collection[str] = ()) -> DataFrame:
    """TR9 per rule: for every dataset, rows in, duplicates removed, rows dropped by each
    validity rule (in the order the rules apply), rows changed by each repair, rows out.
    Per dataset: one count of the raw rows and one aggregate over the deduplicated rows.
    ``unique`` names the datasets whose key is unique by construction."""
    parts = []
    for name, (key, coerce, drops, repairs) in _rule_specs().items():
        if name not in raws:
            continue
        raw = raws[name]
        n_in = raw.agg(F.count(F.lit(1)).alias("_in"))
        d = coerce(_first(raw, key, name in unique))
        alive = F.lit(True)
        aggs = [F.count(F.lit(1)).alias("_dedup")]
        for i, (_, fails) in enumerate(drops):
            fail = F.coalesce(fails, F.lit(True))
            aggs.append(F.count(F.when(alive & fail, 1)).alias(f"_d{i}"))
            alive = alive & ~fail
        aggs += [F.count(F.when(flag, 1)).alias(f"_r{i}") for i, (_, flag) in enumerate(repairs)]
        c = d.agg(*aggs)
        j = n_in.withColumn("_one", F.lit(1)).join(c.withColumn("_one", F.lit(1)), "_one")
        out_rows = F.col("_dedup")
        for i in range(len(drops)):
            out_rows = out_rows - F.col(f"_d{i}")
        rules = ([("rows_in", F.col("_in")), ("duplicates_removed", F.col("_in") - F.col("_dedup"))]
                 + [(r, F.col(f"_d{i}")) for i, (r, _) in enumerate(drops)]
                 + [(r, F.col(f"_r{i}")) for i, (r, _) in enumerate(repairs)]
                 + [("rows_out", out_rows)])
        arr = F.array(*[F.struct(F.lit(r).alias("rule"), v.cast("bigint").alias("rows")) for r, v in rules])
        parts.append(j.select(F.lit(name).alias("dataset"), F.explode(arr).alias("_r"))
                     .select("dataset", "_r.rule", "_r.rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _coerce_revenue(d: DataFrame) -> DataFrame:
    return d.select(
        _key(d, "revenue_id"), _key(d, "opportunity_id"), _key(d, "rep_id"), _key(d, "product_id"),
        to_date_lenient(d, "close_date").alias("close_date"),
        _money(to_number(d, "revenue")).alias("_rev"),
    )


def clean_revenue(raw: DataFrame, unique: bool = False) -> DataFrame:
    """TR3: dedupe; coerce; drop incomplete; revenue > 0; month_year recomputed from close_date."""
    d = _coerce_revenue(_first(raw, "revenue_id", unique))
    d = d.na.drop(subset=["revenue_id", "rep_id", "_rev", "close_date"]).filter(F.col("_rev") > 0)
    return d.select(
        "revenue_id", "opportunity_id", "rep_id", "product_id", "close_date",
        F.col("_rev").alias("revenue"),
        month_key("close_date").alias("month_year"),
    )


def _coerce_quotas(d: DataFrame) -> DataFrame:
    return d.select(_key(d, "quota_id"), _key(d, "rep_id"), to_text(d, "month_year").alias("month_year"),
                    _money(to_number(d, "quota_amount")).alias("_q"))


def clean_quotas(raw: DataFrame, unique: bool = False) -> DataFrame:
    """TR4: dedupe; coerce; drop incomplete; quota > 0."""
    d = _coerce_quotas(_first(raw, "quota_id", unique))
    d = d.na.drop(subset=["quota_id", "rep_id", "month_year", "_q"]).filter(F.col("_q") > 0)
    return d.select("quota_id", "rep_id", "month_year", F.col("_q").alias("quota_amount"))


def _coerce_forecasts(d: DataFrame) -> DataFrame:
    return d.select(_key(d, "forecast_id"), _key(d, "rep_id"), to_text(d, "month_year").alias("month_year"),
                    _money(to_number(d, "forecasted_rev")).alias("_f"),
                    to_date_lenient(d, "forecast_date").alias("forecast_date"))


def clean_forecasts(raw: DataFrame, unique: bool = False) -> DataFrame:
    """TR5: dedupe; coerce; drop incomplete (no positivity rule)."""
    d = _coerce_forecasts(_first(raw, "forecast_id", unique))
    d = d.na.drop(subset=["forecast_id", "rep_id", "month_year", "_f"])
    return d.select("forecast_id", "rep_id", "month_year", F.col("_f").alias("forecasted_rev"),
                    "forecast_date")


def clean_products(raw: DataFrame) -> DataFrame:
    """TR6: dedupe; coerce prices; margin_pct = round((unit − cost) / unit · 100, 2)."""
    d = _first(raw, "product_id")
    unit, cost = to_number(d, "unit_price"), to_number(d, "cost_price")
    return d.select(
        _key(d, "product_id"), to_text(d, "product_name").alias("product_name"),
        to_text(d, "category").alias("category"),
        _money(unit).alias("unit_price"), _money(cost).alias("cost_price"),
        rnd(safe_div(unit - cost, unit) * F.lit(100.0), 2).alias("margin_pct"),
    )


def clean_campaigns(raw: DataFrame) -> DataFrame:
    """TR7: dedupe; campaign_type upper-cased and trimmed."""
    d = _first(raw, "campaign_id")
    return d.select(_key(d, "campaign_id"), to_text(d, "campaign_name").alias("campaign_name"),
                    strip(F.upper(to_text(d, "campaign_type"))).alias("campaign_type"))


def dim_date(spark: SparkSession, start: str = "2023-01-01", end: str = "2024-12-31") -> DataFrame:
    """TR8: one row per day in [start, end] (ISO week, Monday = 0)."""
    s, e = _dt.date.fromisoformat(start), _dt.date.fromisoformat(end)
    days = spark.range(0, (e - s).days + 1).select(
        F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("d"))
    d = F.col("d")
    return days.select(
        F.date_format(d, "yyyy-MM-dd").alias("date_id"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week"),
        F.weekday(d).alias("day_of_week"),
        (F.weekday(d) < 5).cast("int").alias("is_weekday"),
    )


def dim_date_between(bounds: DataFrame) -> DataFrame:
    """TR8 over a span taken from data: ``bounds`` is one row with DATE columns start, end.

    The day list is generated from that single row; its length is the calendar span
    (a few thousand days), not the data volume.
    """
    days = bounds.select(F.explode(F.sequence(F.col("start"), F.col("end"))).alias("d"))
    d = F.col("d")
    return days.select(
        F.date_format(d, "yyyy-MM-dd").alias("date_id"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week"),
        F.weekday(d).alias("day_of_week"),
        (F.weekday(d) < 5).cast("int").alias("is_weekday"),
    )


def dq_row_counts(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """TR9: per dataset rows in, rows out, dropped — one aggregate over a tagged union."""
    parts = []
    for label, (before, after) in pairs.items():
        parts.append(before.select(F.lit(label).alias("label"), F.lit(1).alias("i"), F.lit(0).alias("o")))
        parts.append(after.select(F.lit(label).alias("label"), F.lit(0).alias("i"), F.lit(1).alias("o")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    g = u.groupBy("label").agg(F.sum("i").cast("bigint").alias("rows_in"), F.sum("o").cast("bigint").alias("rows_out"))
    return g.withColumn("dropped", F.col("rows_in") - F.col("rows_out"))


def _key_facts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per key space (the table whose primary key it is) and key: how often it is that table's key, how
    often each foreign key refers to it, and the nulls of the table's NOT NULL columns in its rows.

    Every table is read once; a row gives its own key and the keys it refers to. All of them meet in one
    shuffle after partial aggregation, so a key that a third of all rows refer to is one row a task.
    """
    width = max([len(_required(t)) for t in tables if t in PRIMARY_KEYS], default=0)
    refs = _references(tables)
    parts = []
    for t, pk in PRIMARY_KEYS.items():
        if t not in tables:
            continue
        nulls = [F.col(c).isNull().cast("int") for c in _required(t)]

        def fact(space: str, key: str, ref: int, flags: list[Column]) -> Column:
            flags = flags + [F.lit(0)] * (width - len(flags))
            return F.struct(F.lit(space).alias("space"), F.col(key).cast("string").alias("key"), F.lit(ref).alias("ref"),
                            *[f.alias(f"null_{i}") for i, f in enumerate(flags)])

        facts = [fact(t, pk, -1, nulls)]
        facts += [fact(parent, c, i, []) for i, (child, c, parent) in enumerate(refs) if child == t]
        parts.append(tables[t].select(F.inline(F.array(*facts))))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every.groupBy("space", "key").agg(
        F.sum((F.col("ref") < 0).cast("bigint")).alias("own"),
        *[F.sum((F.col("ref") == i).cast("bigint")).alias(f"ref_{i}") for i in range(len(refs))],
        *[F.sum(f"null_{i}").alias(f"null_{i}") for i in range(width)])


def _required(table: str) -> list[str]:
    return [PRIMARY_KEYS[table], *NOT_NULL.get(table, [])]


def _references(tables: Mapping[str, DataFrame]) -> list[tuple[str, str, str]]:
    """(child, column, parent) of the foreign keys between the tables given."""
    return [(child, c, parent) for child, c, parent, _ in FOREIGN_KEYS if child in tables and parent in tables]


def dq_constraints(tables: Mapping[str, DataFrame]) -> DataFrame:
    """TR10: violations of the declared PK / NOT NULL / FK constraints, per table and rule.

    Primary key: rows that share a key (null is one key). Foreign key: rows whose key, not null, is no key of the
    parent. All rules are answered by one aggregate over ``_key_facts``: one shuffle for all tables.
    """
    refs = _references(tables)

    def total(amount: str, where: Column) -> Column:
        return F.coalesce(F.sum(F.when(where, F.col(amount))), F.lit(0)).cast("bigint")

    rules = []
    for t, pk in PRIMARY_KEYS.items():
        if t not in tables:
            continue
        own = F.col("space") == t
        rules.append((t, "primary_key", pk, total("own", own & (F.col("own") > 1))))
        rules += [(t, "not_null", c, total(f"null_{i}", own)) for i, c in enumerate(_required(t))]
    for i, (child, c, parent) in enumerate(refs):
        lost = (F.col("space") == parent) & F.col("key").isNotNull() & (F.col("own") == 0)
        rules.append((child, "foreign_key", f"{c}->{parent}", total(f"ref_{i}", lost)))
    sums = _key_facts(tables).agg(*[amount.alias(f"rule_{i}") for i, (*_, amount) in enumerate(rules)])
    rows = [F.struct(F.lit(t).alias("table_name"), F.lit(rule).alias("rule"), F.lit(c).alias("column_name"),
                     F.col(f"rule_{i}").alias("violations")) for i, (t, rule, c, _) in enumerate(rules)]
    return sums.select(F.inline(F.array(*rows)))


def split_offenders(table: DataFrame, name: str, parents: Mapping[str, DataFrame]) -> DataFrame:
    """``table`` with a last column ``violates``: the constraints that a row breaks (empty: none), for writes that enforce.

    ``parents`` holds the tables that its foreign keys refer to; keys into others are not judged. All rows of a repeated primary
    key break it (null is one key), so the rows by constraint add up to what ``dq_constraints`` counts. Repeated keys and
    the keys of the parents are joined by their distinct values: a row is never repeated, and a hot key is one row there.
    """
    pk, columns = PRIMARY_KEYS[name], table.columns
    broken = [F.when(F.col(c).isNull(), F.lit(f"not_null:{c}")) for c in _required(name)]
    repeated = table.groupBy(F.col(pk).alias("_pk")).count().filter(F.col("count") > 1).select("_pk", F.lit(True).alias("_repeated"))
    out = table.join(small(repeated), F.col(pk).eqNullSafe(F.col("_pk")), "left")
    broken.append(F.when(F.col("_repeated"), F.lit(f"primary_key:{pk}")))
    for i, (c, parent) in enumerate((c, p) for child, c, p, _ in FOREIGN_KEYS if child == name and p in parents):
        keys = parents[parent].select(F.col(PRIMARY_KEYS[parent]).cast("string").alias(f"_key_{i}")).distinct()
        out = out.join(small(keys), F.col(c).cast("string") == F.col(f"_key_{i}"), "left")
        broken.append(F.when(F.col(c).isNotNull() & F.col(f"_key_{i}").isNull(), F.lit(f"foreign_key:{c}->{parent}")))
    return out.select(*columns, F.array_sort(F.array_compact(F.array(*broken))).alias("violates"))
