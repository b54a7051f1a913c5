"""Cleansing rules: the reference's unit cases plus the edge rows its code defines."""


from pyspark.sql import functions as F

from quotaloom.functions.exprs import title_case
from quotaloom.operators import clean

REPS = "rep_id string, rep_name string, region string, territory string, manager string, hire_date string"
OPPS = ("opportunity_id string, rep_id string, product_id string, campaign_id string, created_date string, "
        "close_date string, stage string, deal_value string, probability string, days_in_pipeline string, "
        "is_won string, is_closed string")
REV = "revenue_id string, opportunity_id string, rep_id string, product_id string, close_date string, revenue string, month_year string"


def _seq(df):
    """``df`` in one partition with its input order, as a landed file has it."""
    return df.coalesce(1).withColumn("_seq", F.monotonically_increasing_id())


def _opp(**kw):
    base = dict(opportunity_id="O001", rep_id="R001", product_id="P001", campaign_id="C001",
                created_date="2023-01-15", close_date="2023-03-01", stage="Closed Won", deal_value="10000",
                probability="100", days_in_pipeline="45", is_won="1", is_closed="1")
    base.update(kw)
    return tuple(base[k] for k in ["opportunity_id", "rep_id", "product_id", "campaign_id", "created_date",
                                   "close_date", "stage", "deal_value", "probability", "days_in_pipeline",
                                   "is_won", "is_closed"])


O2 = _opp(opportunity_id="O002", created_date="2023-02-10", close_date="2023-04-15", stage="Closed Lost",
          deal_value="8000", probability="0", days_in_pipeline="63", is_won="0")


def opps(spark, *rows):
    return clean.clean_opportunities(_seq(spark.createDataFrame(list(rows), OPPS)))


def test_reps_dedupe(spark):
    rows = [("R001", "Alice", "North", "NYC", "Mgr1", "2020-01-01")] * 2 + [("R002", "Bob", "South", "Texas", "Mgr2", "2021-06-15")]
    assert clean.clean_reps(_seq(spark.createDataFrame(rows, REPS))).count() == 2


def test_reps_null_id_dropped(spark):
    rows = [("R001", "Alice", "North", "NYC", "M", "2020-01-01"), (None, "Bob", "South", "Texas", "M", "2021-01-01")]
    assert clean.clean_reps(_seq(spark.createDataFrame(rows, REPS))).count() == 1


def test_reps_title_case(spark):
    rows = [("R001", "  alice smith ", "north", "mid-atlantic", "mgr", "2020-13-01")]
    r = clean.clean_reps(_seq(spark.createDataFrame(rows, REPS))).first()
    assert r.rep_name == "Alice Smith" and r.territory == "Mid-Atlantic" and r.region == "North"
    assert r.hire_date is None  # bad date → null, row kept


def test_title_case_rules(spark):
    df = spark.createDataFrame([("o'neil",), ("NYC metro",), ("3rd dds",)], "s string")
    got = [r[0] for r in df.select(title_case("s")).collect()]
    assert got == ["O'Neil", "Nyc Metro", "3Rd Dds"]


def test_negative_deal_dropped(spark):
    assert opps(spark, _opp(deal_value="-500"), O2).count() == 1


def test_closed_without_date_dropped(spark):
    ids = [r.opportunity_id for r in opps(spark, _opp(close_date=None), O2).collect()]
    assert "O001" not in ids


def test_invalid_stage_repaired(spark):
    r = opps(spark, _opp(stage="GARBAGE"), O2).filter("opportunity_id = 'O001'").first()
    assert r.stage == "Prospecting"


def test_null_stage_repaired(spark):
    r = opps(spark, _opp(stage=None)).first()
    assert r.stage == "Prospecting"


def test_weighted_value(spark):
    r = opps(spark, _opp(), O2).filter("opportunity_id = 'O001'").first()
    assert r.weighted_value == 10000.0


def test_probability_clipped(spark):
    hi = opps(spark, _opp(probability="150")).first()
    lo = opps(spark, _opp(probability="-5")).first()
    nul = opps(spark, _opp(probability=None)).first()
    assert hi.probability == 100.0 and lo.probability == 0.0
    assert nul.probability is None and nul.weighted_value is None


def test_days_abs_flags_and_text(spark):
    r = opps(spark, _opp(days_in_pipeline="-12", is_won=None, is_closed="1")).first()
    assert r.days_in_pipeline == 12 and r.is_won == 0
    assert opps(spark, _opp(deal_value="abc")).count() == 0
    assert opps(spark, _opp(deal_value="n/a")).count() == 0


def test_dedupe_before_rules(spark):
    # first copy invalid, second valid: both gone (dedupe keeps the first, then the rule drops it)
    df = spark.createDataFrame([_opp(deal_value="-1"), _opp()], OPPS).withColumn("_seq", F.monotonically_increasing_id())
    assert clean.clean_opportunities(df.coalesce(1)).count() == 0


def test_revenue_positive_only(spark):
    rows = [("REV001", "O001", "R001", "P001", "2023-03-01", "10000", "2023-03"),
            ("REV002", "O002", "R001", "P001", "2023-04-01", "0", "2023-04")]
    assert clean.clean_revenue(_seq(spark.createDataFrame(rows, REV))).count() == 1


def test_revenue_month_from_close_date(spark):
    rows = [("REV001", "O001", "R001", "P001", "2023-07-15", "5000", "2019-01")]
    assert clean.clean_revenue(_seq(spark.createDataFrame(rows, REV))).first().month_year == "2023-07"


def test_quotas_forecasts_products_campaigns(spark):
    q = spark.createDataFrame([("Q1", "R1", "2023-01", "100"), ("Q2", "R1", "2023-02", "-3"),
                               ("Q3", None, "2023-02", "5")], "quota_id string, rep_id string, month_year string, quota_amount string")
    assert clean.clean_quotas(_seq(q)).count() == 1
    f = spark.createDataFrame([("F1", "R1", "2023-01", "-50", "2022-12-01"), ("F2", "R1", "2023-02", None, None)],
                              "forecast_id string, rep_id string, month_year string, forecasted_rev string, forecast_date string")
    assert clean.clean_forecasts(_seq(f)).count() == 1  # negative forecast kept, missing value dropped
    p = spark.createDataFrame([("P1", "A", "S", "100", "25")], "product_id string, product_name string, category string, unit_price string, cost_price string")
    assert clean.clean_products(_seq(p)).first().margin_pct == 75.0
    c = spark.createDataFrame([("C1", "x", " a "), ("C1", "y", "b")], "campaign_id string, campaign_name string, campaign_type string")
    assert [r.campaign_type for r in clean.clean_campaigns(_seq(c)).collect()] == ["A"]


def test_dim_date(spark):
    assert clean.dim_date(spark, "2023-01-01", "2023-12-31").count() == 365
    mon = clean.dim_date(spark, "2023-01-02", "2023-01-02").first()
    sat = clean.dim_date(spark, "2023-01-07", "2023-01-07").first()
    assert mon.is_weekday == 1 and mon.day_of_week == 0 and sat.is_weekday == 0
    jan1 = clean.dim_date(spark, "2023-01-01", "2023-01-01").first()
    assert jan1.week == 52 and jan1.month_name == "January"


def test_dq_constraints_and_counts(spark):
    reps = spark.createDataFrame([("R1", "A", "N", "T"), ("R1", "B", "N", "T")], "rep_id string, rep_name string, region string, territory string")
    facts = spark.createDataFrame([("O1", "R9")], "opportunity_id string, rep_id string")
    v = {(r.table_name, r.rule, r.column_name): r.violations for r in
         clean.dq_constraints({"dim_reps": reps, "fact_opportunities": facts}).collect()}
    assert v[("dim_reps", "primary_key", "rep_id")] == 2
    assert v[("fact_opportunities", "foreign_key", "rep_id->dim_reps")] == 1
    c = clean.dq_row_counts({"reps": (reps, reps.limit(1))}).first()
    assert (c.rows_in, c.rows_out, c.dropped) == (2, 1, 1)


def test_offenders_add_up_to_the_counted_violations(spark):
    reps = spark.createDataFrame([("R1", "A", "N", "T"), ("R2", None, "N", "T"), ("R2", "B", "N", "T"), (None, "C", None, "T")],
                                 "rep_id string, rep_name string, region string, territory string")
    facts = spark.createDataFrame([("O1", "R9"), ("O2", "R1"), ("O2", None), (None, "R2"), (None, "R9"), ("O3", "R9")],
                                  "opportunity_id string, rep_id string")
    tables = {"dim_reps": reps, "fact_opportunities": facts}
    counted = {(r.table_name, f"{r.rule}:{r.column_name}"): r.violations for r in clean.dq_constraints(tables).collect()}
    assert counted[("fact_opportunities", "foreign_key:rep_id->dim_reps")] == 3
    assert counted[("fact_opportunities", "primary_key:opportunity_id")] == 4
    assert counted[("dim_reps", "not_null:rep_name")] == 1 and counted[("dim_reps", "not_null:rep_id")] == 1
    for name, table in tables.items():
        judged = clean.split_offenders(table, name, tables).collect()
        assert len(judged) == table.count()
        for (t, rule), n in counted.items():
            if t == name:
                assert sum(rule in r.violates for r in judged) == n, rule
    clean_rows = [r for r in clean.split_offenders(facts, "fact_opportunities", tables).collect() if not r.violates]
    assert clean_rows == []


def test_constraints_of_empty_tables_are_zero(spark):
    reps = spark.createDataFrame([], "rep_id string, rep_name string, region string, territory string")
    quotas = spark.createDataFrame([], "quota_id string, rep_id string, month_year string")
    rows = clean.dq_constraints({"dim_reps": reps, "fact_quotas": quotas}).collect()
    assert len(rows) == 9 and {r.violations for r in rows} == {0}


def test_constraints_meet_in_one_shuffle(spark):
    reps = spark.createDataFrame([("R1", "A", "N", "T")], "rep_id string, rep_name string, region string, territory string")
    facts = spark.createDataFrame([("O1", "R9")], "opportunity_id string, rep_id string")
    plan = clean.dq_constraints({"dim_reps": reps, "fact_opportunities": facts})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan and "SortAggregate" not in plan


def test_rows_are_numbered_in_order_over_many_partitions(spark):
    from quotaloom.functions.numbering import number_rows
    from quotaloom.operators.derive import number_bookings

    shuffled = spark.range(0, 20_011).select((F.col("id") * 7919 % 20_011).alias("k")).repartition(13)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows are one partition
    try:
        got = number_rows(shuffled, ["k"], "n")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got.rdd.getNumPartitions() > 1
    assert got.count() == 20_011 and got.filter("n <> k + 1").count() == 0
    hot = spark.createDataFrame([(None,)] * 3 + [(5,)] * 50 + [(1,)], "k int")
    numbers = {(r.k, r.n) for r in number_rows(hot, ["k"], "n").collect()}
    assert {n for _, n in numbers} == set(range(1, 55)) and (1, 4) in numbers and (None, 1) in numbers
    assert number_rows(hot.limit(0), ["k"], "n").count() == 0
    ids = number_bookings(spark.createDataFrame([("O2", "x"), ("O1", "y")], "opportunity_id string, revenue_id string")).collect()
    assert {(r.opportunity_id, r.revenue_id) for r in ids} == {("O1", "REV0001"), ("O2", "REV0002")}
