"""The operators bound to the driver's tables, each next to the SQL that states the expected result.

orders, customer and lineitem stand in for admissions, patients and stays; events for timed measurements.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cohortspark.functions import columns as names
from cohortspark.functions.ordered import dense_rank_by, plan_slices
from cohortspark.functions.quantiles import fit_medians
from cohortspark.functions.scalars import item_class, log10_between, parse_ids
from cohortspark.functions.skew import HOT_ROWS, hot_keys
from cohortspark.functions.time import elapsed_hours
from cohortspark.operators import cohort, comparison, encoding, logistic, measurements, modelling, relational, summaries, timetable
from cohortspark.plans import clinical, rules, summary
from cohortspark.session import configure, inline, settle, shared_folder
from cohortspark.sources.sinks import save_bucketed
from cohortspark.sources.tables import load

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name together with its expected result."""

    def add(fn: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(configure(spark), folder)

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison, since float sums depend on the order of the rows. Plain arithmetic: the built-in
    rounding of doubles goes through decimal text and would cost more than many of the queries."""
    doubles = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    scale = float(10**digits)

    def near(c: str) -> Column:
        return F.signum(c) * F.floor(F.abs(F.col(c)) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)

    return df.select(*[near(c).alias(c) if c in doubles else F.col(c) for c in df.columns])


def h(start: str, end: str) -> str:
    """SQL for hours from start to end."""
    return f"((epoch_us({end}) - epoch_us({start})) / 1e6 / 3600)"


# --- bindings -------------------------------------------------------------------------------------------------------
TYPES = ["click", "error", "purchase", "signup", "view"]
AGGS = {t: "sum" if t == "purchase" else "avg" for t in TYPES}
SPANS_SQL = "spans AS (SELECT user_id, min(ts) AS start_ts, max(ts) AS end_ts FROM events GROUP BY user_id)"
PIVOT_SQL = f"""{SPANS_SQL},
aligned AS (SELECT e.user_id, e.ts, e.event_id, e.event_type, e.value, {h('start_ts', 'ts')} AS t_since,
                   {h('ts', 'end_ts')} AS t_til
            FROM events e LEFT JOIN spans USING (user_id)),
once AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, t_since, event_type ORDER BY event_id) AS rn
                        FROM aligned) WHERE rn = 1),
wide AS (SELECT user_id, ts, t_since, t_til,
                {', '.join(f"sum(CASE WHEN event_type = '{t}' THEN value END) AS {t}" for t in TYPES)}
         FROM once GROUP BY user_id, ts, t_since, t_til)"""


def spans(ev: DataFrame) -> DataFrame:
    return ev.groupBy("user_id").agg(F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"))


def aligned_events(ev: DataFrame, keep_bounds: bool = False) -> DataFrame:
    hot = hot_keys(ev, ["user_id"], rows=ev.count())
    return measurements.align_events(
        ev, settle(spans(ev)), None, key="user_id", time="ts", start="start_ts", end="end_ts", unique=True, keep_bounds=keep_bounds, hot=hot
    )


def wide_events(ev: DataFrame, keep_bounds: bool = False) -> DataFrame:
    rows = aligned_events(ev.select("event_id", "ts", "user_id", "event_type", "value"), keep_bounds)
    carried = ("t_since", "t_til", *(("start_ts", "end_ts") if keep_bounds else ()))
    return timetable.pivot_features(rows, TYPES, "user_id", "ts", None, carried, "event_type", "value", ["event_id"])


def bucketed(spark: SparkSession, folder: str, width_s: int) -> DataFrame:
    wide = wide_events(load(spark, folder, "events"), keep_bounds=True)
    return rounded(timetable.bucketize(wide, width_s, AGGS, ["user_id"], "ts", start="start_ts", end="end_ts"))


def bucket_sql(width_s: int) -> str:
    cells = ", ".join(f"{how}({t}) AS {t}" for t, how in AGGS.items())
    return f"""WITH {PIVOT_SQL},
b AS (SELECT CAST(round_even(epoch_us(ts) / 1e6 / {width_s}, 0) AS BIGINT) AS bucket, user_id, {cells}
      FROM wide GROUP BY 1, 2),
t AS (SELECT TIMESTAMP '1970-01-01' + to_seconds(bucket * {width_s}) AS ts, * EXCLUDE (bucket) FROM b)
SELECT t.ts, t.user_id, {', '.join(f'round({c}, 6) AS {c}' for c in TYPES)},
       round({h('start_ts', 't.ts')}, 6) AS t_since, round({h('t.ts', 'end_ts')}, 6) AS t_til
FROM t LEFT JOIN spans USING (user_id)"""


BORN = "TIMESTAMP '1990-01-01' + to_days(c_nationkey * 365)"
DIED = "CASE WHEN c_acctbal < 0 THEN TIMESTAMP '1998-01-01' + to_days(c_nationkey * 30) END"
HOSPITAL_SQL = f"""pat AS (SELECT c_custkey AS subject_id, {BORN} AS dob, {DIED} AS dod FROM customer),
adm AS (SELECT o_orderkey AS hadm_id, o_custkey AS subject_id, o_orderdate AS admittime,
               o_orderdate + to_days(10) AS dischtime FROM orders),
stay AS (SELECT l_orderkey * 10 + l_linenumber AS icustay_id, l_orderkey AS hadm_id, l_shipdate AS intime,
                l_shipdate + to_hours(CAST(l_quantity AS BIGINT)) AS outtime FROM lineitem),
serv AS (SELECT l_orderkey AS hadm_id, l_returnflag || l_linestatus AS curr_service FROM lineitem)"""
AGE_SQL = "((epoch_us(admittime) - epoch_us(dob)) / 1e6 / 86400 / 365.242)"
COHORT_SQL = f"cohort AS (SELECT hadm_id FROM adm JOIN pat USING (subject_id) WHERE {AGE_SQL} < 8)"


def days(n: Column) -> Column:
    return F.make_dt_interval(n)


def at(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def hospital(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """patients, admissions, icustays and services read off customer, orders and lineitem."""
    c, o, li = (load(spark, folder, t) for t in ("customer", "orders", "lineitem"))
    patients = c.select(
        F.col("c_custkey").alias("subject_id"),
        F.col("c_mktsegment").alias("gender"),
        (at("1990-01-01") + days(F.col("c_nationkey") * 365)).alias("dob"),
        F.when(F.col("c_acctbal") < 0, at("1998-01-01") + days(F.col("c_nationkey") * 30)).alias("dod"),
        *[F.lit(None).cast("timestamp_ntz").alias(n) for n in ("dod_hosp", "dod_ssn")],
        F.lit(None).cast("int").alias("expire_flag"),
    )
    admissions = o.select(
        F.col("o_orderkey").alias("hadm_id"),
        F.col("o_custkey").alias("subject_id"),
        F.col("o_orderdate").alias("admittime"),
        (F.col("o_orderdate") + days(F.lit(10))).alias("dischtime"),
        F.col("o_orderpriority").alias("admission_type"),
        *[
            F.lit(None).cast("string").alias(n)
            for n in cohort.ADMISSION_COLUMNS
            if n not in ("hadm_id", "subject_id", "admittime", "dischtime", "admission_type")
        ],
    )
    stays = li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("icustay_id"),
        F.col("l_orderkey").alias("hadm_id"),
        F.col("l_shipdate").alias("intime"),
        (F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.col("l_quantity").cast("int"))).alias("outtime"),
        *[F.lit(None).cast("string").alias(n) for n in cohort.STAY_COLUMNS if n not in ("icustay_id", "intime", "outtime")],
    )
    services = li.select(F.col("l_orderkey").alias("hadm_id"), F.concat("l_returnflag", "l_linestatus").alias("curr_service"))
    return {"patients": patients, "admissions": admissions, "icustays": stays, "services": services}


# --- cohort and context ---------------------------------------------------------------------------------------------
@query(f"WITH {HOSPITAL_SQL}, {COHORT_SQL} SELECT hadm_id FROM cohort")
def cohort_elapsed_filter(spark, folder):
    t = hospital(spark, folder)
    return cohort.select_cohort(t["patients"], t["admissions"], 8)


@query(
    f"""WITH {HOSPITAL_SQL}, first AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY subject_id
ORDER BY admittime, hadm_id) AS rn FROM adm) WHERE rn = 1)
SELECT hadm_id FROM first JOIN pat USING (subject_id) WHERE {AGE_SQL} < 8
AND hadm_id IN (SELECT hadm_id FROM serv WHERE curr_service IN ('AF', 'RO')) AND hadm_id IN (SELECT hadm_id FROM stay)"""
)
def cohort_options(spark, folder):
    t = hospital(spark, folder)
    return cohort.select_cohort(t["patients"], t["admissions"], 8, True, t["services"], ("AF", "RO"), t["icustays"])


@query(
    """SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM (SELECT *, row_number() OVER
(PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1"""
)
def cohort_first_event(spark, folder):
    o = load(spark, folder, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"])
    return relational.first_per(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query(
    """SELECT l_orderkey AS hadm_id FROM lineitem WHERE l_returnflag IN ('A', 'R')
INTERSECT SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'"""
)
def cohort_intersect(spark, folder):
    li, o = load(spark, folder, "lineitem"), load(spark, folder, "orders")
    services = li.select(F.col("l_orderkey").alias("hadm_id"), F.col("l_returnflag").alias("curr_service"))
    stays = o.filter(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("hadm_id"))
    return cohort.cohort_intersect(services, stays, ("A", "R"))


CONTEXT_COLUMNS = [
    "icustay_id", "hadm_id", "subject_id", "ser_ind", "age_at_death", "age_at_adm", "los_total", "died", "died_inhouse",
    "icu_rank", "adm_rank",
]


def context_sql(keep: bool) -> str:
    own = ", CASE WHEN icustay_id IS NULL THEN hadm_id END" if keep else ""
    return f"""WITH {HOSPITAL_SQL}, {COHORT_SQL},
weighted AS (SELECT hadm_id, CASE curr_service WHEN 'AF' THEN 1 WHEN 'RO' THEN 2 ELSE 0 END AS w FROM serv),
ind AS (SELECT hadm_id, CAST(sum(w) AS BIGINT) AS ser_ind FROM weighted WHERE w > 0 GROUP BY hadm_id),
joined AS (SELECT * FROM adm LEFT JOIN pat USING (subject_id) LEFT JOIN stay USING (hadm_id) LEFT JOIN ind USING (hadm_id)
           WHERE hadm_id IN (SELECT hadm_id FROM cohort)),
ranked AS (SELECT *, dense_rank() OVER (PARTITION BY hadm_id ORDER BY intime) AS icu_rank,
                  dense_rank() OVER (PARTITION BY subject_id ORDER BY admittime) AS adm_rank FROM joined),
one AS (SELECT *, row_number() OVER (PARTITION BY icustay_id{own} ORDER BY hadm_id, intime, outtime) AS rn FROM ranked)
SELECT icustay_id, hadm_id, subject_id, ser_ind,
       round((epoch_us(dod) - epoch_us(dob)) / 1e6 / 86400 / 365.242, 6) AS age_at_death, round({AGE_SQL}, 6) AS age_at_adm,
       round((epoch_us(outtime) - epoch_us(intime)) / 1e6 / 86400, 6) AS los_total,
       CASE WHEN dod IS NOT NULL THEN 1 ELSE 0 END AS died,
       CASE WHEN dod - dischtime < INTERVAL 30 DAYS THEN 1 ELSE 0 END AS died_inhouse,
       CAST(icu_rank AS INTEGER) AS icu_rank, CAST(adm_rank AS INTEGER) AS adm_rank FROM one WHERE rn = 1"""


def _context(spark, folder, keep):
    t = hospital(spark, folder)
    return cohort.build_context(
        t["patients"], t["admissions"], t["icustays"], t["services"],
        cohort.select_cohort(t["patients"], t["admissions"], 8), {"AF": 1, "RO": 2}, keep_no_stay=keep,
    )


@query(context_sql(False))
def context_row(spark, folder):
    return rounded(_context(spark, folder, False).select(*CONTEXT_COLUMNS))


@query(context_sql(True))
def context_row_keep_no_stay(spark, folder):
    return rounded(_context(spark, folder, True).select(*CONTEXT_COLUMNS))


@query(
    """SELECT o_orderkey, o_custkey, CAST(dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate NULLS LAST) AS INTEGER)
AS adm_rank FROM orders"""
)
def admission_rank(spark, folder):
    o = load(spark, folder, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    ranked = dense_rank_by(o, ["o_custkey"], "o_orderdate", "adm_rank", plan_slices(o, ["o_custkey"], "o_orderdate", rows=o.count()))
    return ranked.select("o_orderkey", "o_custkey", "adm_rank")


@query(
    """SELECT o_orderkey, CAST(coalesce(max(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END), 0) AS INTEGER) AS a,
CAST(coalesce(max(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END), 0) AS INTEGER) AS n,
CAST(coalesce(max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END), 0) AS INTEGER) AS r
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey"""
)
def membership_flags(spark, folder):
    members = load(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_returnflag")
    return cohort.one_hot_membership(load(spark, folder, "orders", ["o_orderkey"]), members, "o_orderkey", "l_returnflag")


@query(
    """SELECT o_orderkey,
CAST(coalesce(max(CASE WHEN code LIKE 'PROMO%' OR code LIKE 'SMALL/Brand#1%' THEN 1 ELSE 0 END), 0) AS INTEGER) AS has_promo,
CAST(coalesce(max(CASE WHEN code IN ('LARGE/Brand#5') THEN 1 ELSE 0 END), 0) AS INTEGER) AS has_large5
FROM orders LEFT JOIN (SELECT l_orderkey, p_type || '/' || p_brand AS code FROM lineitem JOIN part ON p_partkey = l_partkey)
ON l_orderkey = o_orderkey GROUP BY o_orderkey"""
)
def code_prefix_flags(spark, folder):
    part = load(spark, folder, "part").select("p_partkey", F.concat_ws("/", "p_type", "p_brand").alias("code"))
    li = load(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("p_partkey"))
    diagnoses = li.join(part, "p_partkey").select("o_orderkey", "code")
    flags = {"has_promo": (["PROMO", "SMALL/Brand#1"], []), "has_large5": ([], ["LARGE/Brand#5"])}
    ctx = load(spark, folder, "orders", ["o_orderkey"])
    return cohort.code_flags(ctx, diagnoses, flags, "o_orderkey", "code", part.select("code").distinct())


@query(
    f"""WITH {HOSPITAL_SQL} SELECT hadm_id, icustay_id, intime,
round({h('dob', 'admittime')}, 6) AS age_at_admission_h, round({h('admittime', 'intime')}, 6) AS adm_to_icu_h,
round({h('intime', 'outtime')}, 6) AS icu_los_h, round({h('admittime', 'dischtime')}, 6) AS hosp_los_h,
round({h('dob', 'dod')}, 6) AS age_at_death_h FROM adm JOIN pat USING (subject_id) JOIN stay USING (hadm_id)"""
)
def durations(spark, folder):
    t = hospital(spark, folder)
    rows = t["admissions"].join(t["patients"].select("subject_id", "dob", "dod"), "subject_id")
    rows = rows.join(t["icustays"].select("hadm_id", "icustay_id", "intime", "outtime"), "hadm_id")
    kept = ["hadm_id", "icustay_id", "intime", "dob", "dod", "admittime", "dischtime", "outtime"]
    return rounded(cohort.duration_features(rows.select(*kept)).drop(*kept[3:]))


@query(
    """SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'vehicle' WHEN 'MACHINERY' THEN 'tool' ELSE c_mktsegment END
AS c_mktsegment, CASE c_nationkey WHEN 1 THEN 'one' ELSE 'other' END AS nation FROM customer"""
)
def remap_segments(spark, folder):
    c = load(spark, folder, "customer").select("c_custkey", "c_mktsegment", F.col("c_nationkey").cast("string").alias("nation"))
    schema = "category string, remap0 string"
    segments = inline(spark, [("AUTOMOBILE", "vehicle"), ("MACHINERY", "tool"), ("DEFAULT", "other")], schema)
    remapped = cohort.remap_categories(c, {"c_mktsegment": segments})
    return relational.remap(remapped, "nation", inline(spark, [("1", "one")], schema), default="other")


# --- measurements ---------------------------------------------------------------------------------------------------
@query(
    """SELECT DISTINCT source, itemid FROM (
SELECT 'returned' AS source, CAST(l_partkey AS VARCHAR) AS itemid, l_orderkey FROM lineitem WHERE l_returnflag = 'R'
UNION ALL SELECT 'returned', CAST(l_partkey AS VARCHAR), l_orderkey FROM lineitem WHERE l_returnflag = 'A' AND l_quantity BETWEEN 10 AND 20
UNION ALL SELECT 'open', CAST(l_partkey AS VARCHAR), l_orderkey FROM lineitem WHERE l_linestatus = 'O'
UNION ALL SELECT 'composite', '{' || l_suppkey || ', ' || l_linenumber || ', ' || l_returnflag || '}', l_orderkey FROM lineitem)
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')"""
)
def item_inventory(spark, folder):
    li = load(spark, folder, "lineitem")
    admitted = load(spark, folder, "orders").filter(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("l_orderkey"))
    sources = [
        measurements.Source("returned", li, "l_partkey", F.col("l_returnflag") == "R"),
        measurements.Source("returned", li, "l_partkey", (F.col("l_returnflag") == "A") & F.col("l_quantity").between(10, 20)),
        measurements.Source("open", li, "l_partkey", F.col("l_linestatus") == "O"),
        measurements.Source("composite", li, F.struct("l_suppkey", "l_linenumber", "l_returnflag")),
    ]
    return measurements.item_inventory(sources, admitted, "l_orderkey")


@query(
    """SELECT DISTINCT event_id, ts, user_id, event_type, value, CAST(value AS DOUBLE) AS valuenum FROM events
WHERE event_type IN ('click', 'purchase') AND user_id IN (SELECT user_id FROM events WHERE event_type = 'signup' AND value > 50)"""
)
def event_filter(spark, folder):
    ev = load(spark, folder, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    members = ev.filter((F.col("event_type") == "signup") & (F.col("value") > 50)).select("user_id")
    items = inline(spark, [("click",), ("purchase",)], "event_type string")
    hot = hot_keys(ev, ["user_id"], rows=ev.count())
    return measurements.filter_events(ev, members, items, "user_id", "event_type", "value", hot=hot)


@query(
    """WITH b AS (SELECT avg(value) - 3 * stddev_samp(value) AS lo, avg(value) + 3 * stddev_samp(value) AS hi FROM events
WHERE event_type IN ('click', 'view'))
SELECT event_id, event_type, value FROM events, b WHERE event_type NOT IN ('click', 'view') OR value BETWEEN lo AND hi"""
)
def sigma_outliers(spark, folder):
    ev = load(spark, folder, "events", ["event_id", "event_type", "value"])
    return measurements.drop_sigma_outliers(ev, ["click", "view"], 3.0, "event_type", "value")


HOLES_SQL = "SELECT event_id, event_type, CASE WHEN event_type <> 'error' OR value > 20 THEN value END AS value FROM events"


def with_holes(spark: SparkSession, folder: str) -> DataFrame:
    """events with low error values blanked, so unknown values take part."""
    ev = load(spark, folder, "events")
    known = (F.col("event_type") != "error") | (F.col("value") > 20)
    return ev.select("event_id", "event_type", F.when(known, F.col("value")).alias("value"))


@query(
    f"""SELECT * FROM ({HOLES_SQL}) WHERE NOT coalesce((event_type IN ('click', 'view') AND value > 100)
OR (event_type = 'purchase' AND value < 1) OR (event_type = 'error' AND value = 25) OR value > 400, FALSE)"""
)
def rule_clean(spark, folder):
    drops = [
        measurements.DropRule(("click", "view"), "gt", 100),
        measurements.DropRule(("purchase",), "lt", 1),
        measurements.DropRule(("error",), "eq", 25),
        measurements.DropRule(None, "gt", 400),
    ]
    return measurements.apply_rules(with_holes(spark, folder), drops, "event_type", "value")


@query(
    f"""SELECT event_id, event_type, round(CASE WHEN event_type = 'signup' THEN (value - 32) * 5 / 9
WHEN event_type = 'error' AND value > 30 THEN value * 0.05847953216374269 ELSE value END, 6) AS value FROM ({HOLES_SQL})"""
)
def unit_fix(spark, folder):
    fixes = [
        measurements.UnitFix(("signup",), 5 / 9, shift=-32.0),
        measurements.UnitFix(("error",), 0.05847953216374269, above=30),
    ]
    return rounded(measurements.apply_unit_fixes(with_holes(spark, folder), fixes, "event_type", "value"))


@query(
    f"""WITH e AS ({HOLES_SQL}), edited AS (SELECT event_id, event_type,
CASE WHEN event_type = 'view' AND value > 10 THEN value / 2 ELSE value END AS value FROM e
WHERE NOT coalesce(value > 200, FALSE))
SELECT event_id, event_type, coalesce(value, -1) AS value, CASE WHEN value < 5 THEN 1 END AS low,
value + CASE WHEN event_type = 'click' THEN 1 END AS total FROM edited"""
)
def conditional_edits(spark, folder):
    rows = relational.delete_where(with_holes(spark, folder), F.col("value") > 200)
    rows = relational.update_where(rows, (F.col("event_type") == "view") & (F.col("value") > 10), "value", F.col("value") / 2)
    rows = relational.flag_where(rows, F.col("value") < 5, "low")
    rows = rows.withColumn("total", F.col("value") + F.when(F.col("event_type") == "click", F.lit(1)))
    return relational.fill_constant(rows, {"value": -1.0})


@query(
    """WITH s AS (SELECT avg(l_quantity) AS mq, stddev_samp(l_quantity) AS sq, avg(l_extendedprice) AS mp,
stddev_samp(l_extendedprice) AS sp FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN abs(l_quantity - mq) <= 1.5 * sq THEN l_quantity END AS l_quantity,
CASE WHEN abs(l_extendedprice - mp) <= 1.5 * sp THEN l_extendedprice END AS l_extendedprice FROM lineitem, s"""
)
def mask_outliers(spark, folder):
    li = load(spark, folder, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"])
    return relational.mask_outliers(li, ["l_quantity", "l_extendedprice"], 1.5)


UNITS_SQL = """counts AS (SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL),
best AS (SELECT l_suppkey, l_returnflag AS unit FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC,
l_returnflag) AS rn, count(*) OVER (PARTITION BY l_suppkey) AS units FROM counts) WHERE rn = 1 AND units > 1)"""


@query(f"WITH {UNITS_SQL} SELECT l_suppkey, unit AS l_returnflag FROM best")
def dominant_unit(spark, folder):
    li = load(spark, folder, "lineitem")
    halves = [li.filter(F.col("l_linestatus") == s) for s in ("O", "F")]
    return measurements.dominant_unit(halves, "l_suppkey", "l_returnflag")


@query(
    f"""WITH {UNITS_SQL} SELECT l_orderkey, l_linenumber, l_suppkey, l_returnflag,
CASE WHEN l_returnflag <> unit THEN 1 END AS todelete FROM lineitem LEFT JOIN best USING (l_suppkey)"""
)
def unit_mismatch(spark, folder):
    li = load(spark, folder, "lineitem", ["l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag"])
    units = measurements.dominant_unit([li], "l_suppkey", "l_returnflag")
    return measurements.flag_unit_mismatch(li, units, "l_suppkey", "l_returnflag")


LIMITS = [
    ("click", 1, 0.5, 2.0, 40.0, 100.0),
    ("view", 1, 9.0, 9.0, 9.0, 9.0),
    ("error", 2, None, 1.0, None, 150.0),
    ("purchase", 3, 0.1, None, 25.0, None),
    ("swipe", 4, 0.0, 1.0, 2.0, 3.0),
]


def _limit(v) -> str:
    return "CAST(NULL AS DOUBLE)" if v is None else f"CAST({v} AS DOUBLE)"


@query(
    f"""WITH r AS (SELECT * FROM (VALUES {', '.join(f"('{i}', {n}, {_limit(a)}, {_limit(b)}, {_limit(c)}, {_limit(d)})"
                                                       for i, n, a, b, c, d in LIMITS)}) t(event_type, nitemid, ol, vl, vh, oh)),
g AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY nitemid ORDER BY event_type) AS rn FROM r) WHERE rn = 1),
s AS (SELECT g.nitemid, min(value) AS mn, max(value) AS mx, avg(value) AS av, count(*) AS cnt,
sum(CASE WHEN value < g.ol THEN 1 ELSE 0 END) / count(*) AS a, sum(CASE WHEN value < g.vl THEN 1 ELSE 0 END) / count(*) AS b,
sum(CASE WHEN value > g.oh THEN 1 ELSE 0 END) / count(*) AS c, sum(CASE WHEN value > g.vh THEN 1 ELSE 0 END) / count(*) AS d
FROM events JOIN r USING (event_type) JOIN g ON g.nitemid = r.nitemid GROUP BY g.nitemid)
SELECT CAST(g.nitemid AS BIGINT) AS nitemid, coalesce(mn, 0) AS min, coalesce(mx, 0) AS max, round(coalesce(av, 0), 6) AS avg,
coalesce(cnt, 0) AS cnt, round(coalesce(a, 0), 6) AS out_low_per, round(coalesce(b, 0), 6) AS val_low_per,
round(coalesce(c, 0), 6) AS out_high_per, round(coalesce(d, 0), 6) AS val_high_per FROM g LEFT JOIN s ON s.nitemid = g.nitemid"""
)
def range_report(spark, folder):
    schema = "event_type string, nitemid bigint, outlier_low double, valid_low double, valid_high double, outlier_high double"
    ranges = inline(spark, LIMITS, schema)
    return rounded(measurements.range_report(load(spark, folder, "events"), ranges, "event_type", "nitemid", "value"))


# --- time -----------------------------------------------------------------------------------------------------------
@query(
    f"""WITH {SPANS_SQL} SELECT event_id, user_id, ts, event_type, round({h('start_ts', 'ts')}, 6) AS t_since,
round({h('ts', 'end_ts')}, 6) AS t_til FROM events LEFT JOIN spans USING (user_id)"""
)
def align_events(spark, folder):
    return rounded(aligned_events(load(spark, folder, "events", ["event_id", "user_id", "ts", "event_type"])))


@query(
    f"""WITH {PIVOT_SQL} SELECT user_id, ts, round(t_since, 6) AS t_since, round(t_til, 6) AS t_til, {', '.join(TYPES)}
FROM wide WHERE NOT coalesce(t_til < 0 OR t_since < 0, FALSE)"""
)
def feature_pivot(spark, folder):
    return rounded(wide_events(load(spark, folder, "events")))


@query(bucket_sql(1800))
def bucket_30min(spark, folder):
    return bucketed(spark, folder, 1800)


@query(bucket_sql(86400))
def bucket_day(spark, folder):
    return bucketed(spark, folder, 86400)


STAY_SQL = f"""e AS (SELECT user_id, date_trunc('day', ts) AS ts, event_type, CASE WHEN event_id % 4 <> 0 THEN event_id % 4 END AS stay,
  event_id % 2 AS origin, event_id, CASE WHEN event_id % 7 <> 0 THEN value END AS value FROM events),
aligned AS (SELECT e.*, {h('start_ts', 'e.ts')} AS t_since, {h('e.ts', 'end_ts')} AS t_til FROM e JOIN spans USING (user_id)),
kept AS (SELECT * FROM aligned WHERE t_since >= 0 AND t_til >= 0)"""


def stay_pivot_sql(order: str, parts: str) -> str:
    cells = ", ".join(f"round(sum(value) FILTER (event_type = '{t}'), 6) AS {t}" for t in TYPES)
    return f"""WITH {SPANS_SQL}, {STAY_SQL},
once AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, ts, event_type{parts} ORDER BY {order}) AS rn FROM kept) WHERE rn = 1)
SELECT user_id, stay, ts, round(min(t_since), 6) AS t_since, round(min(t_til), 6) AS t_til, {cells} FROM once GROUP BY user_id, stay, ts"""


def stay_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events by day, three of four with a stay, from two sources, some without a value, with hours since start and until end."""
    ev = load(spark, folder, "events")
    spanned = settle(spans(ev))
    rows = ev.select(
        "user_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("ts"), "event_type", F.when(F.col("event_id") % 4 != 0, F.col("event_id") % 4).alias("stay"),
        (F.col("event_id") % 2).alias("origin"), "event_id", F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value"),
    )
    hot = hot_keys(ev, ["user_id"], rows=ev.count())
    return measurements.align_events(rows, spanned, None, key="user_id", time="ts", start="start_ts", end="end_ts", unique=True, hot=hot)


@query(stay_pivot_sql("stay NULLS LAST, value NULLS LAST", ", origin"))
def feature_pivot_stay(spark, folder):
    """The preset's form: the lowest stay and value within each source, sources added up."""
    wide = timetable.pivot_features(
        stay_events(spark, folder), TYPES, "user_id", "ts", "stay", feature="event_type", value="value", within=("origin", [0, 1])
    )
    return rounded(wide)


@query(stay_pivot_sql("origin, event_id, stay NULLS LAST, value NULLS LAST", ""))
def feature_pivot_tie(spark, folder):
    """Several tie columns decide which of the rows of a time counts, and with it the stay."""
    wide = timetable.pivot_features(
        stay_events(spark, folder), TYPES, "user_id", "ts", "stay", feature="event_type", value="value", tie=["origin", "event_id"]
    )
    return rounded(wide)


@query(
    f"""WITH {SPANS_SQL}, {STAY_SQL},
once AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, ts, event_type, origin ORDER BY stay NULLS LAST, value NULLS LAST) AS rn FROM kept) WHERE rn = 1),
wide AS (SELECT user_id, stay, ts, {', '.join(f"sum(value) FILTER (event_type = '{t}') AS {t}" for t in TYPES)} FROM once GROUP BY ALL),
b AS (SELECT TIMESTAMP '1970-01-01' + to_seconds(CAST(round_even(epoch_us(ts) / 1e6 / 259200, 0) AS BIGINT) * 259200) AS ts, user_id, stay,
  {', '.join(f'{how}({t}) AS {t}' for t, how in AGGS.items())} FROM wide GROUP BY 1, 2, 3)
SELECT b.ts, user_id, stay, {', '.join(f'round({t}, 6) AS {t}' for t in TYPES)},
  round({h('start_ts', 'b.ts')}, 6) AS t_since, round({h('b.ts', 'end_ts')}, 6) AS t_til FROM b LEFT JOIN spans USING (user_id)"""
)
def bucket_by_context(spark, folder):
    """Three-day buckets whose bounds come from a context of one row a user."""
    wide = timetable.pivot_features(
        stay_events(spark, folder), TYPES, "user_id", "ts", "stay", feature="event_type", value="value", within=("origin", [0, 1])
    )
    ctx = spans(load(spark, folder, "events"))
    out = timetable.bucketize(wide, 259200, AGGS, ["user_id", "stay"], "ts", ctx, "user_id", "start_ts", "end_ts", unique=True)
    return rounded(out)


SLICE_ROWS = 40  # a row target that makes every user hot

LOCF_SQL = f"""WITH {PIVOT_SQL}, med AS (SELECT {', '.join(f'median({t}) AS m_{t}' for t in TYPES)} FROM wide),
carried AS (SELECT *, {', '.join(f'last_value({t} IGNORE NULLS) OVER w AS l_{t}' for t in TYPES)} FROM wide
            WINDOW w AS (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT user_id, ts, {', '.join(f'''round(coalesce(l_{t}, m_{t}), 6) AS {t},
CASE WHEN {t} IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS {t}_imputed,
CASE WHEN l_{t} IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS {t}_imputed_global''' for t in TYPES)} FROM carried, med"""


@query(LOCF_SQL)
def locf_impute(spark, folder):
    ev = load(spark, folder, "events")
    table, slices = wide_events(ev).select("user_id", "ts", *TYPES), plan_slices(ev, ["user_id"], "ts", rows=ev.count())
    return rounded(timetable.impute_sequence(table, ["user_id"], ["ts"], TYPES, slices=slices, rows=ev.count()))


@query(
    f"""WITH n AS (SELECT user_id, event_type, ts, value, lead(event_type) OVER w AS nt, lead(ts) OVER w AS nts,
lead(value) OVER w AS nv FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, ts AS start, nts AS stop, round({h('ts', 'nts')}, 6) AS elapsed, nv AS value FROM n
WHERE event_type = 'click' AND nt = 'purchase'"""
)
def pair_intervals(spark, folder):
    ev = load(spark, folder, "events")
    slices = plan_slices(ev, ["user_id"], "ts", rows=ev.count())
    return rounded(timetable.pair_intervals(ev, ["user_id"], "ts", "event_type", "click", "purchase", "value", ["event_id"], slices))


@query(LOCF_SQL)
def locf_impute_sliced(spark, folder):
    """The same with users cut into slices of a few dozen rows."""
    ev = load(spark, folder, "events")
    table, slices = wide_events(ev).select("user_id", "ts", *TYPES), plan_slices(ev, ["user_id"], "ts", hot_rows=SLICE_ROWS)
    return rounded(timetable.impute_sequence(table, ["user_id"], ["ts"], TYPES, slices=slices, rows=ev.count()))


@query(
    f"""WITH e AS (SELECT user_id, event_type, date_trunc('day', ts) AS ts, value, event_id FROM events),
n AS (SELECT user_id, event_type, ts, value, lead(event_type) OVER w AS nt, lead(ts) OVER w AS nts,
lead(value) OVER w AS nv FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, ts AS start, nts AS stop, round({h('ts', 'nts')}, 6) AS elapsed, nv AS value FROM n
WHERE event_type = 'click' AND nt = 'purchase'"""
)
def pair_intervals_sliced(spark, folder):
    """Times by day, so that many rows of a user share one, and users cut into slices of a few dozen rows."""
    ev = load(spark, folder, "events").withColumn("ts", F.date_trunc("day", "ts").cast("timestamp_ntz"))
    slices = plan_slices(ev, ["user_id"], "ts", hot_rows=SLICE_ROWS)
    return rounded(timetable.pair_intervals(ev, ["user_id"], "ts", "event_type", "click", "purchase", "value", ["event_id"], slices))


# --- summaries ------------------------------------------------------------------------------------------------------
@query(
    """SELECT user_id, event_type, round(avg(value), 6) AS average, min(value) AS minimum, max(value) AS maximum,
count(*) AS cnt FROM events GROUP BY user_id, event_type"""
)
def summary_mean(spark, folder):
    return rounded(summaries.summarize(load(spark, folder, "events"), ["user_id", "event_type"], "value"))


@query(
    """SELECT l_suppkey, l_returnflag, round(sum(l_extendedprice), 2) AS total, min(l_extendedprice) AS minimum,
max(l_extendedprice) AS maximum, count(*) AS cnt, sum(l_quantity) AS time FROM lineitem GROUP BY l_suppkey, l_returnflag"""
)
def summary_total(spark, folder):
    li = load(spark, folder, "lineitem")
    return rounded(summaries.summarize(li, ["l_suppkey", "l_returnflag"], "l_extendedprice", "total", "l_quantity"), 2)


WIDE_SQL = f"""WITH {SPANS_SQL}, ctx AS (SELECT user_id, {h('start_ts', 'end_ts')} AS span_h FROM spans),
w AS (SELECT user_id, {', '.join(f'''avg(value) FILTER (event_type = '{t}') AS avrg_{t}, min(value) FILTER (event_type = '{t}') AS mini_{t},
max(value) FILTER (event_type = '{t}') AS maxi_{t}, count(value) FILTER (event_type = '{t}') AS cnt_{t},
sum(value) FILTER (event_type = '{t}') AS tot_{t}_in''' for t in TYPES)} FROM events GROUP BY user_id)
SELECT user_id, round(span_h, 6) AS span_h, {', '.join(f'''round(avrg_{t}, 6) AS avrg_{t}, mini_{t}, maxi_{t},
round(cnt_{t} / nullif(span_h, 0), 6) AS cnt_{t}, round(tot_{t}_in / nullif(span_h, 0), 6) AS tot_{t}_in''' for t in TYPES)}
FROM ctx LEFT JOIN w USING (user_id)"""


@query(WIDE_SQL)
def wide_summary(spark, folder):
    ev = load(spark, folder, "events", ["user_id", "ts", "event_type", "value"])
    ctx = spans(ev).select("user_id", elapsed_hours("start_ts", "end_ts").alias("span_h"))
    specs = [
        summaries.WideSpec(ev, "event_type", "value"),
        summaries.WideSpec(ev, "event_type", "value", kind="totals", suffix="in"),
    ]
    return rounded(summaries.wide_summary(ctx, specs, "user_id", "span_h"))


@query(
    f"""SELECT user_id, {', '.join(f"""round(avg(value) FILTER (event_type = '{t}'), 6) AS "Average Value: {t}",
count(value) FILTER (event_type = '{t}') AS cnt_{t}""" for t in TYPES)} FROM events GROUP BY user_id"""
)
def labelled_summary(spark, folder):
    """Summary columns renamed by a label table that is itself read off the data."""
    ev = load(spark, folder, "events", ["user_id", "event_type", "value"])
    wide = timetable.spread(ev, ["user_id"], "event_type", TYPES, {"avrg_{value}": ("avg", "value"), "cnt_{value}": ("count", "value")})
    labels = ev.select("event_type").distinct().select(
        F.concat(F.lit("avrg_"), "event_type").alias("old"), F.concat(F.lit("Average Value: "), "event_type").alias("label")
    )
    return rounded(names.rename_from_map(wide, labels))


@query(
    f"""WITH {SPANS_SQL}, ctx AS (SELECT user_id, {h('start_ts', 'end_ts')} AS span_h FROM spans),
w AS (SELECT e.user_id, {', '.join(f"""sum(value) FILTER (event_type = '{t}') AS tot_{t}_out, min(value) FILTER (event_type = '{t}') AS mini_{t}_out,
max(value) FILTER (event_type = '{t}') AS maxi_{t}_out, count(value) FILTER (event_type = '{t}') AS cnt_{t}_out, sum(value) FILTER (event_type = '{t}') AS tot_{t}_in,
count(value) FILTER (event_type = '{t}') AS cnt_{t}_in, sum({h('start_ts', 'ts')}) FILTER (event_type = '{t}') AS tot_{t}_time""" for t in TYPES)}
FROM events e JOIN spans s ON e.user_id = s.user_id GROUP BY e.user_id)
SELECT user_id, round(span_h, 6) AS span_h, {', '.join(f"""mini_{t}_out, maxi_{t}_out""" for t in TYPES)},
{', '.join(f"round({c} / nullif(span_h, 0), 6) AS {c}" for t in TYPES for c in (f"tot_{t}_out", f"cnt_{t}_out", f"tot_{t}_in", f"cnt_{t}_in", f"tot_{t}_time"))}
FROM ctx LEFT JOIN w USING (user_id)"""
)
def wide_outputs_inputs(spark, folder):
    """Outputs with their extremes, inputs with amount, count and time."""
    ev = load(spark, folder, "events", ["user_id", "ts", "event_type", "value"])
    bounds = settle(spans(ev))
    ctx = bounds.select("user_id", elapsed_hours("start_ts", "end_ts").alias("span_h"))
    timed = ev.join(bounds, "user_id").withColumn("ran", elapsed_hours("start_ts", "ts"))
    specs = [
        summaries.WideSpec(timed, "event_type", "value", kind="outputs", suffix="out"),
        summaries.WideSpec(timed, "event_type", "value", kind="inputs", suffix="in"),
        summaries.WideSpec(timed, "event_type", "ran", kind="totals", suffix="time"),
    ]
    return rounded(summaries.wide_summary(ctx, specs, "user_id", "span_h"))


SUPPLIERS = list(range(1, 101))  # the listed items of the feature


@query(
    f"""SELECT l_partkey, {', '.join(f"""round(avg(l_quantity) FILTER (l_suppkey = {s}), 6) AS avrg_{s}, min(l_quantity) FILTER (l_suppkey = {s}) AS mini_{s},
count(l_quantity) FILTER (l_suppkey = {s}) AS cnt_{s}""" for s in SUPPLIERS)} FROM lineitem WHERE l_suppkey IN ({', '.join(map(str, SUPPLIERS))}) GROUP BY l_partkey"""
)
def wide_table(spark, folder):
    """More columns than conditional aggregates are used for."""
    li = load(spark, folder, "lineitem", ["l_partkey", "l_suppkey", "l_quantity"])
    cells = {"avrg_{value}": ("avg", "l_quantity"), "mini_{value}": ("min", "l_quantity"), "cnt_{value}": ("count", "l_quantity")}
    return rounded(timetable.spread(li, ["l_partkey"], "l_suppkey", SUPPLIERS, cells))


REMAINDERS = list(range(100))  # every supplier falls into one of these classes, at any number of suppliers


@query(
    f"""SELECT l_partkey, {', '.join(f"""round(avg(l_quantity) FILTER ((l_suppkey % 100 + 100) % 100 = {s}), 6) AS avrg_{s}, min(l_quantity) FILTER ((l_suppkey % 100 + 100) % 100 = {s}) AS mini_{s},
count(l_quantity) FILTER ((l_suppkey % 100 + 100) % 100 = {s}) AS cnt_{s}""" for s in REMAINDERS)} FROM lineitem WHERE l_suppkey IS NOT NULL GROUP BY l_partkey"""
)
def wide_table_whole(spark, folder):
    """As wide as `wide_table`, over every row: the item is a class of suppliers."""
    li = load(spark, folder, "lineitem", ["l_partkey", "l_suppkey", "l_quantity"])
    li = li.select("l_partkey", F.pmod("l_suppkey", F.lit(100)).cast("int").alias("item"), "l_quantity")
    cells = {"avrg_{value}": ("avg", "l_quantity"), "mini_{value}": ("min", "l_quantity"), "cnt_{value}": ("count", "l_quantity")}
    return rounded(timetable.spread(li, ["l_partkey"], "item", REMAINDERS, cells))


@query(
    f"""SELECT user_id, count(*) AS n, round({h('min(ts)', 'max(ts)')}, 6) AS span_h,
round(count(*) / nullif({h('min(ts)', 'max(ts)')}, 0), 6) AS per_hour FROM events GROUP BY user_id"""
)
def rate_per(spark, folder):
    ev = load(spark, folder, "events")
    rows = ev.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("a"), F.max("ts").alias("b"))
    rows = rows.select("user_id", "n", elapsed_hours("a", "b").alias("span_h"))
    return rounded(summaries.rate_per(rows, "n", "span_h", "per_hour"))


CODES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def order_codes(spark: SparkSession, folder: str) -> DataFrame:
    part = load(spark, folder, "part", ["p_partkey", "p_type"])
    li = load(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("p_partkey"))
    return li.join(part, "p_partkey").select("o_orderkey", "p_type")


@query(
    f"""SELECT o_orderkey, {', '.join(f"CAST(count(*) FILTER (p_type = '{c}') AS BIGINT) AS d_{c}" for c in CODES)}
FROM orders LEFT JOIN (SELECT l_orderkey, p_type FROM lineitem JOIN part ON p_partkey = l_partkey) ON l_orderkey = o_orderkey
GROUP BY o_orderkey"""
)
def code_counts(spark, folder):
    ctx = load(spark, folder, "orders", ["o_orderkey"])
    return summaries.code_counts(order_codes(spark, folder), "o_orderkey", "p_type", "d", ctx=ctx)


@query(
    """SELECT o_orderkey, string_agg(p_type || ':' || n, ',' ORDER BY p_type) AS counts FROM
(SELECT l_orderkey AS o_orderkey, p_type, count(*) AS n FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL)
GROUP BY o_orderkey"""
)
def code_count_map(spark, folder):
    rows = summaries.code_count_map(order_codes(spark, folder), "o_orderkey", "p_type")
    pairs = F.transform(F.map_entries("counts"), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string")))
    return rows.select("o_orderkey", F.array_join(pairs, ",").alias("counts"))


@query(
    """SELECT l_orderkey, round(avg(l_quantity), 6) AS l_quantity, round(avg(l_discount), 6) AS l_discount FROM lineitem
GROUP BY l_orderkey"""
)
def mean_by(spark, folder):
    return rounded(summaries.mean_by(load(spark, folder, "lineitem"), "l_orderkey", ["l_quantity", "l_discount"]))


@query(
    """WITH ids AS (SELECT l_partkey, row_number() OVER (ORDER BY l_partkey) - 1 AS id FROM (SELECT DISTINCT l_partkey FROM lineitem)),
n AS (SELECT l_suppkey, id, count(*) AS n FROM lineitem JOIN ids USING (l_partkey) GROUP BY ALL)
SELECT l_suppkey, count(*) AS codes, sha256(string_agg(id || ':' || n, ',' ORDER BY id)) AS cells FROM n GROUP BY l_suppkey"""
)
def sparse_codes(spark, folder):
    """Parts as codes of suppliers: more codes than columns could be, numbered without gathering them."""
    li = load(spark, folder, "lineitem").select("l_suppkey", "l_partkey")
    _, vectors = summary.sparse_codes(li, "l_suppkey", "l_partkey")
    cells = F.zip_with("ids", "counts", lambda i, n: F.concat_ws(":", i.cast("string"), n.cast("bigint").cast("string")))
    return vectors.select("l_suppkey", F.size("ids").cast("bigint").alias("codes"), F.sha2(F.array_join(cells, ","), 256).alias("cells"))


STAY_CODES = [f + s for f in "ANR" for s in "FO"]
PROCEDURES = [f"P{k}" for k in range(1, 8)]
PRIORITIES_KNOWN = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]
CHART_CLASSES = [(a, b) for a in (1, 2) for b in (0, 1, 2)]
SUMMARY_SQL = f"""WITH ctx AS (SELECT o_orderkey AS icustay_id, o_orderkey AS hadm_id, {BORN} AS dob, {DIED} AS dod, o_orderdate AS admittime,
  o_orderdate + to_days(10) AS dischtime, o_orderdate + to_hours(6) AS intime, o_orderdate + to_hours(6) + to_days((o_orderkey % 5)::INT) AS outtime,
  (o_orderkey % 5)::DOUBLE AS los, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS kind FROM orders JOIN customer ON o_custkey = c_custkey),
d AS (SELECT l_orderkey, {', '.join(f"count(*) FILTER (l_returnflag || l_linestatus = '{c}') AS d_{c}" for c in STAY_CODES)} FROM lineitem WHERE l_linenumber > 1 GROUP BY 1),
p AS (SELECT l_orderkey, {', '.join(f"count(*) FILTER (l_linenumber = {k + 1}) AS p_{c}" for k, c in enumerate(PROCEDURES))} FROM lineitem WHERE l_quantity > 25 GROUP BY 1),
c AS (SELECT l_orderkey, {', '.join(f"""avg(v) FILTER ({w}) AS a_{a}_{b}, min(v) FILTER ({w}) AS i_{a}_{b}, max(v) FILTER ({w}) AS x_{a}_{b}, count(v) FILTER ({w}) AS n_{a}_{b}"""
  for a, b in CHART_CLASSES for w in [f"cid1 = {a} AND cid2 = {b}"])},
  sum(l_quantity) FILTER (l_linestatus = 'O' AND l_linenumber % 2 = 0) AS o_0, sum(l_quantity) FILTER (l_linestatus = 'O' AND l_linenumber % 2 = 1) AS o_1, sum(l_tax) AS i_1
  FROM (SELECT *, 1 + l_linenumber % 2 AS cid1, l_linenumber % 3 AS cid2, CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END AS v FROM lineitem) GROUP BY 1)
SELECT icustay_id, hadm_id, los AS los_total, round({h('dob', 'admittime')}, 6) AS age_at_admission_h, round({h('admittime', 'intime')}, 6) AS adm_to_icu_h,
  round({h('intime', 'outtime')}, 6) AS icu_los_h, round({h('admittime', 'dischtime')}, 6) AS hosp_los_h, round({h('dob', 'dod')}, 6) AS age_at_death_h,
  {', '.join(f"d_{c} AS d_icd_{c}" for c in STAY_CODES)}, {', '.join(f"coalesce(p_{c}, 0) AS p_icd_{c}" for c in PROCEDURES)},
  {', '.join(f"""CASE WHEN kind = '{k}' THEN 1 ELSE 0 END AS "admission_type_{k}" """ for k in PRIORITIES_KNOWN)}, CASE WHEN kind IS NULL THEN 1 ELSE 0 END AS admission_type_nan,
  {', '.join(f"""round(a_{a}_{b}, 6) AS avrg_{a}_{b}, round(i_{a}_{b}, 6) AS mini_{a}_{b}, round(x_{a}_{b}, 6) AS maxi_{a}_{b},
  round(n_{a}_{b} / nullif(los, 0), 6) AS cnt_{a}_{b}""" for a, b in CHART_CLASSES)},
  round(o_0 / nullif(los, 0), 6) AS tot_1_0_out, round(o_1 / nullif(los, 0), 6) AS tot_1_1_out, round(i_1 / nullif(los, 0), 6) AS tot_2_1_in
FROM ctx LEFT JOIN d ON d.l_orderkey = hadm_id LEFT JOIN p ON p.l_orderkey = hadm_id LEFT JOIN c ON c.l_orderkey = icustay_id"""


@query(SUMMARY_SQL)
def stay_summary(spark, folder):
    """The second pipeline whole: orders are stays, their lines give codes and item-class events."""
    o, c, li = (load(spark, folder, t) for t in ("orders", "customer", "lineitem"))
    stays = o.join(c, F.col("o_custkey") == F.col("c_custkey"))
    ctx = stays.select(
        F.col("o_orderkey").alias("icustay_id"), F.col("o_orderkey").alias("hadm_id"), (at("1990-01-01") + days(F.col("c_nationkey") * 365)).alias("dob"),
        F.when(F.col("c_acctbal") < 0, at("1998-01-01") + days(F.col("c_nationkey") * 30)).alias("dod"), F.col("o_orderdate").alias("admittime"),
        (F.col("o_orderdate") + days(F.lit(10))).alias("dischtime"), (F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(6))).alias("intime"),
        (F.col("o_orderdate") + F.make_dt_interval((F.col("o_orderkey") % 5).cast("int"), F.lit(6))).alias("outtime"),
        (F.col("o_orderkey") % 5).cast("double").alias("los_total"), F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("admission_type"),
        F.lit("dx").alias("diagnosis"),
    )
    event = [F.col("l_orderkey").alias("icustay_id")]
    tables = {
        "diagnoses_icd": li.filter("l_linenumber > 1").select(F.col("l_orderkey").alias("hadm_id"), F.concat("l_returnflag", "l_linestatus").alias("icd9_code")),
        "procedures_icd": li.filter("l_quantity > 25").select(F.col("l_orderkey").alias("hadm_id"), F.concat(F.lit("P"), "l_linenumber").alias("icd9_code")),
        "chartevents": li.select(
            *event, (F.col("l_linenumber") % 2 + 1).alias("cid1"), (F.col("l_linenumber") % 3).alias("cid2"),
            F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice")).alias("valuenum"),
        ),
        "outputevents": li.filter("l_linestatus = 'O'").select(*event, F.lit(1).alias("cid1"), (F.col("l_linenumber") % 2).alias("cid2"), F.col("l_quantity").alias("value")),
        "inputevents_mv": li.select(*event, F.lit(2).alias("cid1"), F.lit(1).alias("cid2"), F.col("l_tax").alias("amount")),
    }
    return rounded(summary.stay_summary(ctx, tables))


@query(
    """SELECT o_orderkey AS hadm_id, o_orderstatus, count(l_orderkey) AS lines, round(sum(l_quantity), 2) AS quantity,
round(max(l_extendedprice), 2) AS dearest FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL"""
)
def bucketed_join(spark, folder):
    """Two stages in buckets of one key: joined and grouped without a shuffle."""
    place, name = shared_folder(spark, "bucketed"), "bucketed_" + uuid.uuid4().hex
    o = load(spark, folder, "orders").select(F.col("o_orderkey").alias("hadm_id"), "o_orderstatus")
    li = load(spark, folder, "lineitem").select(F.col("l_orderkey").alias("hadm_id"), "l_quantity", "l_extendedprice")
    buckets = max(8, -(-li.count() // HOT_ROWS))
    stays = save_bucketed(o, f"{place}/stays", f"{name}_stays", ["hadm_id"], buckets)
    lines = save_bucketed(li, f"{place}/lines", f"{name}_lines", ["hadm_id"], buckets)
    grouped = stays.join(lines, "hadm_id", "left").groupBy("hadm_id", "o_orderstatus")
    cells = F.count("l_quantity").alias("lines"), F.sum("l_quantity").alias("quantity"), F.max("l_extendedprice").alias("dearest")
    return rounded(grouped.agg(*cells), 2)


@query("SELECT count(DISTINCT l_partkey) AS n FROM lineitem")
def count_distinct(spark, folder):
    return summaries.count_distinct(load(spark, folder, "lineitem"), "l_partkey")


@query("SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def distinct_keys(spark, folder):
    return relational.distinct_keys(load(spark, folder, "lineitem"), "l_suppkey", "l_returnflag", "l_linestatus")


# --- joins, sets, scalars -------------------------------------------------------------------------------------------
@query(
    """SELECT o_orderkey, o_orderstatus, l_shipdate, l_linenumber FROM orders LEFT JOIN (SELECT * FROM (SELECT l_orderkey,
l_shipdate, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber) AS rn FROM lineitem)
WHERE rn = 1) ON l_orderkey = o_orderkey"""
)
def enrich_first(spark, folder):
    dim = load(spark, folder, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    o = load(spark, folder, "orders", ["o_orderkey", "o_orderstatus"])
    return relational.enrich(o, dim, ["o_orderkey"], ["l_shipdate", "l_linenumber"])


@query(
    """WITH a AS (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_nationkey END AS k FROM customer),
b AS (SELECT CASE WHEN s_acctbal >= 0 THEN s_nationkey END AS k, count(*) AS suppliers FROM supplier GROUP BY 1)
SELECT c_custkey, a.k AS k, suppliers FROM a JOIN b ON a.k IS NOT DISTINCT FROM b.k"""
)
def merge_nullsafe(spark, folder):
    c, s = load(spark, folder, "customer"), load(spark, folder, "supplier")
    a = c.select("c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey")).alias("k"))
    b = s.groupBy(F.when(F.col("s_acctbal") >= 0, F.col("s_nationkey")).alias("k")).agg(F.count(F.lit(1)).alias("suppliers"))
    return relational.merge_nullsafe(a, b, "k")


@query(
    """WITH s AS (SELECT l_orderkey AS o_orderkey, min(o_custkey) AS o_custkey, sum(l_quantity) AS quantity FROM lineitem
JOIN orders ON o_orderkey = l_orderkey GROUP BY l_orderkey)
SELECT o.o_orderkey, o.o_custkey, o_orderstatus, quantity FROM orders o LEFT JOIN s ON s.o_orderkey = o.o_orderkey
AND s.o_custkey = o.o_custkey"""
)
def merge_common(spark, folder):
    o = load(spark, folder, "orders", ["o_orderkey", "o_custkey", "o_orderstatus"])
    li = load(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity")
    totals = li.groupBy("o_orderkey").agg(F.sum("l_quantity").alias("quantity"))
    totals = totals.join(o.select("o_orderkey", "o_custkey"), "o_orderkey")
    return relational.merge_common(o, totals)


@query(
    """SELECT c_custkey AS id, c_acctbal AS balance, c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS name FROM customer
UNION ALL SELECT s_suppkey, s_acctbal, NULL, s_name FROM supplier"""
)
def append_rows(spark, folder):
    c = load(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")
    )
    s = load(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name")
    )
    return relational.append(c, s)


@query(
    """SELECT code // 10 AS class, min(p_size) AS low, count(*) AS n FROM (SELECT p_size, p_partkey % 10 * 1000 + p_size AS code FROM part)
WHERE code // 1000 <> 7 GROUP BY 1"""
)
def item_classes(spark, folder):
    """The leading digit of a code names its table; it is spread over all parts."""
    part = load(spark, folder, "part").select("p_size", (F.col("p_partkey") % 10 * 1000 + F.col("p_size")).alias("code"))
    others = part.filter(item_class("code", 3) != 7)
    return others.groupBy(item_class("code", 1).alias("class")).agg(F.min("p_size").alias("low"), F.count(F.lit(1)).alias("n"))


@query(
    """SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE log10(l_extendedprice) > 4.0
AND log10(l_extendedprice) < 4.5"""
)
def log_band(spark, folder):
    li = load(spark, folder, "lineitem", ["l_orderkey", "l_linenumber", "l_extendedprice"])
    return li.filter(log10_between("l_extendedprice", 4.0, 4.5))


@query(
    """SELECT DISTINCT CAST(l_suppkey AS BIGINT) AS spec, CAST(l_linenumber AS BIGINT) AS org, CAST(NULL AS BIGINT) AS ab
FROM lineitem"""
)
def composite_ids(spark, folder):
    li = load(spark, folder, "lineitem", ["l_suppkey", "l_linenumber", "l_returnflag"])
    text = F.concat(F.lit("("), F.concat_ws(",", *li.columns), F.lit(")"))
    ids = li.select(parse_ids(text).alias("ids"))
    return ids.select(*[F.get("ids", F.lit(i)).alias(n) for i, n in enumerate(("spec", "org", "ab"))]).distinct()


@query(
    """SELECT l_orderkey, l_linenumber, l_shipdate, l_returnflag, l_linestatus, l_discount, l_tax FROM lineitem"""
)
def column_choice(spark, folder):
    li = load(spark, folder, "lineitem")
    ids = names.columns_like(li, suffix="orderkey") + names.columns_like(li, contains="linenumber")
    chosen = ids + names.columns_of_type(li, "datetime") + names.columns_of_type(li, "string")
    return names.drop_columns(li, [c for c in names.columns_of_type(li, "numeric") if c not in ids + ["l_discount", "l_tax"]]).select(
        *chosen, "l_discount", "l_tax"
    )


@query("SELECT doc_id, quality FROM labels WHERE toxic = 1")
def rows_by_label(spark, folder):
    labels = load(spark, folder, "labels")
    return names.drop_columns(labels.filter(F.col("toxic") == 1), ["toxic"])


@query(
    """WITH u AS (SELECT p_size % 3 + 1 AS nid_table, p_size AS nid_class1, length(p_brand) AS nid_class2, p_name AS class2 FROM part),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY class2 ORDER BY nid_table, nid_class1, nid_class2) AS rn FROM u)
      WHERE rn = 1)
SELECT CASE nid_table WHEN 1 THEN 'avrg_' ELSE 'tot_' END || nid_class1 || '_' || nid_class2 ||
CASE nid_table WHEN 1 THEN '' WHEN 2 THEN '_in' ELSE '_out' END AS old,
CASE nid_table WHEN 1 THEN 'Average Value: ' WHEN 2 THEN 'Total Input: ' ELSE 'Total Output: ' END || class2 AS label FROM f"""
)
def item_labels(spark, folder):
    part = load(spark, folder, "part")
    item_map = part.select(
        (F.col("p_size") % 3 + 1).alias("nid_table"), F.col("p_size").alias("nid_class1"),
        F.length("p_brand").alias("nid_class2"), F.col("p_name").alias("class2"),
    )
    return encoding.item_labels(item_map)


# --- encoding and imputation ----------------------------------------------------------------------------------------
GAPS_SQL = """SELECT l_orderkey, l_linenumber, l_suppkey, CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END AS price,
CASE WHEN l_linenumber > 1 THEN l_discount END AS discount FROM lineitem"""


def with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    li = load(spark, folder, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", "l_suppkey",
        F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice")).alias("price"),
        F.when(F.col("l_linenumber") > 1, F.col("l_discount")).alias("discount"),
    )


@query(
    f"""WITH g AS ({GAPS_SQL}), m AS (SELECT median(price) AS mp, median(discount) AS md FROM g)
SELECT l_orderkey, l_linenumber, l_suppkey, round(coalesce(price, mp), 6) AS price, round(coalesce(discount, md), 6) AS discount FROM g, m"""
)
def median_impute(spark, folder):
    gaps = with_gaps(spark, folder)
    return rounded(encoding.median_impute(gaps, ["price", "discount"], rows=gaps.count()))


@query(
    f"""WITH g AS ({GAPS_SQL}) SELECT 'price' AS name, round(median(price), 6) AS median FROM g
UNION ALL SELECT 'discount', round(median(discount), 6) FROM g"""
)
def column_medians(spark, folder):
    """The two-pass form for large frames."""
    medians = fit_medians(with_gaps(spark, folder), ["price", "discount"])
    return rounded(inline(spark, list(medians.items()), "name string, median double"))


@query(
    f"""WITH g AS ({GAPS_SQL}), li AS (SELECT l_quantity AS quantity, -l_tax AS tax_loss FROM lineitem)
SELECT 'price' AS name, round(median(price), 6) AS median FROM g UNION ALL SELECT 'discount', round(median(discount), 6) FROM g
UNION ALL SELECT 'quantity', round(median(quantity), 6) FROM li UNION ALL SELECT 'tax_loss', round(median(tax_loss), 6) FROM li"""
)
def medians_selected(spark, folder):
    """The narrowing passes: no more than 100 values of a column are ever ranked."""
    li = load(spark, folder, "lineitem").select(
        F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice")).alias("price"), F.when(F.col("l_linenumber") > 1, F.col("l_discount")).alias("discount"),
        F.col("l_quantity").alias("quantity"), (-F.col("l_tax")).alias("tax_loss"),
    )
    medians = fit_medians(li, li.columns, target=100)
    return rounded(inline(spark, list(medians.items()), "name string, median double"))


def unit_sql(key: str, seed: int | str) -> str:
    return f"(CAST('0x' || substr(md5('{seed}:' || {key}), 1, 8) AS BIGINT) / 4294967296.0)"


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    f"""SELECT o_orderkey, {', '.join(f'''CASE WHEN o_orderpriority = '{p}' THEN 1 ELSE 0 END AS "o_orderpriority_{p}"''' for p in PRIORITIES)},
{', '.join(f"CASE WHEN status = '{s}' THEN 1 ELSE 0 END AS status_{s}" for s in 'FO')},
CASE WHEN status IS NULL THEN 1 ELSE 0 END AS status_nan
FROM (SELECT *, nullif(o_orderstatus, 'P') AS status FROM orders WHERE {unit_sql('o_custkey', 7)} < 0.1)"""
)
def dummies_aligned(spark, folder):
    o = load(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", F.nullif("o_orderstatus", F.lit("P")).alias("status")
    )
    side = o.withColumn("side", modelling.split_side("o_custkey", 0.1, 7))
    train, test = (side.filter(F.col("side") == s).drop("side", "o_custkey") for s in ("train", "test"))
    seen = encoding.fit_dummies(train, ["o_orderpriority"])
    status = encoding.fit_dummies(train, ["status"], null_column=True)
    return encoding.apply_dummies(encoding.apply_dummies(test, seen), status)


@query(
    """SELECT event_id, e.event_type, CAST(c.code AS INTEGER) AS event_type_code FROM events e JOIN (SELECT event_type,
row_number() OVER (ORDER BY min(event_id)) - 1 AS code FROM events GROUP BY event_type) c ON c.event_type = e.event_type"""
)
def ordinal_encode(spark, folder):
    return encoding.ordinal_encode(load(spark, folder, "events", ["event_id", "event_type"]), "event_type", "event_id")


@query(
    """WITH n AS (SELECT *, sqrt(l_quantity * l_quantity + l_discount * l_discount + l_tax * l_tax) AS s FROM lineitem)
SELECT l_orderkey, l_linenumber, l_suppkey, round(l_quantity / s, 9) AS l_quantity, round(l_discount / s, 9) AS l_discount,
round(l_tax / s, 9) AS l_tax FROM n"""
)
def l2_columns(spark, folder):
    li = load(spark, folder, "lineitem", ["l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_discount", "l_tax"])
    return rounded(encoding.l2_normalize(li, ["l_quantity", "l_discount", "l_tax"]), 9)


@query(
    """WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
n AS (SELECT *, sqrt(list_dot_product(v, v)) AS s FROM e),
u AS (SELECT vec_id, s, unnest(v) AS x, unnest(range(len(v))) AS pos FROM n)
SELECT vec_id, CAST(pos AS INTEGER) AS pos, round(x / s, 6) AS x FROM u"""
)
def l2_norm(spark, folder):
    e = encoding.l2_normalize_array(load(spark, folder, "embeddings", ["vec_id", "embedding"]), "embedding")
    return rounded(e.select("vec_id", F.posexplode("embedding").alias("pos", "x")))


# --- split, scores, model -------------------------------------------------------------------------------------------
SIDE_SQL = f"CASE WHEN {unit_sql('c_custkey', 42)} < 0.1 THEN 'test' ELSE 'train' END"


@query(f"SELECT c_custkey, c_mktsegment, {SIDE_SQL} AS side FROM customer")
def split_members(spark, folder):
    return modelling.stratified_split(load(spark, folder, "customer"), "c_custkey", "c_mktsegment", 0.1, 42)


@query(
    f"""SELECT c_mktsegment, side, count(*) AS n FROM (SELECT c_mktsegment, {SIDE_SQL} AS side FROM customer JOIN orders
ON o_custkey = c_custkey) GROUP BY c_mktsegment, side"""
)
def split_counts(spark, folder):
    c, o = load(spark, folder, "customer"), load(spark, folder, "orders")
    sides = modelling.stratified_split(c, "c_custkey", "c_mktsegment", 0.1, 42)
    rows = o.select(F.col("o_custkey").alias("c_custkey"))
    parts = modelling.apply_split(rows, sides, "c_custkey")
    tagged = [p.join(c.select("c_custkey", "c_mktsegment"), "c_custkey").withColumn("side", F.lit(s)) for p, s in zip(parts, ("train", "test"))]
    return relational.append(*tagged).groupBy("c_mktsegment", "side").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""SELECT c_custkey, c_mktsegment, CASE WHEN r <= round_even(n * 0.1, 0) THEN 'test' ELSE 'train' END AS side FROM (SELECT c_custkey,
c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment ORDER BY {unit_sql('c_custkey', 42)}, c_custkey) AS r,
count(*) OVER (PARTITION BY c_mktsegment) AS n FROM customer)"""
)
def split_exact(spark, folder):
    c = load(spark, folder, "customer")
    hashed = c.select("c_mktsegment", modelling.unit_hash("c_custkey", 42).alias("_hash"))
    slices = plan_slices(hashed, ["c_mktsegment"], "_hash", rows=c.count())
    return modelling.stratified_split(c, "c_custkey", "c_mktsegment", 0.1, 42, exact=True, slices=slices)


@query(
    """SELECT c_custkey, c_mktsegment, CASE WHEN r <= round_even(n * 0.1, 0) THEN 'test' ELSE 'train' END AS side FROM (SELECT c_custkey,
c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment ORDER BY md5('7:' || c_custkey)) AS r,
count(*) OVER (PARTITION BY c_mktsegment) AS n FROM customer)"""
)
def split_rule(spark, folder):
    """Exact strata by limits of the digest: the side is a function of the row."""
    c = load(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return c.withColumn("side", modelling.fit_split(c, "c_custkey", "c_mktsegment", 0.1, 7).side())


@query(
    """WITH o AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status, md5('9:' || o_orderkey) AS h FROM orders),
r AS (SELECT o_orderkey, row_number() OVER (PARTITION BY status ORDER BY h) <= round_even(0.25 * count(*) OVER (PARTITION BY status), 0) AS test FROM o)
SELECT test, status, count(*) AS lines, round(sum(l_quantity), 2) AS quantity FROM lineitem JOIN o ON l_orderkey = o_orderkey JOIN r USING (o_orderkey) GROUP BY test, status"""
)
def split_rule_rows(spark, folder):
    """The lines of each side, an unknown status being a stratum: lines carry key and label, so both sides are filters."""
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status")
    o = load(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), status)
    rule = modelling.fit_split(o, "l_orderkey", "status", 0.25, 9)
    lines = load(spark, folder, "lineitem").select("l_orderkey", "l_quantity").join(o, "l_orderkey")
    parts = [p.withColumn("test", F.lit(t)) for p, t in zip(rule.apply(lines), (False, True))]
    return rounded(relational.append(*parts).groupBy("test", "status").agg(F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("quantity")), 2)


VITALS = {
    "age_at_adm": "CASE WHEN l_linenumber < 7 THEN l_quantity * 2 END",
    "heart_rate": "CASE WHEN l_linenumber <> 2 THEN l_extendedprice / 500 END",
    "systolic_bp": "l_extendedprice / 400",
    "body_temp": "30 + l_quantity / 4",
    "gcs_total": "CASE WHEN l_returnflag <> 'A' THEN 3 + l_linenumber * 2 END",
    "pao2_fio2_ratio": "CASE WHEN l_returnflag = 'N' THEN l_quantity * 6 END",
    "bun": "l_quantity * 2",
    "urine": "CASE WHEN l_linenumber <> 4 THEN l_extendedprice / 50 END",
    "sodium": "110 + l_quantity",
    "potassium": "1 + l_linenumber",
    "serum_bicarb": "l_quantity",
    "bilirubin": "l_discount * 100",
    "wbc": "l_tax * 300",
    "has_aids": "CASE WHEN l_discount = 0.01 THEN 1 ELSE 0 END",
    "has_heme": "CASE WHEN l_tax = 0.02 THEN 1 ELSE 0 END",
    "has_cancer": "CASE WHEN l_returnflag = 'R' THEN 1 WHEN l_returnflag = 'N' THEN 0 END",
}


def _points_sql(name: str, rule: dict) -> str:
    cases = " ".join(f"WHEN {name} < {limit} THEN {p}" for limit, p in rule["bands"])
    return f"CASE WHEN {name} IS NULL THEN {rule.get('missing', 0)} {cases} ELSE {rule['above']} END"


SCORE_SQL = " + ".join(_points_sql(n, r) for n, r in rules.SAPS2_BANDS.items())


@query(
    f"""WITH v AS (SELECT l_orderkey, l_linenumber, l_suppkey, {', '.join(f'{e} AS {n}' for n, e in VITALS.items())} FROM lineitem),
s AS (SELECT *, {SCORE_SQL} + CASE WHEN has_aids = 1 THEN 17 WHEN has_heme = 1 THEN 10 WHEN has_cancer = 1 THEN 9 ELSE 0 END AS saps2 FROM v)
SELECT l_orderkey, l_linenumber, l_suppkey, saps2,
round(exp(-7.7631 + 0.0737 * saps2 + 0.9971 * ln(saps2 + 1)) / (1 + exp(-7.7631 + 0.0737 * saps2 + 0.9971 * ln(saps2 + 1))), 9)
AS "SAPS2_mortality" FROM s"""
)
def saps_like_score(spark, folder):
    li = load(spark, folder, "lineitem")
    vitals = li.selectExpr("l_orderkey", "l_linenumber", "l_suppkey", *[f"{e} AS {n}" for n, e in VITALS.items()])
    return rounded(clinical.saps2(vitals).select("l_orderkey", "l_linenumber", "l_suppkey", "saps2", "SAPS2_mortality"), 9)


@query(
    """WITH ctx AS (SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderkey END AS stay, o_custkey AS adm, o_totalprice FROM orders),
tb AS (SELECT CASE WHEN l_linenumber < 7 THEN l_orderkey END AS stay, l_quantity AS heart_rate,
CASE WHEN l_returnflag = 'A' THEN l_linenumber END AS gcs_e, CASE WHEN l_returnflag = 'N' THEN l_linenumber END AS gcs_v,
CASE WHEN l_linestatus = 'O' THEN l_linenumber END AS gcs_m FROM lineitem),
db AS (SELECT o_custkey AS adm, floor(o_totalprice) AS sodium FROM orders),
s AS (SELECT stay, avg(heart_rate) AS heart_rate, avg(gcs_e) AS gcs_e, avg(gcs_m) AS gcs_m, avg(gcs_v) AS gcs_v FROM tb GROUP BY stay),
d AS (SELECT adm, avg(sodium) AS sodium FROM db GROUP BY adm)
SELECT o_orderkey, round(heart_rate, 6) AS heart_rate, round(coalesce(gcs_e, 4), 6) AS gcs_e, round(coalesce(gcs_m, 6), 6) AS gcs_m,
round(coalesce(gcs_v, 5), 6) AS gcs_v, round(sodium, 6) AS sodium,
round(coalesce(gcs_e, 4) + coalesce(gcs_m, 6) + coalesce(gcs_v, 5), 6) AS gcs_total
FROM ctx JOIN s ON s.stay IS NOT DISTINCT FROM ctx.stay JOIN d ON d.adm IS NOT DISTINCT FROM ctx.adm"""
)
def assemble(spark, folder):
    o, li = load(spark, folder, "orders"), load(spark, folder, "lineitem")
    ctx = o.select(
        "o_orderkey", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey")).alias("stay"),
        F.col("o_custkey").alias("adm"), "o_totalprice",
    )
    stay_buckets = li.select(
        F.when(F.col("l_linenumber") < 7, F.col("l_orderkey")).alias("stay"),
        F.col("l_quantity").alias("heart_rate"),
        F.when(F.col("l_returnflag") == "A", F.col("l_linenumber")).alias("gcs_e"),
        F.when(F.col("l_returnflag") == "N", F.col("l_linenumber")).alias("gcs_v"),
        F.when(F.col("l_linestatus") == "O", F.col("l_linenumber")).alias("gcs_m"),
    )
    adm_buckets = o.select(F.col("o_custkey").alias("adm"), F.floor("o_totalprice").alias("sodium"))
    out = modelling.assemble_features(
        ctx, stay_buckets, adm_buckets, ["heart_rate", "gcs_e", "gcs_m", "gcs_v"], ["sodium"], "stay", "adm",
        rules.COMA_FILLS, drop=["stay", "adm", "o_totalprice"], rows=o.count(),
    )
    return rounded(out)


def newton_sql(terms: list[str], steps: int) -> str:
    """Tables w0, w1, ... of weights b0, b1, ... by Newton steps over train (columns `terms`, the last a constant 1, and y).

    The equations of a step are solved by elimination, a table a pivot.
    """
    d = len(terms)
    every = [(i, j) for i in range(d) for j in range(i, d)]
    parts = ["w0 AS (SELECT " + ", ".join(f"0::DOUBLE AS b{i}" for i in range(d)) + ")"]
    for t in range(1, steps + 1):
        z = " + ".join(f"b{i} * {x}" for i, x in enumerate(terms))
        ridge = [0 if i == d - 1 else 1 for i in range(d)]
        sums = [f"sum(p * (1 - p) * {terms[i]} * {terms[j]}) + {ridge[i] * (i == j)} AS a{i}_{j}" for i, j in every]
        sums += [f"sum((p - y) * {x}) + {ridge[i]} * any_value(b{i}) AS g{i}" for i, x in enumerate(terms)]
        parts.append(f"e{t}_0 AS MATERIALIZED (SELECT {', '.join(sums)} FROM (SELECT *, 1 / (1 + exp(-({z}))) AS p FROM train, w{t - 1}))")
        for k in range(d - 1):
            made = [f"a{i}_{j}{f' - a{k}_{i} * a{k}_{j} / a{k}_{k}' if i > k else ''} AS a{i}_{j}" for i, j in every]
            made += [f"g{i}{f' - a{k}_{i} * g{k} / a{k}_{k}' if i > k else ''} AS g{i}" for i in range(d)]
            parts.append(f"e{t}_{k + 1} AS MATERIALIZED (SELECT {', '.join(made)} FROM e{t}_{k})")
        back = [f"(g{i}{''.join(f' - a{i}_{j} * s{j}' for j in range(i + 1, d))}) / a{i}_{i} AS s{i}" for i in reversed(range(d))]
        parts.append(f"w{t} AS MATERIALIZED (SELECT {', '.join(f'b{i} - s{i} AS b{i}' for i in range(d))} FROM w{t - 1}, (SELECT {', '.join(back)} FROM e{t}_{d - 1}))")
    return ",\n".join(parts)


LANGUAGES = ["de", "en", "es", "fr"]  # the values that occur in the table
NEWTON_TERMS = ["n_chars", *(f"lang_{v}" for v in LANGUAGES), "one"]
NEWTON_STEPS = 8


@query(
    f"""WITH r AS (SELECT {unit_sql('doc_id', 1)} < 0.2 AS test, ln(n_chars + 1.0) AS n_chars, lang, quality FROM documents JOIN labels USING (doc_id)),
m AS (SELECT median(n_chars) AS m FROM r WHERE NOT test),
x AS (SELECT test, coalesce(n_chars, m) AS n_chars, {', '.join(f"CASE WHEN lang = '{v}' THEN 1 ELSE 0 END AS lang_{v}" for v in LANGUAGES)}, 1 AS one, quality AS y FROM r, m WHERE quality IS NOT NULL),
train AS MATERIALIZED (SELECT * FROM x WHERE NOT test),
{newton_sql(NEWTON_TERMS, NEWTON_STEPS)},
fitted AS (SELECT * FROM w{NEWTON_STEPS})
{' UNION ALL '.join(f"SELECT '{'intercept' if t == 'one' else t}' AS term, round(b{i}, 4) AS value FROM fitted" for i, t in enumerate(NEWTON_TERMS))}
UNION ALL SELECT 'accuracy', round(avg(CASE WHEN ({' + '.join(f'b{i} * {t}' for i, t in enumerate(NEWTON_TERMS))} > 0) = (y = 1) THEN 1.0 ELSE 0.0 END), 4) FROM x, fitted WHERE test"""
)
def logistic_fit(spark, folder):
    """Text length and language against the quality label: coefficients of the fit and the hold-out accuracy."""
    docs = load(spark, folder, "documents", ["doc_id", "lang", "n_chars"])
    labels = load(spark, folder, "labels", ["doc_id", "quality"])
    rows = settle(docs.join(labels, "doc_id").withColumn("n_chars", F.ln(F.col("n_chars") + 1.0)))
    side = modelling.split_side("doc_id", 0.2, 1)
    parts = [rows.filter(side == s).drop("doc_id") for s in ("train", "test")]
    train, test = encoding.prepare_inputs(*parts, ["lang"], rows=labels.count(), outcomes=["quality"])
    fit = logistic.fit_newton(settle(train), "quality", [c for c in train.columns if c != "quality"])
    fitted = [*fit.weights.items(), ("intercept", fit.intercept)]
    share = fit.holdout(test, "quality").select(F.lit("accuracy").alias("term"), (F.col("right") / F.col("n")).alias("value"))
    return rounded(inline(spark, fitted, "term string, value double").unionByName(share), 4)


NEAR_TERMS = ["quantity", "discount", "one"]


@query(
    f"""WITH x AS (SELECT l_quantity / 50 AS quantity, l_discount * 10 AS discount, 1 AS one, CASE WHEN l_extendedprice > 40000 THEN 1 ELSE 0 END AS y,
md5('5:' || l_orderkey) < 'c' AS early FROM lineitem), train AS MATERIALIZED (SELECT * FROM x WHERE early),
{newton_sql(NEAR_TERMS, 10)}, fitted AS (SELECT * FROM w10),
said AS (SELECT CASE WHEN b0 * quantity + b1 * discount + b2 > 0 THEN 1 ELSE 0 END AS s, y FROM x, fitted WHERE NOT early)
{' UNION ALL '.join(f"SELECT '{'intercept' if t == 'one' else t}' AS term, round(b{i}, 4) AS value FROM fitted" for i, t in enumerate(NEAR_TERMS))}
UNION ALL SELECT 'rows', count(*) FROM train UNION ALL SELECT 'n', count(*) FROM said UNION ALL SELECT 'right', count(*) FILTER (s = y) FROM said
UNION ALL SELECT 'positive', sum(s) FROM said"""
)
def logistic_newton(spark, folder):
    """Dear lines by quantity and discount, fitted on three quarters of the orders: weights and hold-out counts."""
    x = load(spark, folder, "lineitem").select(
        (F.col("l_quantity") / 50).alias("quantity"), (F.col("l_discount") * 10).alias("discount"),
        F.when(F.col("l_extendedprice") > 40000, 1).otherwise(0).alias("y"), (modelling.key_digest("l_orderkey", 5) < "c").alias("early"),
    )
    fit = logistic.fit_newton(settle(x.filter("early").drop("early")), "y", NEAR_TERMS[:-1])
    fitted = [*fit.weights.items(), ("intercept", fit.intercept), ("rows", float(fit.rows))]
    held = fit.holdout(x.filter(~F.col("early")), "y")
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("term"), F.col(c).cast("double").alias("value")) for c in ("n", "right", "positive")]))
    return rounded(inline(spark, fitted, "term string, value double").unionByName(held.select(cells.alias("x")).select("x.*")), 4)


# --- comparison -----------------------------------------------------------------------------------------------------
@query("SELECT CAST(sum(toxic) AS BIGINT) AS positives, CAST(count(toxic) - sum(toxic) AS BIGINT) AS negatives FROM labels")
def class_balance(spark, folder):
    return comparison.class_balance(load(spark, folder, "labels"), "toxic")


@query(
    """WITH s AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
c AS (SELECT CAST(least(floor((value - lo) * 40 / (hi - lo)), 39) AS INTEGER) AS bin, count(*) AS n FROM events, s GROUP BY 1),
f AS (SELECT CAST(range AS INTEGER) AS bin, coalesce(n, 0) AS n FROM range(40) LEFT JOIN c ON c.bin = range)
SELECT bin, round(lo + bin * (hi - lo) / 40, 6) AS lower, round(lo + (bin + 1) * (hi - lo) / 40, 6) AS upper, n,
CAST(sum(n) OVER (ORDER BY bin) AS BIGINT) AS cumulative,
CAST(sum(n) OVER () - sum(n) OVER (ORDER BY bin) AS BIGINT) AS remaining FROM f, s"""
)
def histogram_40(spark, folder):
    return rounded(comparison.histogram(load(spark, folder, "events"), "value", 40))


@query(
    """WITH c AS (SELECT value, count(*) FILTER (event_type = 'click') AS a, count(*) FILTER (event_type = 'purchase') AS b
FROM events WHERE event_type IN ('click', 'purchase') GROUP BY value),
r AS (SELECT *, sum(a) OVER (ORDER BY value) AS ca, sum(b) OVER (ORDER BY value) AS cb, sum(a) OVER () AS na, sum(b) OVER () AS nb FROM c)
SELECT CAST(max(na) AS BIGINT) AS n_a, CAST(max(nb) AS BIGINT) AS n_b, round(max(abs(ca / na - cb / nb)), 9) AS statistic FROM r"""
)
def ks_statistic(spark, folder):
    ev = load(spark, folder, "events")
    click, purchase = (ev.filter(F.col("event_type") == t) for t in ("click", "purchase"))
    return rounded(comparison.ks_2samp(click, purchase, "value").drop("p_value"), 9)


@query(
    """WITH c AS (SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS a, count(*) FILTER (o_orderstatus = 'O') AS b
FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY 1), t AS (SELECT sum(a) AS na, sum(b) AS nb FROM c),
e AS (SELECT a, b, (a + b) * na / (na + nb) AS ea, (a + b) * nb / (na + nb) AS eb FROM c, t)
SELECT count(*) AS categories, count(*) - 1 AS dof, round(sum((a - ea) * (a - ea) / ea + (b - eb) * (b - eb) / eb), 6) AS statistic FROM e"""
)
def chi_square_stat(spark, folder):
    o = load(spark, folder, "orders")
    a, b = (o.filter(F.col("o_orderstatus") == s) for s in "FO")
    return rounded(comparison.chi_square_stat(a, b, "o_orderpriority"))


@query(
    """WITH c AS (SELECT value, count(*) FILTER (event_type = 'click') AS a, count(*) FILTER (event_type = 'purchase') AS b
FROM events WHERE event_type IN ('click', 'purchase') GROUP BY value),
r AS (SELECT *, sum(a) OVER (ORDER BY value) AS ca, sum(b) OVER (ORDER BY value) AS cb, sum(a) OVER () AS na, sum(b) OVER () AS nb FROM c),
s AS (SELECT max(abs(ca / na - cb / nb)) AS d, sqrt(max(na)::DOUBLE * max(nb) / (max(na) + max(nb))) AS en FROM r),
k AS (SELECT d, (en + 0.12 + 0.11 / en) * d AS lam FROM s),
p AS (SELECT lam, sum(CASE WHEN k % 2 = 1 THEN 2.0::DOUBLE ELSE -2.0 END * exp(-2.0 * k * k * lam * lam)) AS p FROM k, range(1, 101) t(k) GROUP BY lam),
x AS (SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS a, count(*) FILTER (o_orderstatus = 'O') AS b
FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY 1), t AS (SELECT sum(a) AS na, sum(b) AS nb FROM x),
e AS (SELECT a, b, (a + b) * na / (na + nb) AS ea, (a + b) * nb / (na + nb) AS eb FROM x, t),
q AS (SELECT sum((a - ea) * (a - ea) / ea + (b - eb) * (b - eb) / eb) AS c, count(*) - 1 AS dof FROM e)
SELECT 'ks' AS test, round(CASE WHEN lam < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0, p)) END, 6) AS p_value FROM p
UNION ALL SELECT 'chi-square', round(CASE dof WHEN 4 THEN exp(-c / 2) * (1 + c / 2) WHEN 2 THEN exp(-c / 2) END, 6) FROM q"""
)
def p_values(spark, folder):
    """Kolmogorov's series, and the chi-square tail (SQL has its closed form for the even numbers of freedom that occur)."""
    ev, o = load(spark, folder, "events"), load(spark, folder, "orders")
    click, purchase = (ev.filter(F.col("event_type") == t) for t in ("click", "purchase"))
    ks = comparison.ks_2samp(click, purchase, "value").select(F.lit("ks").alias("test"), "p_value")
    a, b = (o.filter(F.col("o_orderstatus") == s) for s in "FO")
    return rounded(ks.unionByName(comparison.chi_square(a, b, "o_orderpriority").select(F.lit("chi-square").alias("test"), "p_value")))


T_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount"]


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", na AS n_a, nb AS n_b, na + nb - 2 AS dof,
round((ma - mb) / sqrt(((na - 1) * va + (nb - 1) * vb) / (na + nb - 2) * (1 / na + 1 / nb)), 6) AS t FROM
(SELECT count({c}) FILTER (l_returnflag = 'A') AS na, count({c}) FILTER (l_returnflag = 'R') AS nb,
avg({c}) FILTER (l_returnflag = 'A') AS ma, avg({c}) FILTER (l_returnflag = 'R') AS mb,
var_samp({c}) FILTER (l_returnflag = 'A') AS va, var_samp({c}) FILTER (l_returnflag = 'R') AS vb FROM lineitem)"""
        for c in T_COLUMNS
    )
)
def t_statistic(spark, folder):
    li = load(spark, folder, "lineitem")
    a, b = (li.filter(F.col("l_returnflag") == f) for f in "AR")
    return rounded(comparison.t_stat(a, b, T_COLUMNS))


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", round(greatest(0.0, 1 - 2 * sum(CASE WHEN k IN (0, 4000) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END
* exp(lgamma((dof + 1) / 2.0) - lgamma(dof / 2.0)) / sqrt(dof * pi()) * pow(1 + pow(k * t / 4000.0, 2) / dof, -(dof + 1) / 2.0)) * any_value(t) / 12000.0), 6) AS p_value FROM
(SELECT na + nb - 2 AS dof, abs((ma - mb) / sqrt(((na - 1) * va + (nb - 1) * vb) / (na + nb - 2) * (1 / na + 1 / nb))) AS t FROM
(SELECT count({c}) FILTER (l_returnflag = 'A') AS na, count({c}) FILTER (l_returnflag = 'R') AS nb,
avg({c}) FILTER (l_returnflag = 'A') AS ma, avg({c}) FILTER (l_returnflag = 'R') AS mb,
var_samp({c}) FILTER (l_returnflag = 'A') AS va, var_samp({c}) FILTER (l_returnflag = 'R') AS vb FROM lineitem)), range(0, 4001) r(k)"""
        for c in T_COLUMNS
    )
)
def t_p_values(spark, folder):
    """Two-sided tails of Student's t; SQL adds up the density by Simpson's rule."""
    li = load(spark, folder, "lineitem")
    a, b = (li.filter(F.col("l_returnflag") == f) for f in "AR")
    return rounded(comparison.ttest_ind(a, b, T_COLUMNS).select("column", "p_value"))


@query(
    """SELECT event_id, hour, value FROM (SELECT event_id, hour(ts) AS hour, value FROM events
ORDER BY md5('3:' || event_id), event_id LIMIT 500)"""
)
def pair_points(spark, folder):
    ev = load(spark, folder, "events").select("event_id", F.hour("ts").cast("bigint").alias("hour"), "value")
    return comparison.pair_points(ev, "hour", "value", 500, "event_id", 3)


@query(
    """WITH p AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x, CAST(embedding[1:8] AS DOUBLE[]) AS e FROM embeddings),
k AS (SELECT * FROM p WHERE vec_id % 50 = 0),
d AS (SELECT a.vec_id AS i, b.vec_id AS j, list_distance(a.x, b.x) AS dx,
list_distance(a.e, b.e) AS de FROM k a JOIN p b ON a.vec_id <> b.vec_id),
r AS (SELECT i, row_number() OVER (PARTITION BY i ORDER BY dx, j) AS rx, row_number() OVER (PARTITION BY i ORDER BY de, j) AS re FROM d)
SELECT (SELECT count(*) FROM p) AS n, (SELECT count(*) FROM k) AS anchors,
round(1 - 2 / ((SELECT count(*) FROM k) * 5 * (2.0 * (SELECT count(*) FROM p) - 15 - 1)) * CAST(sum(greatest(rx - 5, 0)) AS DOUBLE), 6) AS trust
FROM r WHERE re <= 5"""
)
def trust(spark, folder):
    e = load(spark, folder, "embeddings").select("vec_id", "embedding", F.slice("embedding", 1, 8).alias("small"))
    return rounded(comparison.trustworthiness(e, "embedding", "small", "vec_id", e.filter("vec_id % 50 = 0").select("vec_id"), 5))
