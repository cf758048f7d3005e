"""Deterministic adapter: the driver's TPC-H style tables -> the five raw
shapes of the reporting pipeline (all columns strings).

nation -> sites (every nation; some with two versions), lineitem x supplier
-> readings (every line), orders -> incidents, part -> the metric catalogue
(one metric per brand) and, with it, the units. Dirt is made by relabelling,
never by leaving rows out: modular rules on integer keys, so that Spark and
the SQL oracle build identical strings, give country aliases and stray
spaces, acquisitions and divestments, unlisted sites, an undefined metric,
unparseable periods, values and timestamps, negative values, unknown units,
bad period types, quarterly hours, restatements and repeated incidents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Metrics that the KPIs read, in the order of the brands that
# stand for them: code, category, canonical unit.
CORE_METRICS = [
    ("SCOPE1_GHG", "Air", "t"),
    ("SCOPE2_GHG", "Air", "t"),
    ("ENERGY_CONS", "Power", "MWh"),
    ("WATER_WD", "Water", "m3"),
    ("WASTE_TOTAL", "Residues", "t"),
    ("HOURS_WORKED", "People", "hours"),
]

# Unit conversions (from, to, factor as text). Litres are listed
# twice, so one lookup fans out.
UNIT_FACTORS = [
    ("kWh", "MWh", "0.001"),
    ("MWh", "MWh", "1"),
    ("GJ", "MWh", "0.2777777778"),
    ("kg", "t", "0.001"),
    ("t", "t", "1"),
    ("m3", "m3", "1"),
    ("l", "m3", "0.001"),
    ("l", "m3", "0.0010"),
    ("hours", "hours", "1"),
]

# The adapter's reporting window (first month, number of months).
ADAPTER_WINDOW = ("1999-01", 24)

TABLES = ["region", "nation", "supplier", "lineitem", "orders", "part"]

# Tasks that lineitem and orders are dealt out to by their key, for inputs of
# one large row group; not set, they are read as they lie.
DEAL_OUT = "spark.greenledger.adapter.partitions"
DEALT = {"lineitem": "l_orderkey", "orders": "o_orderkey"}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    n = spark.conf.get(DEAL_OUT, None)
    return df.repartition(int(n), DEALT[name]) if n and name in DEALT else df


def _s(c: Column) -> Column:
    return c.cast("string")


def adapt_sites(nation: DataFrame, region: DataFrame) -> DataFrame:
    n = F.col("n_nationkey")
    j = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    country = (F.when(n % 5 == 0, F.lit("Germany"))
               .when(n % 5 == 1, F.lit(" usa "))
               .when(n % 5 == 2, F.lit("germany "))
               .otherwise(F.concat(F.lit("C"), _s(n))))
    until = (F.when(n % 8 == 5, F.lit("2000-06-30")).when(n % 8 == 6, F.lit("2000-09-17"))
             .otherwise(F.lit("")))
    since = F.when(n % 8 == 3, F.lit("1999-04-15")).otherwise(F.lit("1995-01-01"))

    def version(extra: int, valid_from: Column, valid_to: Column) -> Column:
        return F.struct(_s(n * 50 + 200 + extra).alias("headcount"),
                        valid_from.alias("valid_from"), valid_to.alias("valid_to"))

    # nations that were reorganised have a closed and an open version
    versions = F.when(n % 8 == 2, F.array(
        version(0, F.lit("1995-01-01"), F.lit("1999-09-30")),
        version(25, F.lit("1999-10-01"), F.lit("")))).otherwise(F.array(version(0, since, until)))
    return j.select(
        _s(n + 101).alias("site_id"),
        F.when(n % 7 == 1, F.concat(F.col("n_name"), F.lit(" "))).otherwise(F.col("n_name"))
        .alias("site_name"),
        country.alias("country"),
        F.lower(F.col("r_name")).alias("region"),
        F.concat(F.lit("BU"), _s(n % 4)).alias("business_unit"),
        F.explode(versions).alias("v"),
    ).select("site_id", "site_name", "country", "region", "business_unit", "v.headcount",
             "v.valid_from", "v.valid_to")


def adapt_metric_definitions(part: DataFrame) -> DataFrame:
    """One metric per brand: the first brands are the core metrics, the others the
    output of that brand."""
    brand = F.regexp_extract("p_brand", r"(\d+)$", 1).cast("int")
    core = F.col("no").between(1, len(CORE_METRICS))

    def pick(i: int) -> Column:
        return F.element_at(F.array(*[F.lit(m[i]) for m in CORE_METRICS]), F.col("no"))

    return (part.select("p_brand", brand.alias("no")).distinct().select(
        F.when(core, pick(0)).otherwise(F.concat(F.lit("OUTPUT_"), _s(F.col("no")))).alias("metric_code"),
        F.concat(F.lit(" Total of "), F.col("p_brand")).alias("metric_name"),
        F.when(core, pick(1)).otherwise(F.lit("Output")).alias("category"),
        F.when(core, pick(2)).otherwise(F.lit("pieces")).alias("canonical_uom"),
        F.when(core | (F.col("no") % 2 == 0), F.lit("Y")).otherwise(F.lit("n")).alias("is_additive")))


def adapt_uom_conversions(spark: SparkSession, metrics: DataFrame, part: DataFrame) -> DataFrame:
    """Factors into the units of the catalogue, and packs of each part type, whose
    size is the smallest of that type."""
    factors = spark.createDataFrame(UNIT_FACTORS, "from_uom string, to_uom string, factor string")
    units = metrics.select(F.col("canonical_uom").alias("to_uom")).distinct()
    packs = part.groupBy("p_type").agg(F.min("p_size").alias("size"))
    return (factors.join(units, "to_uom").select("from_uom", "to_uom", "factor")
            .unionByName(packs.select(F.concat(F.lower("p_type"), F.lit(" pack")).alias("from_uom"),
                                      F.lit("pieces").alias("to_uom"), _s(F.col("size")).alias("factor"))))


def _reading_keys(lineitem: DataFrame, supplier: DataFrame) -> DataFrame:
    li = lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                         "l_quantity", "l_shipdate")
    sup = supplier.select("s_suppkey", "s_nationkey")
    j = li.join(sup, F.col("l_suppkey") == F.col("s_suppkey"))
    k = (F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 100000 + F.col("l_partkey")
    return j.select(
        k.alias("k"),
        (k * 1000 + F.col("l_suppkey")).alias("rid"),
        F.col("s_nationkey").cast("bigint").alias("n"),
        F.col("l_linenumber").cast("bigint").alias("ln"),
        F.col("l_quantity").cast("bigint").alias("q"),
        F.year("l_shipdate").cast("bigint").alias("y"),
        F.month("l_shipdate").cast("bigint").alias("m"),
        F.col("l_shipdate").alias("ship"),
    )


def _unit(k: Column, slot: Column) -> Column:
    return (F.when(k % 227 == 0, F.lit("gal"))
            .when(slot.isin(1, 2, 5), F.when(k % 2 == 0, F.lit("t")).otherwise(F.lit("kg")))
            .when(slot == 3, F.when(k % 3 == 0, F.lit("kWh"))
                  .when(k % 3 == 1, F.lit("MWh")).otherwise(F.lit("GJ")))
            .when(slot == 4, F.when(k % 2 == 0, F.lit("m3")).otherwise(F.lit("l")))
            .otherwise(F.lit("hours")))


def adapt_readings(lineitem: DataFrame, supplier: DataFrame) -> DataFrame:
    """One reading per line. Lines of the seventh slot report one of the first five
    metrics or, one in fifty, an undefined one; hours of every sixth nation are
    reported by quarter; all lines of some (nation, month, slot) cells name an
    unlisted site, which leaves gaps."""
    k, n, ln, q, m = (F.col(c) for c in ("k", "n", "ln", "q", "m"))
    slot = (F.when(ln < 7, ln).when(k % 50 == 0, F.lit(7)).otherwise(k % 5 + 1)).cast("int")
    r = _reading_keys(lineitem, supplier).withColumn("slot", slot)
    slot, quarterly = F.col("slot"), (F.col("slot") == 6) & (n % 6 == 0)
    codes = F.array(*[F.lit(code) for code, *_ in CORE_METRICS])
    unlisted = (n * 31 + F.col("y") * 84 + m * 7 + slot) % 509 == 0
    month = F.when(quarterly, F.ceil(m / 3) * 3).otherwise(m)
    value = (F.when(k % 211 == 0, F.lit("n/a"))
             .when(k % 223 == 0, F.concat(F.lit("-"), _s(q)))
             .when(slot == 6, _s(q * 400))
             .otherwise(_s(q)))
    return r.select(
        _s(F.col("rid")).alias("reading_id"),
        _s(F.when(unlisted, n + 901).otherwise(n + 101)).alias("site_id"),
        F.when(k % 239 == 0, F.lit("bad"))
        .otherwise(F.concat(_s(F.col("y")), F.lit("-"), F.lpad(_s(month), 2, "0"))).alias("period"),
        F.when(slot == 7, F.lit("UNDEFINED")).otherwise(F.get(codes, slot - 1)).alias("metric_code"),
        value.alias("value"),
        _unit(k, slot).alias("uom"),
        F.when(k % 229 == 0, F.lit("X")).when(quarterly, F.lit("Q")).otherwise(F.lit("M"))
        .alias("period_type"),
        F.lit("PORTAL").alias("source_system"),
        F.when(k % 233 == 0, F.lit("not-a-date"))
        .otherwise(F.concat(F.date_format("ship", "yyyy-MM-dd"), F.lit(" 08:00:00")))
        .alias("submitted_at"),
    )


def adapt_incidents(orders: DataFrame) -> DataFrame:
    o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
                      "o_orderpriority")
    key = F.col("o_orderkey")

    def shape(extra_days: int, reporter: str) -> list[Column]:
        return [
            _s(key).alias("incident_id"),
            _s(F.col("o_custkey") % 25 + 101).alias("site_id"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("incident_date"),
            F.concat(F.lit("T"), _s(key % 6)).alias("incident_type"),
            F.col("o_orderpriority").alias("severity"),
            F.when(F.col("o_orderstatus") == "F", F.lit("Y")).otherwise(F.lit("N"))
            .alias("is_recordable"),
            _s(key % 30 + extra_days).alias("lost_days"),
            F.lit(reporter).alias("reported_by"),
        ]

    first = o.select(*shape(0, "Line Manager"))
    repeat = o.filter(key % 40 == 0).select(*shape(5, "EHS Officer"))
    return first.unionByName(repeat)


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five raw (all-string) tables derived from the driver's tables."""
    t = {name: read_table(spark, sf_dir, name) for name in TABLES}
    metrics = adapt_metric_definitions(t["part"])
    return {
        "sites": adapt_sites(t["nation"], t["region"]),
        "metric_definitions": metrics,
        "uom_conversions": adapt_uom_conversions(spark, metrics, t["part"]),
        "readings": adapt_readings(t["lineitem"], t["supplier"]),
        "incidents": adapt_incidents(t["orders"]),
    }


# The day that the snapshot as_known() stands for.
KNOWN_UNTIL = "2000-06-30"


def as_known(raw: dict[str, DataFrame], until: str = KNOWN_UNTIL) -> dict[str, DataFrame]:
    """The raw tables as they stood at the end of a day: without later submissions, and with
    sites open whose end was still to come."""
    ended = F.col("valid_to") > until
    return raw | {
        "readings": raw["readings"].where(F.substring("submitted_at", 1, 10) <= until),
        "sites": raw["sites"].withColumn("valid_to", F.when(ended, F.lit("")).otherwise(F.col("valid_to")))}


def before_corrections(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The raw tables before a round of corrections to a few months: of May 2000 some
    readings were still missing and some had another value, of August 1999 some were
    there that have been withdrawn since, and of February 2000 some incidents were
    missing or had more lost days."""
    r, i = raw["readings"], raw["incidents"]
    last = F.substring("reading_id", -1, 1)
    may = F.col("period") == "2000-05"
    august = r.where((F.col("period") == "1999-08") & last.isin("2", "5"))
    february = F.substring("incident_date", 1, 7) == "2000-02"
    digit = F.substring("incident_id", -1, 1)
    return raw | {
        "readings": r.where(~(may & (last == "3")))
        .withColumn("value", F.when(may & (last == "7"), F.lit("1")).otherwise(F.col("value")))
        .unionByName(august.withColumns({"reading_id": F.concat("reading_id", F.lit("9")), "submitted_at": F.lit("2001-01-05 08:00:00")})),
        "incidents": i.where(~(february & (digit == "5")))
        .withColumn("lost_days", F.when(february & (digit == "4"), F.concat("lost_days", F.lit("0"))).otherwise(F.col("lost_days")))}


def damaged_lines(readings: DataFrame) -> DataFrame:
    """(line): a readings file's lines, some of them cut short, with a field too many, or
    with a quote that is opened and not closed, in the middle or in the last field."""
    n = F.expr("try_cast(reading_id AS bigint)")
    head = F.concat_ws(",", *readings.columns[:-1])
    last = F.col(readings.columns[-1])
    return readings.select(
        F.when(n % 97 == 0, head).when(n % 101 == 0, F.concat_ws(",", head, last, F.lit("more")))
        .when(n % 103 == 0, F.concat_ws(",", F.concat(F.lit('"'), head), last))
        .when(n % 107 == 0, F.concat_ws(",", head, F.concat(F.lit('"'), last)))
        .otherwise(F.concat_ws(",", head, last)).alias("line"))


def adapt_contracts(orders: DataFrame) -> DataFrame:
    """(customer, valid_from, valid_to): each order holds for its customer for up to 700 days;
    one in 40 is open and one in 90 ends before it begins."""
    k, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    until = F.date_add(day, F.when(k % 90 == 7, F.lit(-3)).otherwise(k % 701).cast("int"))
    return orders.select(F.col("o_custkey").alias("customer"), day.alias("valid_from"), F.when(k % 40 != 5, until).alias("valid_to"))


# Batches that event_batches() deals submissions to, the files of one, and
# the delay that is allowed.
EVENT_BATCHES, BATCH_FILES, EVENT_DELAY = 6, 2, "36 hours"


def event_batches(events: DataFrame) -> DataFrame:
    """Events as submissions (user_id, event_type, submitted_at, submission_id, value) that come
    in numbered batches, a batch for every sixth of the span of days; one in 17 comes two
    batches later than its time."""
    day = F.unix_date(F.col("ts").cast("date"))
    ends = events.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    timed = events.where("user_id IS NOT NULL AND event_type IS NOT NULL AND ts IS NOT NULL").select(
        "user_id", "event_type", F.col("ts").cast("timestamp").alias("submitted_at"), F.col("event_id").alias("submission_id"),
        (F.col("event_id") % 100).cast("string").alias("value"), day.alias("day"), F.lit(1).alias("one"))
    batch = F.floor((F.col("day") - F.col("first")) * EVENT_BATCHES / (F.col("last") - F.col("first") + 1)).cast("int")
    late = F.when(F.col("submission_id") % 17 == 0, F.lit(2)).otherwise(F.lit(0))
    rows = timed.join(ends.withColumn("one", F.lit(1)), "one")
    return rows.withColumn("batch", F.least(batch + late, F.lit(EVENT_BATCHES - 1))).drop("day", "first", "last", "one")
