"""Stand-in inputs: the driver's test tables in the shapes of the API documents.

These functions only build rows in the schemas the operators expect; they do
none of the operators' work. The mapping (fixed, documented in FIXTURES.md §4):

* events.event_type → parameter id: click 1, error 2, purchase 3, signup 4, view 5
* a customer is a location, its distinct (user_id, event_type) events are its
  sensors (sensor id = user_id * 10 + parameter id), an event is a measurement
* a nation is a country and a rectangular commune, a supplier is a provider
* offsets appended to local datetimes cycle over ``+01:00``, ``-05:00``, ``Z``
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Event type → parameter id.
PARAMETER_IDS = [("click", 1), ("error", 2), ("purchase", 3), ("signup", 4), ("view", 5)]
# Offsets by key % 3.
OFFSETS = ["+01:00", "-05:00", "Z"]
# Commune rectangles (origin (n % 5) * 2, (n div 5) * 2, side 1.8).
COMMUNE_STEP = 2.0
COMMUNE_SIDE = 1.8

_PARAM_ARRAY = "array<struct<id:int,name:string,units:string,displayName:string,description:string>>"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ntz_text(ts: Column, chars: int = 19) -> Column:
    """ISO text ``yyyy-MM-ddTHH:mm:ss`` (or its first ``chars``) of a
    ``timestamp_ntz``, without passing through the session time zone."""
    return F.replace(F.substring(ts.cast("timestamp_ntz").cast("string"), 1, chars), F.lit(" "), F.lit("T"))


def parameter_id(event_type: Column) -> Column:
    expr = None
    for name, pid in PARAMETER_IDS:
        expr = (F.when(event_type == name, F.lit(pid)) if expr is None else expr.when(event_type == name, F.lit(pid)))
    return expr.otherwise(F.lit(None).cast("int"))


def parameter_struct(pid: Column, name: Column) -> Column:
    return F.struct(
        pid.cast("int").alias("id"),
        name.alias("name"),
        F.concat(F.lit("u"), pid.cast("string")).alias("units"),
        F.upper(name).alias("displayName"),
        F.lit(None).cast("string").alias("description"),
    )


def offset(key: Column) -> Column:
    k = F.pmod(key, F.lit(3))
    return F.when(k == 0, F.lit(OFFSETS[0])).when(k == 1, F.lit(OFFSETS[1])).otherwise(F.lit(OFFSETS[2]))


def _all_parameters() -> Column:
    return F.array(*[parameter_struct(F.lit(pid), F.lit(name)) for name, pid in PARAMETER_IDS])


def _build_raw_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One parameter document per distinct event type of ``events``."""
    ev = table(spark, sf_dir, "events").select("event_type").distinct()
    p = parameter_struct(parameter_id(F.col("event_type")), F.col("event_type"))
    return ev.select(p.alias("p")).select("p.*")


def _build_raw_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country documents: every nation that has stations (customers), with the
    parameters measured at its stations (distinct event types of its
    customers' events, by id; empty when none)."""
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    kinds = table(spark, sf_dir, "events").select("user_id", "event_type").distinct()
    measured = (
        cust.join(kinds, cust["c_custkey"] == kinds["user_id"])
        .select("c_nationkey", "event_type")
        .distinct()
        .groupBy("c_nationkey")
        .agg(F.array_sort(F.collect_list(parameter_struct(parameter_id(F.col("event_type")),
                                                          F.col("event_type")))).alias("parameters"))
    )
    countries = cust.select("c_nationkey").distinct()
    n = F.col("c_nationkey")
    return (
        countries.join(nation, countries["c_nationkey"] == nation["n_nationkey"], "left")
        .join(measured, "c_nationkey", "left")
        .select(
            n.cast("int").alias("id"),
            F.concat(F.lit("N"), n.cast("string")).alias("code"),
            F.lit(None).cast("string").alias("datetimeFirst"),
            F.lit(None).cast("string").alias("datetimeLast"),
            F.col("n_name").alias("name"),
            F.coalesce(F.col("parameters"), F.array().cast(_PARAM_ARRAY)).alias("parameters"),
        )
    )


def _build_raw_providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provider documents from ``supplier``; parameters p with (s + p) % 2 = 0,
    an empty list when s % 7 = 0."""
    s = F.col("s_suppkey")
    params = F.when(F.pmod(s, F.lit(7)) == 0, F.array().cast(_PARAM_ARRAY)).otherwise(
        F.filter(_all_parameters(), lambda p: F.pmod(s + p["id"], F.lit(2)) == 0)
    )
    return table(spark, sf_dir, "supplier").select(
        s.cast("int").alias("id"),
        F.col("s_name").alias("name"),
        F.lower(F.col("s_name")).alias("sourceName"),
        F.lit(None).cast("string").alias("datetimeAdded"),
        F.lit(None).cast("string").alias("datetimeFirst"),
        F.lit(None).cast("string").alias("datetimeLast"),
        params.alias("parameters"),
    )


def _sensor_struct(user_id: Column, event_type: Column) -> Column:
    pid = parameter_id(event_type)
    return F.struct(
        (user_id * 10 + pid).cast("int").alias("id"),
        F.concat(event_type, F.lit("-"), user_id.cast("string")).alias("name"),
        F.struct(
            pid.cast("int").alias("id"),
            event_type.alias("name"),
            F.concat(F.lit("u"), pid.cast("string")).alias("units"),
            F.upper(event_type).alias("displayName"),
        ).alias("parameter"),
    )


def _build_raw_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Location documents from ``customer`` (+ nation, last order date, and the
    customer's distinct event types as sensors)."""
    cust = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    last_order = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.max("o_orderdate").alias("last_order"))
    )
    sensors = (
        table(spark, sf_dir, "events")
        .select("user_id", "event_type")
        .distinct()
        .groupBy("user_id")
        .agg(F.array_sort(F.collect_list(_sensor_struct(F.col("user_id"), F.col("event_type")))).alias("sensors"))
    )
    k = F.col("c_custkey")
    day = ntz_text(F.col("last_order"), 10)
    local = F.concat(day, F.lit("T12:00:00"), offset(k))
    joined = (
        cust.join(nation, cust["c_nationkey"] == nation["n_nationkey"], "left")
        .join(last_order, cust["c_custkey"] == last_order["o_custkey"], "left")
        .join(sensors, cust["c_custkey"] == sensors["user_id"], "left")
    )
    return joined.select(
        k.cast("int").alias("id"),
        F.col("c_name").alias("name"),
        F.lit(False).alias("isMobile"),
        (F.col("c_acctbal") >= 0).alias("isMonitor"),
        F.struct(
            F.pmod(k, F.lit(10)).cast("int").alias("id"),
            F.concat(F.lit("provider-"), F.pmod(k, F.lit(10)).cast("string")).alias("name"),
        ).alias("provider"),
        F.struct(
            F.col("c_nationkey").cast("int").alias("id"),
            F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("code"),
            F.col("n_name").alias("name"),
        ).alias("country"),
        F.struct(
            (F.pmod(k * 91, F.lit(1000)) / 100.0).cast("float").alias("latitude"),
            (F.pmod(k * 37, F.lit(1000)) / 100.0).cast("float").alias("longitude"),
        ).alias("coordinates"),
        F.struct(F.lit(None).cast("string").alias("utc"), F.lit(None).cast("string").alias("local")).alias(
            "datetimeFirst"
        ),
        F.struct(F.concat(day, F.lit("T12:00:00Z")).alias("utc"), local.alias("local")).alias("datetimeLast"),
        F.col("sensors"),
    )


def _build_raw_measurements(spark: SparkSession, sf_dir: str, with_event_id: bool = False) -> DataFrame:
    """Measurement documents (request key attached) from ``events``."""
    ev = table(spark, sf_dir, "events")
    extra = [F.col("event_id")] if with_event_id else []
    pid = parameter_id(F.col("event_type"))
    ts_text = ntz_text(F.col("ts"))
    to_text = ntz_text(F.col("ts") + F.expr("INTERVAL 1 HOUR"))
    k = F.get_json_object(F.col("props"), "$.k").try_cast("int")
    return ev.select(
        (F.col("user_id") * 10 + pid).cast("int").alias("sensor_id"),
        F.col("value").cast("float").alias("value"),
        parameter_struct(pid, F.col("event_type")).alias("parameter"),
        F.struct(
            F.lit("raw").alias("label"),
            F.lit("01:00:00").alias("interval"),
            F.struct(F.concat(ts_text, F.lit("Z")).alias("utc"), F.concat(ts_text, offset(F.col("event_id"))).alias("local")).alias("datetimeFrom"),
            F.struct(F.concat(to_text, F.lit("Z")).alias("utc"), F.concat(to_text, offset(F.col("event_id"))).alias("local")).alias("datetimeTo"),
        ).alias("period"),
        F.struct(
            F.lit(1).alias("expectedCount"),
            F.pmod(k, F.lit(25)).alias("observedCount"),
            F.lit(None).cast("float").alias("percentComplete"),
            F.lit(None).cast("float").alias("percentCoverage"),
        ).alias("coverage"),
        *extra,
    )


def _build_communes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commune reference from ``nation``: a 1.8-wide square per nation."""
    n = F.col("n_nationkey")
    x0 = (F.pmod(n, F.lit(5)) * 2).cast("double")
    y0 = F.floor(n / 5).cast("double") * 2.0
    side = F.lit(COMMUNE_SIDE).cast("double")
    ring = F.array(
        F.struct(x0.alias("x"), y0.alias("y")),
        F.struct((x0 + side).alias("x"), y0.alias("y")),
        F.struct((x0 + side).alias("x"), (y0 + side).alias("y")),
        F.struct(x0.alias("x"), (y0 + side).alias("y")),
    )
    code = n.cast("string")
    return table(spark, sf_dir, "nation").select(
        code.alias("code"),
        F.col("n_name").alias("nom"),
        F.when(F.pmod(n, F.lit(4)) == 0, F.array().cast("array<string>")).otherwise(F.array(code)).alias("codesPostaux"),
        ((n + 1) * 1000).cast("int").alias("population"),
        ring.alias("ring"),
    )


def communes_with_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Communes of several rings from ``nation``: the square of ``communes`` with a hole (n % 3 = 0) or with a second part
    that reaches into the next square (n % 3 = 1), and one commune ``zz`` over nearly all of them."""
    n = F.col("n_nationkey")
    x, y = (F.pmod(n, F.lit(5)) * 2).cast("double"), F.floor(n / 5).cast("double") * 2.0

    def box(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
        return F.array(*[F.struct(a.alias("x"), b.alias("y")) for a, b in ((x0, y0), (x1, y0), (x1, y1), (x0, y1))])

    square = box(x, y, x + F.lit(COMMUNE_SIDE), y + F.lit(COMMUNE_SIDE))
    rings = (F.when(F.pmod(n, F.lit(3)) == 0, F.array(square, box(x + 0.5, y + 0.5, x + 1.0, y + 1.0)))
             .when(F.pmod(n, F.lit(3)) == 1, F.array(square, box(x + 2.25, y, x + 2.75, y + 1.0)))
             .otherwise(F.array(square)))
    nation = table(spark, sf_dir, "nation")
    fields = [F.array().cast("array<string>").alias("codesPostaux"), F.lit(1).alias("population")]
    low, high = F.lit(0.0), F.lit(9.5)
    everything = nation.where(n == 0).select(F.lit("zz").alias("code"), F.lit("ALL").alias("nom"), *fields,
                                             F.array(box(low, low, high, high)).alias("rings"))
    return nation.select(n.cast("string").alias("code"), F.col("n_name").alias("nom"), *fields, rings.alias("rings")).union(everything)


# ---------------------------------------------------------------- landing zones

def _day_page() -> Column:
    """Per-sensor pages: local day and a block of 1000 event ids (``yyyymmdd-k``),
    so a page holds at most 1000 documents even for a hot sensor-day."""
    day = F.regexp_replace(F.substring(F.col("period.datetimeFrom.local"), 1, 10), "-", "")
    return F.concat(day, F.lit("-"), F.floor(F.col("event_id") / 1000).cast("string"))


# Fixed value: the API's location page size.
LOCATION_PAGE_SIZE = 1000


def land_locations(spark: SparkSession, sf_dir: str, path: str, page_size: int = LOCATION_PAGE_SIZE,
                   one_page_per_file: bool = True) -> None:
    from aeris.sources.landed import write_pages

    write_pages(raw_locations(spark, sf_dir), path, F.floor(F.col("id") / page_size).cast("int"),
                one_page_per_file=one_page_per_file)


def land_broken_location_pages(spark: SparkSession, sf_dir: str, path: str, every: int = 5,
                               page_size: int = LOCATION_PAGE_SIZE) -> None:
    """Append a truncated copy of every ``every``-th location page (bad JSON)."""
    docs = raw_locations(spark, sf_dir).withColumn("page", F.floor(F.col("id") / page_size).cast("int"))
    body = [c for c in docs.columns if c != "page"]
    pages = (
        docs.where(F.pmod(F.col("page"), F.lit(every)) == 0)
        .groupBy("page")
        .agg(F.to_json(F.struct(F.collect_list(F.struct(*body)).alias("results"))).alias("value"))
    )
    pages.select("page", F.expr("substring(value, 1, length(value) div 2)").alias("value")).write.mode(
        "append"
    ).partitionBy("page").text(path)


def land_measurements(spark: SparkSession, sf_dir: str, path: str, sensor_folders: bool = False,
                      one_page_per_file: bool = True, compression: str | None = None) -> None:
    """Land measurement pages.

    ``sensor_folders=True``: the per-sensor request layout
    ``sensor_id=<id>/page=<yyyymmdd-k>`` (key only in the folder name; one
    small file per sensor-day). Default: bulk pages of 1000 documents that carry
    ``sensor_id`` themselves.
    """
    from aeris.sources.landed import write_pages

    if sensor_folders:
        write_pages(raw_measurements(spark, sf_dir, with_event_id=True), path, _day_page(),
                    partition_by=["sensor_id"], drop=["event_id"])
    else:
        write_pages(raw_measurements(spark, sf_dir, with_event_id=True), path,
                    F.floor(F.col("event_id") / 1000).cast("int"), drop=["event_id"],
                    one_page_per_file=one_page_per_file, compression=compression)


def land_measurements_by_sensor(spark: SparkSession, sf_dir: str, path: str, block: int = 500) -> None:
    """Land measurements as JSON lines in ``sensor_id=<id>`` folders, one folder for each ``block`` of sensor ids, named by the
    first. Documents of that sensor carry none, the others carry their own."""
    from aeris.sources.landed import page_texts

    docs = raw_measurements(spark, sf_dir, with_event_id=True)
    folder = F.col("sensor_id") - F.pmod(F.col("sensor_id"), F.lit(block)) + 1
    body = F.struct(F.when(F.col("sensor_id") != folder, F.col("sensor_id")).alias("sensor_id"), "value", "parameter", "period",
                    "coverage")
    dealt = (docs.select(folder.alias("folder"), F.floor(F.col("event_id") / 1000).alias("page"), F.to_json(body).alias("doc"))
             .repartition("folder"))  # one file per folder
    lines = page_texts(dealt, ["folder", "page"], "doc").select(F.col("folder").alias("sensor_id"), "value")
    lines.write.mode("overwrite").partitionBy("sensor_id").text(path, compression="gzip")


def land_odd_measurements(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Land measurement pages of 1000 events, with faults by event id and by page number (modulo 10), each in the folder of
    its file's first sensor: documents of that sensor carry none, the others their own.

    Event % 11: 0 has no local datetime, 1 a broken one, 2 one to the minute. Page % 10: 1 holds an element that is no
    object, 2 is pretty-printed, 3 has text after it, 4 is truncated, 5 and 6 lie as two lines of one file with an empty
    page between, the rest are files of one line."""
    docs = raw_measurements(spark, sf_dir, with_event_id=True)
    fault = F.pmod(F.col("event_id"), F.lit(11))
    local = F.col("period.datetimeFrom.local")
    local = (F.when(fault == 0, F.lit(None).cast("string")).when(fault == 1, F.concat(F.lit("n/a "), local))
             .when(fault == 2, F.substring(local, 1, 16)).otherwise(local))
    period = F.struct(F.col("period.label").alias("label"), F.col("period.interval").alias("interval"),
                      F.struct(F.col("period.datetimeFrom.utc").alias("utc"), local.alias("local")).alias("datetimeFrom"),
                      F.col("period.datetimeTo").alias("datetimeTo"))
    page, kind = F.floor(F.col("event_id") / 1000).alias("page"), F.col("page") % 10
    file = F.when(kind == 6, F.col("page") - 1).otherwise(F.col("page"))
    folders = docs.select("sensor_id", page).groupBy(file.alias("file")).agg(F.min("sensor_id").alias("folder"))
    doc = F.struct(F.when(F.col("sensor_id") != F.col("folder"), F.col("sensor_id")).alias("sensor_id"), "value", "parameter",
                   period.alias("period"), "coverage")
    pages = (docs.withColumn("page", page).withColumn("file", file).join(folders, "file")
             .select("page", "folder", doc.alias("doc")).groupBy("page", "folder").agg(
                 F.to_json(F.struct(F.collect_list("doc").alias("results"))).alias("value")))
    text = (F.when(kind == 1, F.regexp_replace("value", r"^\{\"results\":\[", '{"results":["no object",'))
            .when(kind == 2, F.regexp_replace("value", r"^\{\"results\":\[", '{\n  "results": [\n'))
            .when(kind == 3, F.concat("value", F.lit(" and more")))
            .when(kind == 4, F.expr("substring(value, 1, length(value) div 2)"))
            .when(kind == 6, F.concat(F.lit('{"results":[]}\n'), F.col("value")))
            .otherwise(F.col("value")))
    files = (pages.select(file.alias("page"), F.col("folder").alias("sensor_id"), F.struct(F.col("page").alias("at"), text.alias("text")).alias("t"))
             .groupBy("sensor_id", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list("t")), lambda t: t["text"]), "\n").alias("value")))
    files.write.mode("overwrite").partitionBy("sensor_id", "page").text(path)


def land_all(spark: SparkSession, sf_dir: str, root: str, one_page_per_file: bool = True, measurements: bool = True):
    """Land every stand-in source under ``root``; return an ``etl.Landing``.

    ``one_page_per_file=False`` lands JSON lines (many pages per file)."""
    from aeris.plans.etl import Landing
    from aeris.sources.landed import write_pages

    root = root.rstrip("/")
    kw = {"one_page_per_file": one_page_per_file}
    write_pages(raw_parameters(spark, sf_dir), f"{root}/parameters", F.lit(0), **kw)
    write_pages(raw_countries(spark, sf_dir), f"{root}/countries", F.floor(F.col("id") / 10).cast("int"), **kw)
    write_pages(raw_providers(spark, sf_dir), f"{root}/providers", F.floor(F.col("id") / 100).cast("int"), **kw)
    land_locations(spark, sf_dir, f"{root}/locations", **kw)
    if measurements:
        land_measurements(spark, sf_dir, f"{root}/measurements", compression=None if one_page_per_file else "gzip", **kw)
    communes(spark, sf_dir).write.mode("overwrite").parquet(f"{root}/communes")
    return Landing(
        parameters=f"{root}/parameters",
        countries=f"{root}/countries",
        providers=f"{root}/providers",
        locations=f"{root}/locations",
        measurements=f"{root}/measurements",
        communes=f"{root}/communes",
        layout="page" if one_page_per_file else "lines",
    )


# ---------------------------------------------------------------- limits cells

def _build_limit_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of regulatory-limit tables from ``part``: table = p_partkey div 8,
    row = p_partkey % 8; row 0 holds a title, later rows indicator / limit
    text / criterion, in the shapes found in the printed tables (titles with
    subscripts on a second line, several values per cell, empty and missing
    indicators, non-breaking spaces)."""
    p = table(spark, sf_dir, "part")
    k, s = F.col("p_partkey"), F.col("p_size")

    def txt(c: Column) -> Column:
        return c.cast("string")

    nl = F.lit("\n")
    t = F.col("p_type")
    title = (
        F.when(s % 6 == 0, F.concat(t, F.lit(" (CH)"), nl, F.lit("6 6")))
        .when(s % 6 == 1, F.lit(None).cast("string"))
        .when(s % 6 == 2, F.upper(F.col("p_name")))
        .when(s % 6 == 3, F.concat(t, nl, txt(s % 10)))
        .when(s % 6 == 4, F.concat(t, F.lit(" ( "), F.col("p_brand"), F.lit(" "), txt(s % 10), F.lit(" )"), nl,
                                   F.lit(" "), txt(s % 7), F.lit(" "), txt(s % 5), F.lit(" "), nl, F.lit("extra")))
        .otherwise(F.concat(t, F.lit(" (PM"), txt(s % 10), F.lit(","), txt(s % 3), F.lit(")")))
    )
    indicator = (
        F.when(s % 5 == 0, F.lit(""))
        .when(s % 5 == 1, F.lit(None).cast("string"))
        .when(s % 5 == 2, F.concat(F.lit("Valeur limite"), nl, F.col("p_name")))
        .when(s % 5 == 3, F.lit(" "))
        .otherwise(F.concat(F.lit("Moyenne "), t))
    )
    measure = (
        F.when(s % 7 == 0, F.lit("aucune valeur"))
        .when(s % 7 == 1, F.lit(""))
        .when(s % 7 == 2, F.lit(None).cast("string"))
        .when(s % 7 == 3, F.concat(txt(s), F.lit("\u00a0mg/m3 (UE)")))
        .when(s % 7 == 4, F.concat(txt(s), F.lit(" µg/m³ (FR)"), nl, F.lit(" "), txt(k % 50), F.lit(","),
                                   txt(s % 10), F.lit("  µg/m3 (UE)")))
        .when(s % 7 == 5, F.concat(F.lit("Seuil: "), txt(s), F.lit(" ng/m³ (FR) et "), txt(k % 9),
                                   F.lit(".5 mg/m³(UE)")))
        .otherwise(F.concat(F.lit("  "), F.col("p_name"), nl, nl, F.col("p_brand"), F.lit("  ")))
    )
    criterion = (
        F.when(k % 4 == 0, F.lit(None).cast("string"))
        .when(k % 4 == 1, F.concat(F.lit("Critère"), nl, F.col("p_brand")))
        .when(k % 4 == 2, F.lit(""))
        .otherwise(F.lit(" Année civile "))
    )
    row = (k % 8).cast("int")
    return p.select(
        F.floor(k / 8).cast("int").alias("table_no"),
        row.alias("row_no"),
        F.when(row == 0, title).otherwise(indicator).alias("c0"),
        F.when(row == 0, F.lit(None).cast("string")).otherwise(measure).alias("c1"),
        F.when(row == 0, F.lit(None).cast("string")).otherwise(criterion).alias("c2"),
    )


# ---------------------------------------------------------------- stored stand-ins
# A stand-in input is built once per Spark application and input folder, as a
# Parquet table under the shared folder, the way real inputs are landed tables:
# reports then scan it with pushed filters and only the columns they need.

_STORED: dict = {}


def _materialized(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    from aeris.session import scratch_path

    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    if key not in _STORED:
        df = build()
        path = scratch_path(spark, f"input-{name}")
        df.write.parquet(path)
        _STORED[key] = (path, df.schema)
    path, schema = _STORED[key]
    return spark.read.schema(schema).parquet(path)


def raw_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One parameter document per distinct event type of ``events``."""
    return _materialized(spark, sf_dir, "parameters", lambda: _build_raw_parameters(spark, sf_dir))


def raw_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country documents (see ``_build_raw_countries``)."""
    return _materialized(spark, sf_dir, "countries", lambda: _build_raw_countries(spark, sf_dir))


def raw_providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provider documents from ``supplier``."""
    return _materialized(spark, sf_dir, "providers", lambda: _build_raw_providers(spark, sf_dir))


def raw_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Location documents from ``customer`` (see ``_build_raw_locations``)."""
    return _materialized(spark, sf_dir, "locations", lambda: _build_raw_locations(spark, sf_dir))


def raw_measurements(spark: SparkSession, sf_dir: str, with_event_id: bool = False) -> DataFrame:
    """Measurement documents (request key attached) from ``events``."""
    return _materialized(spark, sf_dir, f"measurements-{with_event_id}",
                         lambda: _build_raw_measurements(spark, sf_dir, with_event_id))


def communes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commune reference from ``nation``: a 1.8-wide square per nation."""
    return _materialized(spark, sf_dir, "communes", lambda: _build_communes(spark, sf_dir))


def limit_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of regulatory-limit tables from ``part`` (see ``_build_limit_cells``)."""
    return _materialized(spark, sf_dir, "limit_cells", lambda: _build_limit_cells(spark, sf_dir))
