"""Market XML documents: read, flatten to observations, and write.

Layout of a landing folder: ``<root>/country_code=<c>/bidding_zone=<z>/*.xml``, or
with a folder ``quarter=<2024Q1>`` below the zone that an ingest run can prune by,
one document root per file holding many ``TimeSeries`` → ``Period`` →
``Point``. The zone comes from the folder, as the reference passes it in.
Elements are matched by local name (``ignoreNamespace``), so default-namespace
and prefixed documents both read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlens.functions.expr import floor_to, resolution_minutes
from loadlens.fixed import RESOLUTION_MINUTES, START_FORMAT
from loadlens.schema import TIMESERIES_SCHEMA
from loadlens.session import child_names, path_exists

ZONE_KEYS = ("country_code", "bidding_zone")
DOCUMENT_ROOT = 'GL_MarketDocument xmlns="urn:loadlens:market:load:1"'


#: Text of a document that cannot be parsed, and the place of a series in its input.
BAD, FILE, SEQ = "_bad_document", "_file", "_seq"
QUARTER = "quarter"


def read_documents(spark: SparkSession, path: str | list[str], strict: bool = True,
                   base_path: str | None = None) -> DataFrame:
    """S1 scan: one row per TimeSeries, with the zone keys from the folder names.

    ``strict`` (FAILFAST) fails the read on a truncated or malformed file, as the
    reference fails the run; absent or empty values stay null. Otherwise such a
    file gives a row that holds its text in ``BAD``, and every row gets its place
    (``FILE`` and ``SEQ``; one file is read in order by one task).
    """
    fields = [*TIMESERIES_SCHEMA.fields, *[T.StructField(k, T.StringType()) for k in ZONE_KEYS]]
    if not strict:
        fields.append(T.StructField(BAD, T.StringType()))
    reader = (spark.read.format("xml").schema(T.StructType(fields))
              .option("rowTag", "TimeSeries").option("ignoreNamespace", "true")
              .option("mode", "FAILFAST" if strict else "PERMISSIVE").option("columnNameOfCorruptRecord", BAD))
    if base_path:
        reader = reader.option("basePath", base_path)
    out = reader.load(path).select(*[f.name for f in fields])
    return out if strict else out.withColumns({FILE: F.input_file_name(), SEQ: F.monotonically_increasing_id()})


#: Ends of text records: every start and end tag of a series without attributes ends with this.
SEPARATOR = "TimeSeries>"
_NAME = r"[A-Za-z_][\w.\-]*"
#: A record that a series' end tag closed, one that a start tag closed, and what may follow the last series.
_CLOSED, _OPENED, _TAIL = rf"</(?:{_NAME}:)?$", rf"<(?:{_NAME}:)?$", r"^\s*(?:</[^<>]+>\s*)*$"
#: The start tag of a series with attributes or white space, and what a record may not hold.
_TAGGED = rf"<(?:{_NAME}:)?TimeSeries\s(?:[^<>\"']|\"[^\"]*\"|'[^']*')*>"
_STRANGE = rf"<!--|-->|<!\[CDATA\[|\]\]>|<!DOCTYPE|</(?:{_NAME}:)?TimeSeries\s|<(?:{_NAME}:)?TimeSeries(?:\s(?:[^<>\"']|\"[^\"]*\"|'[^']*')*)?/>"
_ENCODED = r"(?i)^\s*<\?xml[^>]*encoding=[\"'](?!utf-8[\"'])"


def _records(spark: SparkSession, path: str | list[str], base_path: str | None) -> DataFrame:
    """The pieces of documents between separators, with zone keys and place: ``value, FILE, SEQ``.

    Large files are split by bytes like any text; ``SEQ`` orders the pieces of a file
    by the split they begin in and their turn there.
    """
    reader = spark.read.format("text").option("lineSep", SEPARATOR)
    if base_path:
        reader = reader.option("basePath", base_path)
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("turn"))
    keys = [F.col(k).cast("string").alias(k) for k in ZONE_KEYS]
    return reader.load(path).select("value", *keys, F.col("_metadata.file_path").alias(FILE), place.alias(SEQ))


def unsplittable(spark: SparkSession, path: str | list[str], base_path: str | None = None) -> list[str]:
    """Files whose series cannot be told by their tags alone.

    Comments, CDATA, a document type, another encoding than UTF-8, empty or oddly
    written tags of a series, elements whose name ends like it, and documents that
    break off. A whole-file reader must read them.
    """
    v = F.col("value")
    regular = v.rlike(_CLOSED) | v.rlike(_OPENED) | v.rlike(_TAIL) | ~v.contains("<")
    strange = ~regular | v.rlike(_STRANGE) | v.rlike(_ENCODED) | (~v.contains("<") & (F.trim(v) != ""))
    return [r[0] for r in _records(spark, path, base_path).where(strange).select(FILE).distinct().collect()]


def read_documents_split(spark: SparkSession, path: str | list[str], base_path: str | None = None) -> DataFrame:
    """S1 scan by byte ranges: one large document is read by many tasks.

    Rows as ``read_documents`` gives them, with their place (``FILE``, ``SEQ``), so that
    document order is kept. Series are text records that end with their end tag; each is
    parsed by ``from_xml`` (FAILFAST). Files that ``unsplittable`` names are read whole.
    """
    odd = unsplittable(spark, path, base_path)
    records = _records(spark, path, base_path)
    if odd:
        records = records.where(~F.col(FILE).isin(odd))
    closed = records.where(F.col("value").rlike(_CLOSED))
    inner = F.regexp_replace(F.regexp_replace("value", rf"(?s)^.*{_TAGGED}", ""), _CLOSED, "")
    parsed = F.from_xml(F.concat(F.lit("<TimeSeries>"), inner, F.lit("</TimeSeries>")), TIMESERIES_SCHEMA,
                        {"mode": "FAILFAST", "ignoreNamespace": "true"})
    fields = [f.name for f in TIMESERIES_SCHEMA.fields]
    out = closed.select(parsed.alias("s"), *ZONE_KEYS, FILE, SEQ).select(*[f"s.{f}" for f in fields], *ZONE_KEYS, FILE, SEQ)
    if odd:
        place = F.struct(F.lit(0).cast("long").alias("block"), F.monotonically_increasing_id().alias("turn"))
        # the zone keys of single files come from the folders above them
        root = base_path or (path if isinstance(path, str) else None)
        whole = read_documents(spark, odd, base_path=root).withColumns({FILE: F.input_file_name(), SEQ: place})
        out = out.unionByName(whole.select(*out.columns))
    return out


def no_documents(spark: SparkSession) -> DataFrame:
    """What ``read_documents`` gives, not strict, if there is no document."""
    fields = [*TIMESERIES_SCHEMA.fields, *[T.StructField(k, T.StringType()) for k in (*ZONE_KEYS, BAD, FILE)],
              T.StructField(SEQ, T.LongType())]
    return spark.createDataFrame([], T.StructType(fields))


def requested_folders(spark: SparkSession, root: str, chunks: DataFrame) -> list[str]:
    """Folders of a landing root that hold documents of the requested chunks.

    ``chunks`` has the zone keys and ``chunk_start_utc`` (a row for each zone and
    quarter of a request, so as many as the plan has). A zone whose folder has
    ``quarter=`` folders is listed by them, another as a whole; absent ones are left out.
    """
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    folders: dict[str, list[str]] = {}
    for r in chunks.select(*ZONE_KEYS, quarter_of(F.col("chunk_start_utc")).alias(QUARTER)).distinct().toLocalIterator():
        if all(r[k] is not None for k in ZONE_KEYS):
            zone = "/".join([root.rstrip("/"), *(f"{k}={escape(r[k])}" for k in ZONE_KEYS)])
            folders.setdefault(zone, []).append(f"{zone}/{QUARTER}={r[QUARTER]}")
    out = []
    for zone, quarters in sorted(folders.items()):
        if path_exists(spark, zone):
            split = any(n.startswith(f"{QUARTER}=") for n in child_names(spark, zone))
            out += [q for q in sorted(quarters) if path_exists(spark, q)] if split else [zone]
    return out


def quarter_of(c):
    """Name of the calendar quarter of a time: 2024Q1."""
    return F.concat(F.year(c).cast("string"), F.lit("Q"), F.quarter(c).cast("string"))


def periods(series: DataFrame, strict: bool = True) -> DataFrame:
    """Periods that have both a start and a resolution (others are skipped).

    An unknown resolution fails the query here, before any point is used; with
    ``strict=False`` it leaves ``step_minutes`` null. ``period_end`` is the declared
    end or, without one, the end of the last position's step.
    """
    place = [c for c in (FILE, SEQ) if c in series.columns]
    p = series.select(*ZONE_KEYS, F.col("mRID"), *place, F.posexplode("Period").alias("period_pos", "p"))
    start, res = F.col("p.timeInterval.start"), F.col("p.resolution")
    kept = p.filter(start.isNotNull() & (start != "") & res.isNotNull() & (res != ""))
    known = F.when(res.isin(*RESOLUTION_MINUTES), res)
    step = resolution_minutes(res if strict else known)
    begin = F.to_timestamp_ntz(start, F.lit(START_FORMAT))
    if not strict:
        begin = F.expr(f"CASE WHEN try_to_timestamp(trim(p.timeInterval.start), \"{START_FORMAT}\") IS NOT NULL "
                       f"THEN to_timestamp_ntz(p.timeInterval.start, \"{START_FORMAT}\") END")
    last = F.expr("array_max(transform(p.Point, x -> try_cast(trim(x.position) AS int)))")
    ends = F.col("p.timeInterval.end")
    declared = F.when(ends.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}Z$"), F.to_timestamp_ntz(ends, F.lit(START_FORMAT)))
    out = kept.select(*ZONE_KEYS, "mRID", *place, "period_pos", begin.alias("period_start"), res.alias("resolution"),
                      step.alias("step_minutes"), F.col("p.Point").alias("points"), declared.alias("_declared"), last.alias("_last"))
    return out.withColumn("period_end", F.coalesce("_declared", F.timestamp_add(
        "MINUTE", F.coalesce("_last", F.lit(1)) * F.col("step_minutes"), F.col("period_start")), "period_start")).drop("_declared", "_last")


def _parsed(text, to: str, what: str):
    """Parse trimmed text as ``to``; a non-empty value that does not parse fails the query."""
    value = F.expr(f"try_cast(trim({text}) AS {to})")
    return F.when(value.isNotNull(), value).otherwise(F.raise_error(F.concat(
        F.lit(f"invalid {what}: "), F.expr(text))).cast(to))


def _points(period_rows: DataFrame) -> DataFrame:
    place = [c for c in (FILE, SEQ) if c in period_rows.columns]
    pts = period_rows.select(*ZONE_KEYS, *place, "period_pos", "period_start", "step_minutes",
                             F.posexplode("points").alias("point_pos", "pt"))
    pos_t, qty_t = F.col("pt.position"), F.col("pt.quantity")
    return pts.filter(pos_t.isNotNull() & (pos_t != "") & qty_t.isNotNull() & (qty_t != ""))


def flatten_points(series: DataFrame, strict: bool = True) -> DataFrame:
    """(time_utc, country_code, bidding_zone, load_mw) for every usable point.

    time = period start + (position - 1) * step. Points lacking a position or
    a quantity (absent or empty) are skipped; a present but malformed number
    fails the query, as the reference fails the run, or is skipped with
    ``strict=False``. Series read with their place give ``doc_order`` as well: file,
    series, period and point, the order in which a reader would meet the points.
    """
    pts = _points(periods(series, strict))
    if strict:
        pos, qty = _parsed("pt.position", "int", "position"), _parsed("pt.quantity", "double", "quantity")
    else:
        pos, qty = F.expr("try_cast(trim(pt.position) AS int)"), F.expr("try_cast(trim(pt.quantity) AS double)")
        pts = pts.filter(pos.isNotNull() & qty.isNotNull() & F.col("step_minutes").isNotNull() & F.col("period_start").isNotNull())
    place = [F.struct(FILE, SEQ, "period_pos", "point_pos").alias("doc_order")] if FILE in pts.columns else []
    return pts.select(
        F.timestamp_add("MINUTE", (pos - 1) * F.col("step_minutes"), F.col("period_start"))
        .alias("time_utc"),
        *ZONE_KEYS,
        qty.alias("load_mw"),
        *place,
    )


def faults(series: DataFrame, windows: DataFrame) -> DataFrame:
    """Per zone the least message of what is wrong in its documents (no row: nothing is).

    ``series`` is read with ``strict=False``; ``windows`` has the zone keys,
    ``window_start`` and ``window_end`` (exclusive). Periods outside the window do not count.
    """
    name = F.regexp_extract(FILE, "[^/]*$", 0)
    broken = series.filter(F.col(BAD).isNotNull()).select(*ZONE_KEYS, F.concat(F.lit("malformed document: "), name).alias("error_message"))
    asked = overlapping(periods(series, strict=False), windows)
    unknown = asked.filter(F.col("step_minutes").isNull()).select(
        *ZONE_KEYS, F.concat(F.lit("Unsupported resolution "), "resolution").alias("error_message"))
    undated = asked.filter(F.col("period_start").isNull()).select(*ZONE_KEYS, F.lit("invalid period start").alias("error_message"))
    pos, qty = F.expr("try_cast(trim(pt.position) AS int)"), F.expr("try_cast(trim(pt.quantity) AS double)")
    numbers = _points(asked).filter(pos.isNull() | qty.isNull()).select(*ZONE_KEYS, F.when(
        pos.isNull(), F.concat(F.lit("invalid position: "), "pt.position")).otherwise(
        F.concat(F.lit("invalid quantity: "), "pt.quantity")).alias("error_message"))
    every = broken.unionByName(unknown).unionByName(undated).unionByName(numbers)
    return every.groupBy(*ZONE_KEYS).agg(F.min("error_message").alias("error_message"))


def overlapping(period_rows: DataFrame, windows: DataFrame) -> DataFrame:
    """Periods that reach into their zone's window (those without a readable start stay)."""
    w = windows.select(*ZONE_KEYS, "window_start", "window_end")
    return period_rows.join(w, list(ZONE_KEYS)).filter(
        F.col("period_start").isNull() | (F.col("period_start") < F.col("window_end"))
        & (F.col("period_end") > F.col("window_start"))).drop("window_start", "window_end")


def requested_series(series: DataFrame, windows: DataFrame) -> DataFrame:
    """Series that the windows ask for: with a period inside, or without any in a document that has one."""
    marked = series.withColumn("_any", F.size(F.coalesce(F.filter(
        "Period", lambda p: (p["timeInterval"]["start"] != "") & (p["resolution"] != "")), F.array())) > 0)
    asked = overlapping(periods(series, strict=False), windows)
    hit = asked.select(FILE, SEQ).distinct()
    with_period = marked.filter("_any").join(hit, [FILE, SEQ], "left_semi")
    without = marked.filter("NOT _any").join(asked.select(FILE).distinct(), FILE, "left_semi")
    return with_period.unionByName(without).drop("_any")


def floor_minutes(c, minutes: int):
    """Floor a wall-clock time to a ``minutes`` grid inside the hour."""
    m = F.minute(c)
    return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c),
                                m - m % minutes, F.lit(0))


def to_documents(points: DataFrame, resolution_col: str = "resolution") -> DataFrame:
    """Build TimeSeries rows (one per zone-day and resolution) from grid points.

    ``points`` holds (time_utc, zone keys, load_mw, resolution) with times on
    the resolution grid. Missing steps become position holes. A group holds at
    most one day of points (≤ 96), so collecting it is bounded.
    """
    day = floor_to(F.col("time_utc"), "day")
    step = resolution_minutes(F.col(resolution_col))
    pos = (F.timestamp_diff("MINUTE", day, F.col("time_utc")) / step).cast("int") + 1
    grouped = (points.withColumn("_day", day)
               .groupBy(*ZONE_KEYS, "_day", resolution_col)
               .agg(F.sort_array(F.collect_list(F.struct(pos.alias("position"),
                                                         F.col("load_mw").alias("quantity"))))
                    .alias("Point")))
    fmt = lambda c: F.date_format(c, START_FORMAT)
    period = F.struct(
        F.struct(fmt(F.col("_day")).alias("start"),
                 fmt(F.timestamp_add("DAY", F.lit(1), F.col("_day"))).alias("end")).alias("timeInterval"),
        F.col(resolution_col).alias("resolution"),
        F.col("Point"))
    return grouped.select(
        *ZONE_KEYS,
        F.concat_ws("-", *[F.col(k) for k in ZONE_KEYS], F.date_format("_day", "yyyyMMdd"),
                    F.col(resolution_col)).alias("mRID"),
        F.array(period).alias("Period"))


def write_documents(docs: DataFrame, path: str) -> None:
    """Write TimeSeries rows as XML documents into a landing folder by zone and quarter."""
    start = F.to_timestamp_ntz(F.col("Period")[0]["timeInterval"]["start"], F.lit(START_FORMAT))
    (docs.withColumn(QUARTER, quarter_of(start)).write.mode("overwrite").partitionBy(*ZONE_KEYS, QUARTER).format("xml")
     .option("rowTag", "TimeSeries").option("rootTag", DOCUMENT_ROOT)
     .save(path))
