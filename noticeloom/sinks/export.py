"""Publishing gold records: one flat schema for CSV, JSON and Parquet, a content hash, and an atomic swap."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The columns of the flat export in order.
COLUMNS = (
    "id person_value person_raw rank_value rank_raw organization_value organization_raw position_value position_raw appointment_type effective_date"
    " version is_current superseded_by source_pdf_content_hash source_pdf_source_url source_pdf_published_date parser_version layout_era_id confidence_score confidence_band"
).split()
#: Results that json_array() may hold in one row; write_json_array() has no bound.
ARRAY_ROWS = 100_000


def public_id(number: Column) -> Column:
    return F.when(number.isNotNull(), F.format_string("gold-%08d", number))


def _field(fields: Column, names: list[str], part: str) -> Column:
    return F.coalesce(*(F.get_json_object(fields, f"$.{n}.{part}") for n in names))


def flatten(gold: DataFrame) -> DataFrame:
    """The 21 export columns of gold records. Origins that a record does not carry are null, confidence is 1.0."""
    fields = F.col("fields")
    none = F.lit(None).cast("string")
    made = {
        "id": public_id(F.col("id")), "person_value": F.col("person_key"), "person_raw": _field(fields, ["name"], "raw"),
        "rank_value": _field(fields, ["rank"], "value"), "rank_raw": _field(fields, ["rank"], "raw"),
        "organization_value": _field(fields, ["organization", "org"], "value"), "organization_raw": _field(fields, ["organization", "org"], "raw"),
        "position_value": _field(fields, ["position"], "value"), "position_raw": _field(fields, ["position"], "raw"),
        "appointment_type": F.col("appointment_type"), "effective_date": F.date_format("effective_date", "yyyy-MM-dd"),
        "version": F.col("version").cast("long"), "is_current": F.col("is_current") == 1, "superseded_by": public_id(F.col("superseded_by")),
        "source_pdf_content_hash": none, "source_pdf_source_url": none, "source_pdf_published_date": none, "parser_version": none, "layout_era_id": none,
        "confidence_score": F.lit(1.0), "confidence_band": F.lit("verified"),
    }
    return gold.select(*(made[c].alias(c) for c in COLUMNS))


def nested(gold: DataFrame) -> DataFrame:
    """id and json: the public record as a nested object, nulls kept."""
    flat = flatten(gold)
    both = lambda n: F.struct(F.col(f"{n}_value").alias("value"), F.col(f"{n}_raw").alias("raw")).alias(n)
    source = F.struct(F.col("source_pdf_content_hash").alias("content_hash"), F.col("source_pdf_source_url").alias("source_url"), F.col("source_pdf_published_date").alias("published_date")).alias("source_pdf")
    confidence = F.struct(F.col("confidence_score").alias("score"), F.col("confidence_band").alias("band")).alias("confidence")
    record = F.struct("id", *map(both, ("person", "rank", "organization", "position")), "appointment_type", "effective_date", "version", "is_current", "superseded_by", source, "parser_version", "layout_era_id", confidence)
    return flat.select("id", F.to_json(record, {"ignoreNullFields": "false"}).alias("json"))


def unnested(records: DataFrame) -> DataFrame:
    """The flat columns of nested(), parsed back."""
    value = "struct<value:string,raw:string>"
    schema = f"id string, person {value}, rank {value}, organization {value}, position {value}, appointment_type string, effective_date string, version long, is_current boolean, superseded_by string, source_pdf struct<content_hash:string,source_url:string,published_date:string>, parser_version string, layout_era_id string, confidence struct<score:double,band:string>"
    r = F.from_json("json", schema)
    paths = {c: c.rsplit("_", 1) for c in COLUMNS if c.rsplit("_", 1)[0] in ("person", "rank", "organization", "position", "confidence")}
    paths |= {c: ["source_pdf", c.removeprefix("source_pdf_")] for c in COLUMNS if c.startswith("source_pdf_")}
    return records.withColumn("r", r).select(*((F.col("r")[paths[c][0]][paths[c][1]] if c in paths else F.col("r")[c]).alias(c) for c in COLUMNS))


def broken_constraints(flat: DataFrame) -> DataFrame:
    """id and problem of public records that break the schema: required values, ids of the public form, versions from 1,
    scores within [0, 1] and the bands that there are."""
    tests = {
        "id": F.coalesce(~F.col("id").rlike(r"^gold-\d{8,}$"), F.lit(True)), "person_value": F.col("person_value").isNull(), "appointment_type": F.col("appointment_type").isNull(),
        "effective_date": F.coalesce(~F.col("effective_date").rlike(r"^\d{4}-\d{2}-\d{2}$"), F.lit(True)), "version": F.coalesce(F.col("version") < 1, F.lit(True)), "superseded_by": F.coalesce(~F.col("superseded_by").rlike(r"^gold-\d{8,}$"), F.lit(False)),
        "confidence_score": F.coalesce(~F.col("confidence_score").between(0, 1), F.lit(True)), "confidence_band": F.coalesce(~F.col("confidence_band").isin("verified", "high", "medium", "low"), F.lit(True)),
    }
    return flat.select("id", F.explode(F.array_compact(F.array(*(F.when(bad, name) for name, bad in tests.items())))).alias("problem"))


def content_hash(rows: DataFrame) -> DataFrame:
    """n and content_hash of the rows whatever their order and files: sums of pieces of each row's SHA-256, hashed. The
    sums combine map-side, so nothing is sorted or gathered; rows repeated count each time. Values are joined with bars;
    bars and backslashes within them are escaped, null is \\N."""
    texts = [F.coalesce(F.replace(F.replace(F.col(c).cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|")), F.lit("\\N")) for c in sorted(rows.columns)]
    digest = rows.select(F.sha2(F.concat_ws("|", *texts), 256).alias("h"))
    pieces = [F.sum(F.conv(F.substring("h", 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)")).alias(f"s{i}") for i in range(4)]
    summed = digest.agg(F.count("*").alias("n"), *pieces)
    return summed.select("n", F.sha2(F.concat_ws(":", F.col("n").cast("string"), *(F.coalesce(F.col(f"s{i}"), F.lit(0)).cast("decimal(38,0)").cast("string") for i in range(4))), 256).alias("content_hash"))


def write_csv(rows: DataFrame, path: str, one_file: bool = False) -> None:
    """UTF-8 with a header, rows ending in CRLF, null as nothing, truth as True and False."""
    out = rows.withColumns({c: F.initcap(F.col(c).cast("string")) for c, t in rows.dtypes if t == "boolean"})
    (out.coalesce(1) if one_file else out).write.csv(path, header=True, lineSep="\r\n", nullValue="", emptyValue="", mode="errorifexists")


def write_json(rows: DataFrame, path: str) -> None:
    """One object a line, nulls kept."""
    rows.write.json(path, ignoreNullFields=False, mode="errorifexists")


def json_array(rows: DataFrame) -> DataFrame:
    """One row: the whole result as one JSON array, for answers of at most ARRAY_ROWS rows; larger ones are an error and
    belong to write_json_array()."""
    if rows.limit(ARRAY_ROWS + 1).count() > ARRAY_ROWS:
        raise ValueError(f"more than {ARRAY_ROWS} rows; use write_json_array")
    return rows.agg(F.to_json(F.array_sort(F.collect_list(F.struct("*"))), {"ignoreNullFields": "false"}).alias("json"))


def write_json_array(rows: DataFrame, path: str) -> None:
    """One file that holds all rows as one JSON array, nulls kept. The objects are written in parallel; the parts are then
    joined as streams of bytes, so neither a task nor the driver holds more than a buffer of them."""
    spark, parts = rows.sparkSession, f"{path}.parts-{uuid.uuid4().hex}"
    rows.select(F.concat(F.lit(","), F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).alias("value")).write.text(parts)
    hadoop, conf = spark._jvm.org.apache.hadoop, spark._jsc.hadoopConfiguration()
    place = hadoop.fs.Path(path)
    fs = place.getFileSystem(conf)
    out = fs.create(place, False)
    try:
        out.write(ord("["))
        first = True
        for status in sorted(fs.globStatus(hadoop.fs.Path(f"{parts}/part-*")), key=lambda s: s.getPath().getName()):
            if status.getLen():
                into = fs.open(status.getPath())
                into.skip(int(first))  # the comma before the first object
                first = False
                hadoop.io.IOUtils.copyBytes(into, out, conf, False)
                into.close()
        out.write(ord("]"))
    finally:
        out.close()
        fs.delete(hadoop.fs.Path(parts), True)


def write_parquet(rows: DataFrame, path: str) -> None:
    """Parquet, also of no rows."""
    rows.write.parquet(path, mode="errorifexists")


def artifact(rows: DataFrame, fmt: str, at: str, destination: str) -> DataFrame:
    """One row that describes an export: export_id, format, destination, as_of, record_count, checksum."""
    hashed = content_hash(rows)
    return hashed.select(F.lit(str(uuid.uuid4())).alias("export_id"), F.lit(fmt).alias("format"), F.lit(destination).alias("destination"), F.lit(at).cast("timestamp").alias("as_of"), F.col("n").alias("record_count"), F.col("content_hash").alias("checksum"))


def publish(spark: SparkSession, staged: str, target: str) -> None:
    """Put the folder `staged` in the place of `target`; what was there stays beside it as .bak. Any file system of Hadoop."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    new, place, old = hadoop.Path(staged), hadoop.Path(target), hadoop.Path(target + ".bak")
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(new):
        raise FileNotFoundError(staged)
    if fs.exists(place):
        fs.delete(old, True)
        fs.rename(place, old)
    fs.rename(new, place)


def publish_if_clean(spark: SparkSession, findings: DataFrame, staged: str, target: str) -> None:
    """publish(), unless the audit (check_id, severity, n) has an error with findings; then nothing is moved."""
    bad = [r.check_id for r in findings.where("severity = 'error' and n > 0").select("check_id").distinct().orderBy("check_id").toLocalIterator()]
    if bad:
        raise ValueError(f"not published: {', '.join(bad)}")
    publish(spark, staged, target)


#: Writers by format; callers may add their own.
WRITERS = {"csv": write_csv, "json": write_json, "json_array": write_json_array, "parquet": write_parquet}


def export(rows: DataFrame, fmt: str, path: str, ledger: str, at: str) -> DataFrame:
    """Write `rows` in a format and append artifact() of them to the table of runs in `ledger`; returns that row."""
    if fmt not in WRITERS:
        raise ValueError(f"format must be one of {sorted(WRITERS)}")
    WRITERS[fmt](rows, path)
    artifact(rows, fmt, at, path).write.mode("append").parquet(ledger)
    return rows.sparkSession.read.parquet(ledger).where(F.col("destination") == path)


def recent_exports(spark: SparkSession, ledger: str, n: int = 10) -> DataFrame:
    """The last `n` runs."""
    return spark.read.parquet(ledger).orderBy(F.desc("as_of"), "export_id").limit(n)
