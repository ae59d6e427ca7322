"""Bronze landing: source extracts kept as text, with audit columns.

Nothing here passes rows through Python: files are read by Spark's CSV/JSON
readers and written by its Parquet writer; only file and column *names* are
handled on the driver.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

SOURCE_RESOURCE = "_source_resource"
INGESTED_AT = "_ingested_at"
FILE_NAME = "_file_name"


class MissingEntityError(RuntimeError):
    """An extract lacks one or more expected entities."""


class NoExtractError(RuntimeError):
    """No catalogue entry matched."""


def land_text(df: DataFrame, source_resource: str | Column, with_timestamp: bool = True) -> DataFrame:
    """Every column as text, plus ``_source_resource`` and ``_ingested_at``."""
    res = source_resource if isinstance(source_resource, Column) else F.lit(source_resource)
    cols = [F.col(f"`{c}`").cast("string").alias(c) for c in df.columns
            if c not in (SOURCE_RESOURCE, INGESTED_AT)]
    cols.append(res.cast("string").alias(SOURCE_RESOURCE))
    if with_timestamp:
        cols.append(F.current_timestamp().alias(INGESTED_AT))
    return df.select(*cols)


def read_text_csv(spark: SparkSession, paths: str | Sequence[str], blank_as_null: bool = True,
                  file_name: bool = False, quoted_breaks: bool = True) -> DataFrame:
    """Header CSV, every column a string, no type inference.

    Quotes inside quoted fields are doubled, and quoted fields may hold line
    breaks; such a file cannot be split, so one file is read by one task. With
    ``quoted_breaks=False`` the source declares that a line is a row: files are
    split and read by many tasks, whatever their size (a quoted break would
    then end its row). Files with different headers
    (or column orders) are read each with its own and aligned by name; a column
    that a file lacks is NULL. A UTF-8 BOM is dropped, short rows are
    NULL-padded, extra fields dropped. Empty fields are NULL, or ``''`` with
    ``blank_as_null=False`` (a short row's missing fields too).
    ``file_name`` adds the name of each row's file as ``_file_name``.
    """
    wanted = [paths] if isinstance(paths, str) else list(paths)
    files = [r[0] for r in spark.read.format("binaryFile").load(wanted).select("path").collect()]   # names only
    by_header: dict[tuple[str, ...], list[str]] = {}
    for path in sorted(files):
        by_header.setdefault(tuple(_csv(spark, path, quoted_breaks).columns), []).append(path)
    if not by_header:
        raise FileNotFoundError(f"no CSV file at {wanted}")
    parts = []
    for group in by_header.values():
        df = _csv(spark, group, quoted_breaks)
        empty = (lambda c: F.nullif(c, F.lit(""))) if blank_as_null else (lambda c: F.coalesce(c, F.lit("")))
        columns = [empty(F.col(f"`{c}`")).alias(c) for c in df.columns]
        parts.append(df.select(*columns, F.col("_metadata.file_name").alias(FILE_NAME)) if file_name else df.select(*columns))
    out = union_parts(parts)
    return out if blank_as_null else out.fillna("")


def _csv(spark: SparkSession, paths: str | Sequence[str], quoted_breaks: bool) -> DataFrame:
    return (spark.read.option("header", True).option("inferSchema", False).option("encoding", "UTF-8")
            .option("quote", '"').option("escape", '"').option("multiLine", quoted_breaks)
            .option("mode", "PERMISSIVE").csv(paths))


def read_extract(spark: SparkSession, folder: str, suffix_by_entity: Mapping[str, str],
                 blank_as_null: bool = True, quoted_breaks: bool = True) -> dict[str, DataFrame]:
    """Route the CSV files of one extract folder to entities by name suffix.

    Files matching no suffix are ignored. Every entity must resolve to at
    least one file; all missing ones are reported together, *before* anything
    is written.
    """
    frames: dict[str, DataFrame] = {}
    missing: list[str] = []
    for entity, suffix in suffix_by_entity.items():
        try:
            df = read_text_csv(spark, f"{folder.rstrip('/')}/*{suffix}", blank_as_null, file_name=True,
                               quoted_breaks=quoted_breaks)
            frames[entity] = df.withColumnRenamed(FILE_NAME, SOURCE_RESOURCE)
        except FileNotFoundError:
            missing.append(entity)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            missing.append(entity)
    if missing:
        raise MissingEntityError(f"extract {folder} lacks entities: {sorted(missing)}")
    return frames


def latest_entry(entries: DataFrame, pattern: str, number_group: int = 1, url_suffix: str = "",
                 by: Sequence[str] = ()) -> DataFrame:
    """The newest entry of a list of ``pos, name, url`` (and the ``by`` columns), one per ``by``.

    An entry qualifies when ``pattern`` matches its name at the start and its
    URL ends with ``url_suffix`` (any case); the greatest number in
    ``number_group`` wins, then the smallest ``pos``. Returns ``by, pos, name,
    url, end_year``; no row where none qualifies. The pick is a maximum, which
    is combined before the shuffle.
    """
    pattern = pattern if pattern.startswith("^") else "^" + pattern
    found = (entries.select(*by, "pos", "name", "url")
             .filter(F.col("name").rlike(pattern) & F.lower(F.col("url")).endswith(url_suffix))
             .withColumn("end_year", F.regexp_extract("name", pattern, number_group).cast("int")))
    best = found.groupBy(*by).agg(F.max_by(F.struct("pos", "name", "url", "end_year"),
                                           F.struct(F.col("end_year"), -F.col("pos"))).alias("b"))
    return best.filter(F.col("b").isNotNull()).select(*by, "b.*")


def latest_extract(catalogue: DataFrame, name_pattern: str, url_suffix: str = ".zip") -> DataFrame:
    """Pick the newest extract listed in a catalogue document.

    ``catalogue`` has ``result.resources: array<struct<name, url>>``. A
    resource qualifies when its name matches ``name_pattern`` at the start
    (group 1 = end year) and its URL ends with ``url_suffix``; the one with the
    greatest end year wins (ties: first listed). Returns one row
    ``(name, url, end_year)``; ``require_one`` raises when there is none.
    """
    res = (catalogue.select(F.posexplode("result.resources").alias("pos", "r"))
           .select("pos", F.col("r.name").alias("name"), F.col("r.url").alias("url")))
    return latest_entry(res, name_pattern, url_suffix=url_suffix).select("name", "url", "end_year")


def require_one(df: DataFrame, what: str) -> dict:
    """Fetch the single metadata row of ``df``; none, or more than one, is an error."""
    rows = df.take(2)
    if not rows:
        raise NoExtractError(f"no {what} found")
    if len(rows) > 1:
        raise NoExtractError(f"more than one {what} found")
    return rows[0].asDict()


def flatten_codes(doc: DataFrame, path: str = "data.codelists", code_field: str = "id",
                  name_field: str = "name") -> DataFrame:
    """``data.codelists[0].codes[*]`` -> rows ``(code, name)``."""
    return (doc.select(F.explode(F.col(path)[0]["codes"]).alias("c"))
            .select(F.col("c")[code_field].alias("code"), F.col("c")[name_field].alias("name")))


def flatten_code_text(docs: DataFrame, text: str, path: str = "$.data.codelists[0].codes", code_field: str = "id",
                      name_field: str = "name", keep: Sequence[str] = ()) -> DataFrame:
    """Code lists in JSON text -> rows ``keep, position, code, name, fault``, whatever else the documents hold.

    The text is parsed to a VARIANT, so a moved, added or retyped field
    elsewhere does not break the scan, and no schema is fixed beforehand.
    ``fault`` says what a document or an entry lacks: ``not json``, ``no list``
    (the path is missing, or not an array), ``no code`` (an entry that is no
    object, or without the code), else NULL; faulty documents give one row with
    NULL position. Numbers and booleans become text; an empty list gives no row.
    """
    parsed = F.try_parse_json(F.col(text))
    codes = F.try_variant_get(parsed, path, "array<variant>")
    fault = F.when(parsed.isNull(), F.lit("not json")).when(codes.isNull(), F.lit("no list"))
    entries = F.when(fault.isNotNull(), F.array(F.lit(None).cast("variant"))).otherwise(codes)
    rows = docs.select(*keep, fault.alias("__fault"), F.posexplode(entries).alias("__at", "__e"))
    code = F.try_variant_get(F.col("__e"), f"$.{code_field}", "string")
    return rows.select(*keep, F.when(F.col("__fault").isNull(), F.col("__at")).alias("position"), code.alias("code"),
                       F.try_variant_get(F.col("__e"), f"$.{name_field}", "string").alias("name"),
                       F.coalesce(F.col("__fault"), F.when(code.isNull(), F.lit("no code"))).alias("fault"))


def union_parts(parts: Sequence[DataFrame]) -> DataFrame:
    """Concatenate parts aligned by column *name* (order-insensitive); columns
    missing from a part are NULL."""
    if not parts:
        raise ValueError("no parts")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def schema_drift(new_columns: Sequence[str], stored_columns: Sequence[str] | None) -> dict:
    """Compare column *sets* (order ignored)."""
    if stored_columns is None:
        return {"exists": False, "same": False, "added": sorted(new_columns), "removed": []}
    a, b = set(new_columns), set(stored_columns)
    return {"exists": True, "same": a == b, "added": sorted(a - b), "removed": sorted(b - a)}


def stored_columns(spark: SparkSession, path: str) -> list[str] | None:
    try:
        return spark.read.parquet(path).columns
    except AnalysisException:
        return None


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath, jvm


def _swap(fs, staged, target, old) -> None:
    """Put ``staged`` in the place of ``target``; the old table is set aside,
    put back if the new one cannot be moved in, and deleted only then."""
    had = fs.exists(target)
    if had and not fs.rename(target, old):
        raise OSError(f"could not set {target} aside")
    try:
        if not fs.rename(staged, target):
            raise OSError(f"could not move {staged} to {target}")
    except Exception:
        if had and not fs.exists(target):
            fs.rename(old, target)
        raise
    if had:
        fs.delete(old, True)


def full_refresh(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> dict:
    """Replace the table at ``path``; warn when its column set changed.

    Both the same-schema reload and the rebuilt-on-drift cases are one write.
    The new rows are written to a staging folder next to the table and swapped
    in only after the write job succeeded, so a failed job (lost executors
    beyond the retry limit, bad input) leaves the previous table readable. The
    swap is two renames, with the old table put back if the second fails; on an
    object store a rename copies, so prefer a catalog table there.
    Returns the drift report and the written row count, taken with
    ``observe`` during the write (no second pass).
    """
    import uuid
    from pyspark.sql import Observation

    spark = df.sparkSession
    drift = schema_drift(df.columns, stored_columns(spark, path))
    if drift["exists"] and not drift["same"]:
        log.warning("schema drift at %s: added %s, removed %s", path, drift["added"], drift["removed"])
    staging = f"{path.rstrip('/')}.__staging_{uuid.uuid4().hex}"
    obs = Observation("rows")
    writer = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    fs, target, jvm = _hadoop_fs(spark, path)
    staged, old = jvm.org.apache.hadoop.fs.Path(staging), jvm.org.apache.hadoop.fs.Path(f"{staging}_old")
    try:
        writer.parquet(staging)
    except Exception:
        fs.delete(staged, True)   # drop the partial staging folder
        raise
    _swap(fs, staged, target, old)
    drift["rows"] = obs.get.get("rows", 0)
    return drift
