"""Readers: files of every stage as typed rows. Broken files drop out instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas


def _json(spark: SparkSession, schema: str, path, multi_line: bool = True) -> DataFrame:
    df = (spark.read.schema(schema).option("multiLine", multi_line).option("mode", "PERMISSIVE")
          .option("recursiveFileLookup", True).json(path).withColumn("_file", F.col("_metadata.file_path")))
    return df.filter(F.col("_corrupt_record").isNull()).drop("_corrupt_record")


def _folder(level: int = 1) -> Column:
    """Name of the file's folder, ``level`` steps above the file."""
    return F.url_decode(F.element_at(F.split("_file", "/"), -1 - level))


def read_ocr_pages(spark: SparkSession, root: str, runs: list[str] | None = None,
                   multi_line: bool = True) -> DataFrame:
    """(run, path, idx, text, ord) of every page chunk under ``root/<run>/``.

    ``ord`` follows the listing: file name, then position in the file.
    """
    paths = [f"{root}/{r}" for r in runs] if runs else root
    chunks = _json(spark, schemas.OCR_CHUNK, paths, multi_line)
    pages = chunks.select(F.regexp_replace(_folder(), "^run=", "").alias("run"), "path", "_file", "page_from",
                          F.posexplode("pages").alias("pos", "page"))
    return pages.select("run", "path", "page.idx", "page.text",
                        F.concat_ws("#", "_file", F.lpad(F.coalesce("page_from", F.lit(0)).cast("string"), 8, "0"),
                                    F.lpad(F.col("pos").cast("string"), 8, "0")).alias("ord"))


def read_doc_results(spark: SparkSession, folder: str, multi_line: bool = True) -> DataFrame:
    return _json(spark, schemas.DOC_RESULT, folder, multi_line).withColumnRenamed("_file", "ord")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_results_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """CSV as text: empty cells stay empty, malformed lines drop out, a byte order mark is ignored."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    rows = (spark.read.schema(schema).option("header", True).option("mode", "DROPMALFORMED")
            .option("encoding", "UTF-8").option("emptyValue", "").csv(path))
    return rows.select([F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in columns])


def _json_text(spark: SparkSession, path: str, whole: bool = False) -> DataFrame:
    return spark.read.option("wholetext", whole).option("recursiveFileLookup", True).text(path).withColumn(
        "_file", F.col("_metadata.file_path"))


def explode_sidecar(maps: DataFrame, column: str = "m") -> DataFrame:
    """map<"lat,lon", number> → (lat5, lon5, v); keys that are not two numbers drop out."""
    rows = maps.select(F.explode(column).alias("k", "v"))
    parts = F.split("k", ",")
    out = rows.filter(F.size(parts) == 2).select(
        F.round(F.get(parts, F.lit(0)).try_cast("double"), 5).alias("lat5"),
        F.round(F.get(parts, F.lit(1)).try_cast("double"), 5).alias("lon5"), "v")
    return out.filter(F.col("lat5").isNotNull() & F.col("lon5").isNotNull())


def read_sidecar(spark: SparkSession, path: str, whole: bool = False) -> DataFrame:
    maps = _json_text(spark, path, whole).select(F.from_json("value", "map<string,double>").alias("m"))
    return explode_sidecar(maps)


def read_page_links(spark: SparkSession, path: str, whole: bool = False) -> DataFrame:
    """(marker, src, page, approx) rows of the page-link map, an object per line; ``whole`` reads files of several lines."""
    links = _json_text(spark, path, whole).select(F.explode(F.from_json("value", schemas.PAGE_LINKS)).alias("marker", "l"))
    return links.select("marker", F.explode("l").alias("l")).select(
        "marker", "l.src", F.explode("l.pages").alias("page"), "l.approx")


def read_scan_index(spark: SparkSession, path: str, whole: bool = False) -> DataFrame:
    """(publication, page, scan_key) rows of the scan index."""
    idx = _json_text(spark, path, whole).select(F.explode(F.from_json("value", schemas.SCAN_INDEX)).alias("publication", "m"))
    return idx.select("publication", F.explode("m").alias("p", "scan_key")).select(
        "publication", F.col("p").try_cast("int").alias("page"), "scan_key")


def read_line_boxes(spark: SparkSession, root: str, multi_line: bool = True) -> DataFrame:
    """(slug, page, w, h, n, text, x0, y0, x1, y1) of files ``<slug>/p<page>.lines.json``."""
    boxes = _json(spark, schemas.LINE_BOXES, root, multi_line)
    page = F.regexp_extract("_file", r"/p(\d+)\.lines\.json$", 1).try_cast("int")
    return line_rows(boxes.select(_folder().alias("slug"), page.alias("page"), "w", "h", "lines"))


def line_rows(boxes: DataFrame) -> DataFrame:
    """Page arrays [[text, x0, y0, x1, y1], …] → one row per line; numbers that do not parse become NULL."""
    rows = boxes.select("slug", "page", "w", "h", F.posexplode("lines").alias("n", "l"))
    return rows.select("slug", "page", "w", "h", "n", F.get("l", F.lit(0)).alias("text"),
                       *[F.get("l", F.lit(k)).try_cast("int").alias(c)
                         for k, c in enumerate(("x0", "y0", "x1", "y1"), start=1)])


def read_archive_catalog(spark: SparkSession, root: str) -> DataFrame:
    """(path, name, size, top) of every file under ``root``; only names and sizes are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    rel = F.regexp_replace(F.url_decode("path"), r"^.*?" + _literal(root.rstrip("/")) + "/", "")
    return catalog_rows(files.select(F.concat(F.lit("/"), rel).alias("path"), F.col("length").alias("size")))


def catalog_rows(files: DataFrame) -> DataFrame:
    """(path, size) of a listing or manifest → with name and topmost folder."""
    return files.withColumn("name", F.substring_index("path", "/", -1)).withColumn(
        "top", F.when(F.size(F.split("path", "/")) > 2, F.get(F.split("path", "/"), F.lit(1))).otherwise("(root)"))


def _literal(text: str) -> str:
    return r"\Q" + text + r"\E"


def read_job_status(spark: SparkSession, root: str) -> DataFrame:
    """One row per ``<job>/status.json``; the folder names the job when the file does not."""
    df = (spark.read.schema(schemas.JOB_STATUS).option("multiLine", True).option("recursiveFileLookup", True)
          .option("pathGlobFilter", "status.json").json(root).withColumn("_file", F.col("_metadata.file_path")))
    return df.withColumn("job_id", F.coalesce("job_id", _folder())).drop("_file")


def read_proposals(spark: SparkSession, root: str) -> DataFrame:
    """(job_id, i, p) of ``<job>/proposals.json``: a list, or an object with a ``proposals`` list."""
    raw = (spark.read.option("wholetext", True).option("recursiveFileLookup", True)
           .option("pathGlobFilter", "proposals.json").text(root).withColumn("_file", F.col("_metadata.file_path")))
    return proposal_rows(raw.select(_folder().alias("job_id"), "value"))


def proposal_rows(texts: DataFrame) -> DataFrame:
    """(job_id, value) JSON texts → (job_id, i, p)."""
    as_list = F.from_json("value", f"array<{schemas.PROPOSAL}>")
    as_object = F.from_json("value", f"struct<proposals:array<{schemas.PROPOSAL}>>")["proposals"]
    items = F.when(F.ltrim("value").startswith("["), as_list).otherwise(as_object)
    return texts.select("job_id", F.posexplode(items).alias("i", "p"))


def read_decisions(spark: SparkSession, root: str) -> DataFrame:
    """(job_id, i, verdict, comment, reviewer, ts) of ``<job>/decisions.json``."""
    raw = (spark.read.option("wholetext", True).option("recursiveFileLookup", True)
           .option("pathGlobFilter", "decisions.json").text(root).withColumn("_file", F.col("_metadata.file_path")))
    rows = raw.select(_folder().alias("job_id"),
                      F.explode(F.from_json("value", f"map<string,{schemas.DECISION}>")).alias("i", "d"))
    return rows.select("job_id", F.col("i").try_cast("int").alias("i"), "d.verdict", "d.comment",
                       F.col("d.user").alias("reviewer"), "d.ts")


def read_jobs(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return read_job_status(spark, root), read_proposals(spark, root), read_decisions(spark, root)


def read_corrections(spark: SparkSession, root: str) -> DataFrame:
    """(marker_key, pos, field, verdict, comment, reviewer, ts): the file name is the marker key."""
    raw = _json_text(spark, root)
    key = F.regexp_replace(F.url_decode(F.substring_index("_file", "/", -1)), r"\.json$", "")
    return correction_rows(raw.select(key.alias("marker_key"), "value"))


def correction_rows(texts: DataFrame) -> DataFrame:
    """(marker_key, value) JSON texts → one row per entry."""
    rows = texts.select("marker_key", F.posexplode(F.from_json("value", f"array<{schemas.CORRECTION}>")).alias("pos", "c"))
    return rows.select("marker_key", "pos", "c.field", "c.verdict", "c.comment",
                       F.col("c.user").alias("reviewer"), "c.ts", F.col("c.movedFrom").alias("moved_from"))
