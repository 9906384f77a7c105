"""Postings in JSON payloads: nested, polymorphic, or embedded in a page.

A payload frame has ``payload_id`` (a whole number giving the order) and
``payload`` (one response text per row).  A payload that is no JSON yields no
postings and no error; :func:`rejected_payloads` lists them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline.functions.freshness import epoch_to_iso
from siftline.operators.dedup import keep_first
from siftline.sources.common import as_postings, document_seq
from siftline.sources.file_source import read_files

# Experience limit in years, and the address of a posting.
MAX_YEARS = 5
DETAIL_URL = "https://www.wanted.co.kr/wd/"

# Tasks that read files: so many for a core, and no fewer than this where the cores aren't there yet.
TASKS_PER_CORE, LEAST_TASKS = 16, 256

_NUMBER_TYPE = r"^(BIGINT|DOUBLE|FLOAT|DECIMAL)"
_EMBEDDED = r"(?s)window\.__NEXT_DATA__\s*=\s*(\{.*?\})\s*;?\s*</script>"


def read_payloads(spark: SparkSession, path: str, pass_over: bool = False) -> DataFrame:
    """One payload per file under ``path``, numbered in the order of reading.

    A file that can't be read, or is no UTF-8, fails the job.  With ``pass_over``
    it is left out, and :func:`unread_payloads` tells which; the list of files is then
    in the driver, as it is on file systems that Arrow can't open.
    """
    if pass_over:
        files = _read(_files(spark, path)).where("reason IS NULL").select("payload")
    elif (found := read_files(spark, path, _tasks(spark))) is not None:
        files = found.select(F.col("content").cast("string").alias("payload"))
    else:
        files = _few_tasks(spark.read.text(path, wholetext=True).select(F.col("value").alias("payload")))
    return files.select(F.monotonically_increasing_id().alias("payload_id"), "payload")


def _few_tasks(files: DataFrame) -> DataFrame:
    """``files`` read by a bounded number of tasks, in their order.

    Spark deals out files as if each had 4 MB more, so that small ones come a few dozen
    to a task, each of which takes longer to start than to read them, and leaves a block
    for every partition of a shuffle.
    """
    return files.coalesce(_tasks(files.sparkSession))


def _tasks(spark: SparkSession) -> int:
    return max(LEAST_TASKS, TASKS_PER_CORE * spark.sparkContext.defaultParallelism)


def unread_payloads(spark: SparkSession, path: str) -> DataFrame:
    """path, reason of the files under ``path`` that give no payload."""
    return payload_files(spark, path).where("reason IS NOT NULL").select("path", "reason")


def payload_files(spark: SparkSession, path: str) -> DataFrame:
    """path, payload, reason: one row per file under ``path``; those without a payload say why.

    No file fails its task: bytes are read as they are and decoded here, and a
    file that can't be read at all is found missing in the end.  Spark passes over
    files of no bytes.  Contents are read once, names once more.
    """
    files = _files(spark, path)
    known = _few_tasks(files.select("path"))
    # Packed files may hold far more than their size says, so what is read is not to be broadcast.
    read = _read(files).withColumn("read", F.lit(True)).hint("merge")
    lost = F.when(F.col("read").isNull(), F.lit("unreadable"))
    return known.join(read, "path", "left").select("path", "payload", F.coalesce("reason", lost).alias("reason"))


def _files(spark: SparkSession, path: str) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return reader.option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true").load(path)


def _read(files: DataFrame) -> DataFrame:
    """path, payload, reason of the files that can be read, in the order of reading."""
    return _few_tasks(files.select("path", "content")).mapInArrow(_decoded, "path string, payload string, reason string")


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [_text_of(content.as_py() or b"") for content in batch.column("content")]
        yield pa.record_batch(
            [batch.column("path"), pa.array([t for t, _ in found], pa.string()), pa.array([r for _, r in found], pa.string())],
            names=["path", "payload", "reason"],
        )


def _text_of(content: bytes) -> tuple[str | None, str | None]:
    """The text of a file, or why it has none."""
    if content[:2] == b"\x1f\x8b":
        parts = []
        while content:
            member = zlib.decompressobj(31)
            try:
                parts.append(member.decompress(content))
            except zlib.error:
                return None, "damaged"
            if not member.eof:
                return None, "truncated"
            content = member.unused_data
        content = b"".join(parts)
    try:
        text = content.decode("utf-8-sig")
    except UnicodeDecodeError:
        return None, "not UTF-8"
    return (text, None) if text.strip() else (None, "empty")


def _parsed() -> Column:
    text = F.col("payload")
    return F.when(text.rlike(r"(?s)^\s*[\[{].*[\]}]\s*$"), F.try_parse_json(text))


def rejected_payloads(payloads: DataFrame) -> DataFrame:
    """Payloads that are no JSON document."""
    return payloads.where(_parsed().isNull())


def _items(payloads: DataFrame, *paths: str, single: str | None = None) -> DataFrame:
    """One row per element of the first array found under ``paths``."""
    doc = F.col("_doc")
    found = [F.try_variant_get(doc, p, "array<variant>") for p in paths]
    if single is not None:
        found.append(F.array(F.try_variant_get(doc, single, "variant")))
    # No filter on _doc: it would be pushed below and parse every payload twice,
    # and there is nothing to explode in NULL anyway.
    return (
        payloads.select("payload_id", _parsed().alias("_doc"))
        .select("payload_id", F.posexplode(F.coalesce(*found)).alias("_pos", "item"))
        .where(F.col("item").isNotNull())
        .withColumn("seq", document_seq(F.col("payload_id"), F.col("_pos")))
    )


def _text(path: str) -> Column:
    return F.coalesce(F.try_variant_get("item", path, "string"), F.lit(""))


def _with_ids(items: DataFrame) -> DataFrame:
    named = items.withColumn("source_id", _text("$.id")).where(F.col("source_id") != "")
    return keep_first(named, key="source_id")


def nested_json_postings(
    payloads: DataFrame,
    as_of: datetime | str | Column,
    source: str = "saramin",
    max_years: float = MAX_YEARS,
) -> DataFrame:
    """``jobs.job`` is a list or a single object; postings asking for more than
    ``max_years`` years are left out, unless the number is not a number."""
    items = _items(payloads, "$.jobs.job", single="$.jobs.job")
    level = "$.position['experience-level']"
    years = F.try_variant_get("item", f"{level}.min", "variant")
    number = F.when(
        F.schema_of_variant(years).rlike(_NUMBER_TYPE),
        F.try_variant_get("item", f"{level}.min", "double"),
    )
    rows = (
        _with_ids(items)
        .where(F.coalesce(number, F.lit(0.0)) <= max_years)
        .select(
            "seq",
            "source_id",
            _text("$.url").alias("url"),
            _text("$.position.title").alias("title"),
            _text("$.company.detail.name").alias("company"),
            _text("$.position.location.name").alias("location"),
            _text(f"{level}.name").alias("experience_required"),
            _text("$.salary.name").alias("salary_info"),
            epoch_to_iso(_text("$['posting-timestamp']")).alias("posted_date"),
            epoch_to_iso(_text("$['expiration-timestamp']")).alias("deadline"),
        )
    )
    return as_postings(rows, source, as_of)


def polymorphic_json_postings(
    payloads: DataFrame, as_of: datetime | str | Column, source: str = "wanted"
) -> DataFrame:
    """``data`` list or bare list; ``company`` is an object or plain text; the
    title stands under ``position``, else under ``title``."""
    items = _with_ids(_items(payloads, "$.data", "$"))
    company_fields = F.try_variant_get("item", "$.company", "map<string,variant>")
    company = F.when(company_fields.isNotNull(), _text("$.company.name")).otherwise(
        _text("$.company")
    )
    title = F.coalesce(F.try_variant_get("item", "$.position", "string"), _text("$.title"))
    rows = items.select(
        "seq",
        "source_id",
        F.concat(F.lit(DETAIL_URL), "source_id").alias("url"),
        title.alias("title"),
        company.alias("company"),
        _text("$.address.full_location").alias("location"),
    )
    return as_postings(rows, source, as_of)


def embedded_json_postings(
    pages: DataFrame, as_of: datetime | str | Column, source: str = "wanted"
) -> DataFrame:
    """Postings in the state object that a page's script assigns."""
    payloads = pages.select(
        F.col("page_id").alias("payload_id"),
        F.regexp_extract("html", _EMBEDDED, 1).alias("payload"),
    )
    rows = _with_ids(_items(payloads, "$.props.pageProps.jobs")).select(
        "seq",
        "source_id",
        F.concat(F.lit(DETAIL_URL), "source_id").alias("url"),
        _text("$.position").alias("title"),
        _text("$.company.name").alias("company"),
    )
    return as_postings(rows, source, as_of)
