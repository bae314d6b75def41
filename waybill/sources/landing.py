"""Reading landed payloads.

A landing folder holds API pages as JSON, one page per line (or one per file), or tab-separated reports. Each record
gets ``_seq`` (landing time, file, place in the file, place in the page): the order of arrival, for picks that need one.
A record that is no object costs itself, not its page, and a page of the wrong shape is told from an empty one (see
``pages``).
"""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.schemas.payloads import SETTLEMENT_HEADERS

SEQ = "_seq"
#: Where a page comes from; ``_more`` says that other pages of its pull follow it, in feeds pulled page by page.
ORIGIN = ("_landed", "_file", "_block", "_row", "_more")
NO_JSON, NO_ARRAY, NO_OBJECT = "unreadable page", "page without records", "record is no object"
_LINES = "value string, _landed timestamp, _file string, _block bigint, _row bigint"


def _no_path(error: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in (error.getCondition() or "")


def read_lines(
    spark: SparkSession, path: str, *, page_per_file: bool = False, enabled: bool = True, after: datetime | None = None,
) -> DataFrame:
    """Landed text with its origin. A feed that is switched off or has no folder yet is empty, not an error.

    ``after`` leaves out files that landed up to then, by their listing: they are not opened.
    """
    if enabled:
        try:
            newer = {} if after is None else {
                "modifiedAfter": after.astimezone(UTC).strftime("%Y-%m-%dT%H:%M:%S"), "timeZone": "UTC"}
            text = spark.read.options(**newer).text(path, wholetext=page_per_file, recursiveFileLookup=True)
        except AnalysisException as error:
            if not _no_path(error):
                raise
        else:
            return text.select(
                "value",
                F.col("_metadata.file_modification_time").alias("_landed"),
                F.col("_metadata.file_path").alias("_file"),
                F.col("_metadata.file_block_start").alias("_block"),
                F.monotonically_increasing_id().alias("_row"),
            )
    return spark.createDataFrame([], _LINES)


def page_ddl(record: str, at: str) -> str:
    """Schema of a page whose record array sits at a dotted path: ``payload.Orders`` -> ``payload struct<Orders: ..>``."""
    ddl = f"array<{record}>"
    head, *inner = at.split(".")
    for name in reversed(inner):
        ddl = f"struct<`{name}`: {ddl}>"
    return f"`{head}` {ddl}"


def pages(lines: DataFrame, record: str, at: str, carry: str | None = None) -> DataFrame:
    """What landed pages hold, from one parse of each: a row per element of the record array.

    ``_record`` is the record; where the element is none, ``_reason`` says so and ``_text`` is its text. A page that is no
    JSON, or has no array where its records belong, gives one row of that kind with the whole page as its text; an empty
    array gives one row with neither, so that the page still counts as landed. ``at`` is the path of the record array in
    an object page, ``"[]"`` for bare arrays only, ``"*"`` for bare arrays or an ``items`` envelope; ``carry`` is a field
    beside the array that every record takes along.

    Records are read by one typed parse of the page. Only where that fails is the page taken apart element by element, and
    only where there are no elements is it asked whether the page is JSON at all.
    """
    typed, beside = _typed(record, at, carry)
    kind = f"array<struct<record: {record}, reason: string, text: string>>"

    def entry(rec: Column, reason: Column, text: Column) -> Column:
        return F.struct(rec.alias("record"), reason.alias("reason"), text.alias("text"))

    def judged(rec: Column, text: Column) -> Column:
        bad = rec.isNull()
        return entry(rec, F.when(bad, F.lit(NO_OBJECT)), F.when(bad, F.coalesce(text, F.lit("null"))))

    def single(text: Column) -> Column:
        return F.struct(text.alias("t"), F.when(F.ltrim(text).startswith("{"), F.from_json(text, record)).alias("r"))

    def whole(reason: str) -> Column:
        return F.array(entry(F.lit(None).cast(record), F.lit(reason), F.col("value"))).cast(kind)

    elements = F.coalesce(
        F.transform(F.col("_typed"), lambda r: judged(r, F.lit(None).cast("string"))).cast(kind),
        F.transform(F.transform(_texts(at), single), lambda e: judged(e["r"], e["t"])).cast(kind),
        F.when(F.trim("value") == "", F.array().cast(kind))
        .when(F.try_parse_json("value").isNull(), whole(NO_JSON)).otherwise(whole(NO_ARRAY)))
    origin = [c for c in ORIGIN if c in lines.columns]
    parsed = lines.withColumn("_page", typed) if carry else lines.withColumn("_typed", typed)
    if carry:
        parsed = parsed.withColumns({"_typed": F.col(f"_page.{at}"), "_carried": F.coalesce(F.col(f"_page.{beside}"), F.get_json_object("value", f"$.{beside}"))})
    # A plain explode makes the optimizer test the array for emptiness first, and so parse every page three times; the
    # outer form parses it once.
    rows = parsed.select(*origin, *([F.col("_carried").alias(carry)] if carry else []),
                         F.posexplode_outer(elements).alias("_pos", "_element"))
    return rows.select(
        F.col("_element.record").alias("_record"), F.col("_element.reason").alias("_reason"), F.col("_element.text").alias("_text"),
        *([carry] if carry else []), F.struct(*origin, "_pos").alias(SEQ))


def records_of(found: DataFrame) -> DataFrame:
    """The records of ``pages``, their fields as columns."""
    carried = [c for c in found.columns if c not in ("_record", "_reason", "_text", SEQ)]
    return found.filter(F.col("_record").isNotNull()).select("_record.*", *carried, SEQ)


def rejected(found: DataFrame) -> DataFrame:
    """``(reason, value, _file)`` of everything ``pages`` found that is no record."""
    return found.filter(F.col("_reason").isNotNull()).select(
        F.col("_reason").alias("reason"), F.col("_text").alias("value"), F.col(f"{SEQ}._file").alias("_file"))


def _typed(record: str, at: str, carry: str | None) -> tuple[Column, str | None]:
    """The record array of a page by a typed parse (with ``carry``: the page), and the path of the field beside it."""
    bare = F.when(F.ltrim("value").startswith("["), F.from_json("value", f"array<{record}>"))
    if at == "[]":
        return bare, None
    if at == "*":
        envelope = F.from_json("value", f"items array<{record}>")["items"]
        return F.when(F.ltrim("value").startswith("["), F.from_json("value", f"array<{record}>")).otherwise(envelope), None
    ddl, parent = page_ddl(record, at), at.rpartition(".")[0]
    if carry:
        last = at.split(".")[-1]
        return F.from_json("value", ddl.replace(f"struct<`{last}`:", f"struct<`{carry}`: string, `{last}`:", 1)), f"{parent}.{carry}"
    head, *inner = at.split(".")
    found = F.from_json("value", ddl)[head]
    for name in inner:
        found = found[name]
    return found, None


def _texts(at: str) -> Column:
    """The elements of a page's record array as JSON text."""
    bare = F.when(F.ltrim("value").startswith("["), F.from_json("value", "array<string>"))
    if at == "[]":
        return bare
    if at == "*":
        return F.coalesce(bare, F.from_json("value", "items array<string>")["items"])
    first, *inner = at.split(".")
    texts = F.from_json("value", page_ddl("string", at))[first]
    for name in inner:
        texts = texts[name]
    return texts


def object_records(lines: DataFrame, record: str, at: str, carry: str | None = None) -> DataFrame:
    """Records of object pages; ``carry`` is a page-level field next to the array that every record takes along."""
    return records_of(pages(lines, record, at, carry))


def envelope_records(lines: DataFrame, record: str) -> DataFrame:
    """Records of pages that are a bare array or ``{"items": [...], "next": ...}``, told apart by the first character."""
    return records_of(pages(lines, record, "*"))


def array_records(lines: DataFrame, record: str) -> DataFrame:
    """Records of bare-array pages; an object page gives none."""
    return records_of(pages(lines, record, "[]"))


def without_repeated_pages(lines: DataFrame) -> DataFrame:
    """Lines without those whose text landed before, told by a 256-bit hash; the earliest stays.

    Hashes and places are reduced in each input partition; texts are only shuffled if the places kept do not fit a
    broadcast.
    """
    origin = [c for c in ORIGIN if c in lines.columns]
    place = F.struct(*origin)
    first = lines.groupBy(F.sha2("value", 256).alias("_text")).agg(F.min(place).alias("_first")).select("_first")
    return lines.join(first, place == F.col("_first"), "left_semi")


def unreadable(lines: DataFrame) -> DataFrame:
    """Pages that are no JSON at all, for the quarantine."""
    return lines.filter((F.trim("value") != "") & F.try_parse_json("value").isNull()).select("_file", "value")


def broken(lines: DataFrame, at: str) -> DataFrame:
    """``(reason, value, _file)`` of pages that are no JSON or have no record array, and of elements that are no objects."""
    return rejected(pages(lines, "struct<`_`: string>", at))


def read_report(
    spark: SparkSession, path: str, *, enabled: bool = True, start: datetime | None = None, end: datetime | None = None,
) -> DataFrame:
    """Lines of tab-separated reports, all text, by header name; a column no report has is NULL.

    Files of one read must share one header: a differing file fails the read rather than shift its columns. ``start`` and
    ``end`` are seconds, both included, between which a file landed; others are left out by their listing, not opened.
    """
    if enabled:
        # The listing takes files strictly between its bounds.
        bounds = {"modifiedAfter": start and start - timedelta(seconds=1), "modifiedBefore": end and end + timedelta(seconds=1)}
        ranged = {k: at.astimezone(UTC).strftime("%Y-%m-%dT%H:%M:%S") for k, at in bounds.items() if at}
        try:
            raw = (
                spark.read.options(**ranged, **({"timeZone": "UTC"} if ranged else {})).option("recursiveFileLookup", True)
                .csv(path, sep="\t", header=True, inferSchema=False, enforceSchema=False)
            )
        except AnalysisException as error:
            if not _no_path(error) and not (ranged and error.getCondition() == "UNABLE_TO_INFER_SCHEMA"):
                raise  # no file in the range is no error
        else:
            if start:
                raw = raw.filter(F.col("_metadata.file_modification_time") >= F.lit(start))
            fields = [
                (F.col(f"`{h}`") if h in raw.columns else F.lit(None).cast("string")).alias(h)
                for h in SETTLEMENT_HEADERS
            ]
            place = F.struct(
                F.col("_metadata.file_modification_time").alias("_landed"),
                F.col("_metadata.file_path").alias("_file"),
                F.col("_metadata.file_block_start").alias("_block"),
                F.monotonically_increasing_id().alias("_row"),
            )
            return raw.select(*fields, F.col("_metadata.file_path").alias("report"), place.alias(SEQ))
    names = ", ".join(f"`{h}` string" for h in SETTLEMENT_HEADERS)
    return spark.createDataFrame(
        [], f"{names}, report string, {SEQ} struct<_landed: timestamp, _file: string, _block: bigint, _row: bigint>"
    )


def split_report_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Tab-separated text of known column order (``SETTLEMENT_HEADERS``) held in a column, as report columns."""
    cells = F.split(line, "\t", -1)
    others = [c for c in lines.columns if c != line]
    return lines.select(*others, *[F.get(cells, F.lit(i)).alias(h) for i, h in enumerate(SETTLEMENT_HEADERS)])
