"""WARC archives: written by Spark's text writer, read back by boundary-chain verification."""

from __future__ import annotations

import math
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mercato.session import cut_lineage, ensure_checkpoint_dir, write_table

MAGIC = "WARC/1.1\r\n"  # record start (fixed by ISO 28500)
BREAK = "\r\n\r\n"  # ends a header, and a record
DATE = "2024-01-01T00:00:00Z"
RECORDS_PER_FILE = 50_000
# base32 digits in the order of their values (RFC 4648), and the digits conv() writes for them
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CONV32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def base32_sha1(data: F.Column) -> F.Column:
    """Upper-case base32 SHA-1 of a binary or string column: 8 groups of 5 hex digits are 4 digits each."""
    digest = F.sha1(data)
    groups = [F.lpad(F.conv(F.substring(digest, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*groups), CONV32, BASE32)


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0,
                   records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write one WARC record per row of pages (page_id, url, html) under path.

    Of pages with equal payloads (by digest and length) of at least min_bytes bytes, the one with
    the smallest page_id becomes a response record, the others revisit records that name it;
    shorter ones are all responses. The smallest id per digest is combined before the shuffle.
    Each Spark task writes files of at most records_per_file records: the records in a row, each
    ended by the two line ends that the format asks for.
    """
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"),
                        F.coalesce("html", F.lit("")).alias("html"))
    # a line end inside a URL would end its header line
    rows = (rows.withColumn("url", F.regexp_replace("url", r"[\r\n]", "%0A"))
            .withColumn("bytes", F.octet_length("html").cast("long")).withColumn("digest", base32_sha1(F.col("html"))))
    copied = rows.groupBy("digest", "bytes").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    # written, so that the planner knows its size: payloads are only shuffled if copies are many
    copied, _ = write_table(copied.where((F.col("n") > 1) & (F.col("bytes") >= min_bytes)).drop("n"), "warc-copied")
    rows = rows.join(copied, ["digest", "bytes"], "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("bytes").cast("string"), F.lit(BREAK))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("html")))
    name = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    header = F.concat(
        F.lit(MAGIC + "WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Record-ID: <urn:page:"), name,
        F.lit(">\r\nWARC-Target-URI: "), F.col("url"),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(revisit, F.concat(
            F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
                  "\r\nWARC-Refers-To: <urn:page:"), F.col("first_id").cast("string"), F.lit(">"))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"), F.lit(BREAK))
    (rows.select(F.concat(header, block, F.lit("\r\n")).alias("value")).write
     .option("lineSep", "\r\n").option("maxRecordsPerFile", records_per_file).mode("errorifexists").text(path))


def _field(name: str) -> F.Column:
    return F.regexp_extract("header", rf"(?im)^{name}:[ \t]*([^\r\n]*)", 1)


def _fragments(spark: SparkSession, path: str) -> DataFrame:
    """Every stretch of the archives between two record starts, with its place."""
    raw = spark.read.option("lineSep", MAGIC).text(path)
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("file_size"),
                      F.col("_metadata.file_block_start").alias("block"),
                      F.monotonically_increasing_id().alias("seq"), "value")


def _exits(pdf: pd.DataFrame) -> pd.DataFrame:
    """Follow the successors inside one block, from its last candidate back: where each chain leaves."""
    pdf = pdf.sort_values("off")
    off, succ = pdf["off"].to_numpy(np.int64), pdf["succ"].to_numpy(np.int64)
    leave = succ.copy()
    at = np.searchsorted(off, succ)
    inside = (at < len(off)) & (off[np.minimum(at, len(off) - 1)] == succ)
    for k in np.flatnonzero(inside)[::-1]:
        if succ[k] > off[k]:
            leave[k] = leave[at[k]]
    return pd.DataFrame({"file": pdf["file"], "off": off, "leave": leave})


def _marked(pdf: pd.DataFrame) -> pd.DataFrame:
    """Follow the successors inside one block from the entries: which candidates are records."""
    pdf = pdf.sort_values("off")
    off, succ = pdf["off"].to_numpy(np.int64), pdf["succ"].to_numpy(np.int64)
    real = pdf["entry"].to_numpy(bool).copy()
    at = np.searchsorted(off, succ)
    inside = (at < len(off)) & (off[np.minimum(at, len(off) - 1)] == succ) & (succ > off)
    for k in range(len(off)):
        if real[k] and inside[k]:
            real[at[k]] = True
    return pd.DataFrame({"file": pdf["file"][real], "off": off[real], "succ": succ[real]})


def record_chain(candidates: DataFrame) -> DataFrame:
    """The candidates (file, block, off, succ) that the chain from offset 0 of their file reaches.

    Each block first contracts its own chains (a block is one input split, so bounded); then
    pointer jumping runs over the files' blocks: every round joins the offsets reached so far with
    a table whose jumps double, so a file of b blocks takes about log2(b) rounds.
    """
    jumps = cut_lineage(candidates.groupBy("file", "block").applyInPandas(
        _exits, "file string, off long, leave long"))
    blocks = candidates.groupBy("file").agg(F.countDistinct("block").alias("n")).agg(F.max("n")).first()[0] or 0
    reached = cut_lineage(candidates.where("off = 0").select("file", "off").distinct())
    rounds = max(1, math.ceil(math.log2(blocks + 1))) if blocks else 0
    for k in range(rounds):
        further = reached.join(jumps, ["file", "off"]).select("file", F.col("leave").alias("off"))
        reached = cut_lineage(reached.unionByName(further).distinct())
        if k + 1 < rounds:
            onward = jumps.select("file", F.col("off").alias("leave"), F.col("leave").alias("next"))
            jumps = cut_lineage(jumps.join(onward, ["file", "leave"]).select(
                "file", "off", F.col("next").alias("leave")))
    entries = reached.select("file", "off", F.lit(True).alias("entry"))
    marked = candidates.join(entries, ["file", "off"], "left").withColumn("entry", F.coalesce("entry", F.lit(False)))
    return marked.groupBy("file", "block").applyInPandas(_marked, "file string, off long, succ long")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, url, record_type, payload_bytes, payload_digest, declared_digest, refers_to).

    The text reader splits the files at the record start wherever it occurs, also in parallel
    inside a file, so payloads that contain it give false candidates. Every candidate's header
    names its length and so its successor; record_chain keeps those that a file's start reaches.
    A record whose payload holds record starts spans several stretches and is put together again.
    For responses, size and digest are computed from the payload read; for revisits they are those
    that the header and the stored HTTP header state. Only sizes, offsets and digests are
    shuffled; payloads are not, but for those of spanning records.
    """
    magic = len(MAGIC)
    parts = _fragments(spark, path)
    cut = F.instr("value", BREAK)
    parsed = (parts.withColumn("header", F.substring_index("value", BREAK, 1))
              .withColumn("length", _field("Content-Length").try_cast("long"))
              .withColumn("block_text", F.expr(f"substring(value, instr(value, '\\r\\n\\r\\n') + {len(BREAK)})"))
              .withColumn("has_header", (cut > 0) & F.col("length").isNotNull()))
    body = F.expr(f"substring(block_text, 1, length(block_text) - {len(BREAK)})")
    payload = F.expr(f"substring(body, instr(body, '\\r\\n\\r\\n') + {len(BREAK)})")
    size = F.octet_length("value").cast("long")
    head = F.octet_length("header").cast("long")
    whole = F.col("has_header") & (head + len(BREAK) + F.col("length") + len(BREAK) == size)
    narrow = (parsed.withColumn("whole", whole).withColumn("body", F.when(whole, body))
              .withColumn("payload", payload)
              .select("file", "file_size", "block", "seq", size.alias("size"),
                      F.when(F.col("has_header"), head).alias("head"), "length", "whole",
                      F.when(F.col("has_header"), F.struct(
                          _field("WARC-Type").alias("type"), _field("WARC-Record-ID").alias("id"),
                          _field("WARC-Target-URI").alias("url"), _field("WARC-Payload-Digest").alias("digest"),
                          _field("WARC-Refers-To").alias("refers"))).alias("fields"),
                      F.regexp_extract("body", r"(?im)^Content-Length:[ \t]*(\d+)", 1).alias("http_length"),
                      F.octet_length("payload").cast("long").alias("payload_bytes"),
                      base32_sha1(F.col("payload")).alias("payload_digest")))
    table, _ = write_table(narrow, "warc-parts")
    before = Window.partitionBy("file").orderBy("block", "seq").rowsBetween(Window.unboundedPreceding, -1)
    # the first stretch of a file lies before its first record start and is empty
    placed = table.withColumn("off", F.coalesce(F.sum(F.col("size") + magic).over(before), F.lit(0)) - magic)
    placed, _ = write_table(placed.where("off >= 0"), "warc-places")
    candidates = placed.where("head IS NOT NULL").select(
        "file", "block", "off",
        (F.col("off") + magic + F.col("head") + 2 * len(BREAK) + F.col("length")).alias("succ"))
    real = record_chain(candidates)
    records = placed.join(real, ["file", "off"])
    spanning = records.where("NOT whole").select("file", "off", "succ")
    single = records.where("whole").select("fields", "http_length", "payload_bytes", "payload_digest")
    if not spanning.isEmpty():
        single = single.unionByName(_spanning(parts, placed, real, spanning))
    number = r"<urn:page:(-?\d+)>"
    revisit = F.col("fields.type") == "revisit"
    declared = F.substring_index("fields.digest", ":", -1)
    return single.select(
        F.expr(f"try_cast(regexp_extract(fields.id, '{number.replace(chr(92), chr(92) * 2)}', 1) AS bigint)").alias("page_id"),
        F.col("fields.url").alias("url"), F.col("fields.type").alias("record_type"),
        F.when(revisit, F.expr("try_cast(http_length AS bigint)")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(revisit, declared).otherwise(F.col("payload_digest")).alias("payload_digest"),
        declared.alias("declared_digest"),
        F.expr(f"try_cast(regexp_extract(fields.refers, '{number.replace(chr(92), chr(92) * 2)}', 1) AS bigint)").alias("refers_to"))


def _spanning(parts: DataFrame, placed: DataFrame, real: DataFrame, spanning: DataFrame) -> DataFrame:
    """Records whose payload holds record starts: their stretches, put together in file order."""
    starts = real.select("file", "off", F.col("off").alias("start"))
    upto = Window.partitionBy("file").orderBy("off").rowsBetween(Window.unboundedPreceding, 0)
    owned = (placed.select("file", "block", "seq", "off").join(starts, ["file", "off"], "left")
             .withColumn("start", F.last("start", ignorenulls=True).over(upto)))
    wanted = owned.join(spanning.select("file", F.col("off").alias("start")), ["file", "start"], "left_semi")
    texts = wanted.join(parts.select("file", "block", "seq", "value"), ["file", "block", "seq"])
    whole = texts.groupBy("file", "start").agg(F.concat_ws(MAGIC, F.transform(
        F.array_sort(F.collect_list(F.struct("off", "value"))), lambda x: x["value"])).alias("value"))
    head = placed.select("file", F.col("off").alias("start"), "fields", "length")
    body = F.expr(f"substring(value, instr(value, '\\r\\n\\r\\n') + {len(BREAK)}, "
                  f"length(value) - instr(value, '\\r\\n\\r\\n') + 1 - {2 * len(BREAK)})")
    return (whole.join(head, ["file", "start"]).withColumn("body", body)
            .withColumn("payload", F.expr(f"substring(body, instr(body, '\\r\\n\\r\\n') + {len(BREAK)})"))
            .select("fields", F.regexp_extract("body", r"(?im)^Content-Length:[ \t]*(\d+)", 1).alias("http_length"),
                    F.octet_length("payload").cast("long").alias("payload_bytes"),
                    base32_sha1(F.col("payload")).alias("payload_digest")))


def archived_pages(pages: DataFrame, min_bytes: int = 0, records_per_file: int = RECORDS_PER_FILE) -> DataFrame:
    """Write pages to archives in the shared folder and read them back; see the two functions.

    Null html is an empty payload, null url an empty URI, null page_id an empty id that never is
    the smallest of its group (all rows of a group without any id are responses). Rows that repeat
    the smallest page_id of their payload are all responses. Other columns are ignored. An empty
    table gives no rows. Files are plain (uncompressed) WARC 1.1.
    """
    spark = pages.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/archives/{uuid.uuid4().hex}"
    write_archives(pages, path, min_bytes, records_per_file)
    return read_archives(spark, path)
