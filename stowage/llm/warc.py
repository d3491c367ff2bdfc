"""A content-addressed archive of WARC records: payloads once, headers apart, records again by a join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

CRLF = "\r\n"
#: The digits of base 32 in order, and those of RFC 4648.
_DIGITS, _ALPHABET = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base 32, as WARC digests are written: five hexadecimal digits are four of base 32."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*groups), _DIGITS, _ALPHABET)


def _line(name: str, value: Column) -> Column:
    """A header line; none where the value is null. Line breaks in a value are percent-encoded."""
    safe = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), safe, F.lit(CRLF))).otherwise("")


def _record_id(key: Column, sha256: Column) -> Column:
    digest = F.md5(F.concat_ws("\0", F.lit("record"), F.coalesce(key.cast("string"), F.lit("\0")), sha256))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws(
        "-", *[F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def digested(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """``_key``, ``_url``, ``payload`` (the body in UTF-8, empty where it is null), its size and digests, for every page."""
    payload = F.coalesce(F.encode(F.col(body), "UTF-8"), F.lit(b""))
    return pages.select(F.col(key).alias("_key"), F.col(url).alias("_url"), payload.alias("payload")).select(
        "*", F.sha2("payload", 256).alias("sha256"), base32_sha1(F.col("payload")).alias("sha1"),
        F.octet_length("payload").cast("long").alias("bytes"))


def headers(found: DataFrame, key: str = "page_id", date: str = "2024-01-01T00:00:00Z", smallest: int = 0) -> DataFrame:
    """``key``, ``header`` (the exact bytes before the payload) and ``sha256`` of a WARC record for every page.

    Of the records with equal payloads of ``smallest`` bytes or more, the one with the greatest key is a response and the
    others revisit it; smaller ones are all responses. Rows that share the greatest key are all responses; a null key
    is less than any other. A null url has no line. Payloads are not shuffled for this.
    """
    own = found.select("_key", "_url", "sha256", "sha1", "bytes")
    # One row for each digest and task before the shuffle, however often a payload occurs.
    holders = own.filter(F.col("bytes") >= smallest).groupBy(F.col("sha256").alias("_sha256")).agg(
        F.max("_key").alias("_holder"))
    rows = own.join(holders, F.col("sha256") == F.col("_sha256"), "left")
    revisit = F.col("_holder").isNotNull() & ~F.col("_key").eqNullSafe(F.col("_holder"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=UTF-8{CRLF}Content-Length: "),
                    F.col("bytes").cast("string"), F.lit(CRLF * 2))
    block = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("bytes"))
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _record_id(F.col("_key"), F.col("sha256"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.col("_url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        _line("WARC-Refers-To", F.when(revisit, _record_id(F.col("_holder"), F.col("sha256")))),
        _line("WARC-Refers-To-Key", F.when(revisit, F.col("_holder").cast("string"))),
        _line("WARC-Profile", F.when(revisit, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", block.cast("string")),
        F.lit(CRLF), http)
    return rows.select(F.col("_key").alias(key), F.encode(header, "UTF-8").alias("header"), "sha256")


def archive(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", body: str = "html",
            smallest: int = 0) -> None:
    """Write a record for every page under ``path``: ``headers`` in full, and ``payloads``, each content once by SHA-256.

    Which row a payload is taken from does not matter, since its digest names it and is verified on reading. Every task
    drops its own copies before payloads are shuffled. Other columns of the pages are ignored; an empty table gives an
    empty archive.
    """
    found = digested(pages, key, url, body)
    headers(found, key, smallest=smallest).write.mode("overwrite").parquet(f"{path}/headers")
    found.select("sha256", "payload").dropDuplicates(["sha256"]).write.mode("overwrite").parquet(f"{path}/payloads")


def _field(name: str) -> Column:
    value = F.regexp_extract(F.decode("header", "UTF-8"), rf"(?md)^{name}: ([^\r\n]*)\r$", 1)
    return F.when(value != "", value)  # (?d): a line ends at \n only, whatever else a url may hold


def restored(spark: SparkSession, path: str, key: str = "page_id") -> DataFrame:
    """Every archived record again: ``key``, ``record_type``, ``payload_digest``, ``refers_to``, ``payload``, ``record``.

    ``payload`` is the full payload, also of revisits; ``record`` the bytes of the WARC record, in which a revisit has no
    payload. A payload whose bytes do not have the digest that names it fails the read, and so does a record
    without its payload.
    """
    headers, payloads = spark.read.parquet(f"{path}/headers"), spark.read.parquet(f"{path}/payloads")
    joined = headers.join(payloads, "sha256", "left")
    sound = F.when(F.sha2("payload", 256) == F.col("sha256"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("payload missing or damaged: "), "sha256")).cast("binary"))
    kind = _field("WARC-Type")
    tail = F.lit(CRLF * 2).cast("binary")
    return joined.withColumn("payload", sound).select(
        key, kind.alias("record_type"), F.regexp_replace(_field("WARC-Payload-Digest"), "^sha1:", "").alias("payload_digest"),
        _field("WARC-Refers-To-Key").alias("refers_to"), "payload",
        F.when(kind == "revisit", F.concat("header", tail)).otherwise(F.concat("header", "payload", tail)).alias("record"))
