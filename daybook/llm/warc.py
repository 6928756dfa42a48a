"""Content-addressed WARC archive: payloads once by digest, headers apart, records by join.

``archive`` turns pages into two tables:

* ``headers``: per record its exact header block as text, the SHA-256 of its payload and
  its id;
* ``payloads``: each distinct payload once, under its SHA-256.

``records`` joins them back into complete WARC records and refuses (by an error) a stored
payload that does not hash to its key or whose length differs from the header's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import stored

CRLF = "\r\n"
#: The digits of conv() in base 32 and those of RFC 4648.
DIGITS_32, RFC_4648 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Fixed value: the profile named in revisit records.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of SHA-1: 40 hex digits are 8 groups of 4 base-32 digits."""
    hexed = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(hexed, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), DIGITS_32, RFC_4648)


def _uuid(text: Column) -> Column:
    h = F.md5(text.cast("binary"))
    return F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def archive(pages: DataFrame, date: str = "2024-01-01T00:00:00Z", min_bytes: int = 0) -> tuple[DataFrame, DataFrame]:
    """Writes the archive of ``pages`` (page_id, url, html) and returns (headers, payloads).

    One record per row.  Of records with equal payloads of at least ``min_bytes`` bytes the
    one with the largest page_id is the response, the others revisit it; smaller payloads
    are all responses.  A null html is an empty payload, a null url leaves out the target
    header.  A null page_id counts as smaller than any other; rows that repeat the response's page_id
    and payload are responses too.  An empty table gives an empty archive.  Other columns are not looked at.

    Only digests and ids are grouped with all rows; payload bytes are reduced to one per
    digest within each task before they are shuffled, so a page held by a third of
    all rows is moved once per task.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    keyed = rows.select(
        "page_id",
        "url",
        "payload",
        F.sha2("payload", 256).alias("sha256"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
    )
    payloads = stored(
        keyed.groupBy("sha256").agg(F.max("page_id").alias("keeper"), F.first("payload").alias("payload")), "warc-payloads"
    )
    held = payloads.select(F.col("sha256").alias("held"), "keeper")
    joined = keyed.select("page_id", "url", "sha256", "payload_bytes", base32_sha1(F.col("payload")).alias("sha1")).join(
        held, F.col("sha256") == F.col("held")
    )
    response = (F.col("payload_bytes") < min_bytes) | F.col("page_id").eqNullSafe(F.col("keeper"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    id_of = lambda page: F.concat(F.lit("<urn:uuid:"), _uuid(F.concat_ws(":", page, F.col("sha256"))), F.lit(">"))
    refers = F.when(~response, F.col("keeper"))
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.when(response, "response").otherwise("revisit")),
        line("WARC-Record-ID", id_of(F.coalesce(F.col("page_id").cast("string"), F.lit("none")))),
        line("WARC-Date", F.lit(date)),
        F.when(F.col("url").isNotNull(), line("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]", ""))).otherwise(""),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(
            response, line("Content-Type", F.lit("text/html; charset=utf-8"))
        ).otherwise(
            F.concat(
                F.lit(f"WARC-Profile: {PROFILE}{CRLF}"),
                line("WARC-Refers-To", id_of(F.coalesce(F.col("keeper").cast("string"), F.lit("none")))),
                line("X-Refers-To-Page", F.coalesce(F.col("keeper").cast("string"), F.lit(""))),
                line("X-Payload-Length", F.col("payload_bytes").cast("string")),
            )
        ),
        line("Content-Length", F.when(response, F.col("payload_bytes")).otherwise(F.lit(0)).cast("string")),
        F.lit(CRLF),
    )
    headers = stored(joined.select("page_id", "sha256", header.alias("header")), "warc-headers")
    return headers, payloads.select("sha256", "payload")


def field(header: Column, name: str) -> Column:
    """The value of a header line, null where the header has no such line."""
    value = F.regexp_extract(header, rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(header.rlike(rf"\r\n{name}: "), value)


def records(headers: DataFrame, payloads: DataFrame) -> DataFrame:
    """(page_id, header, payload) of every record, the payload joined back and verified."""
    checked = payloads.select(
        F.col("sha256").alias("held"),
        F.when(F.sha2("payload", 256) == F.col("sha256"), F.col("payload"))
        .otherwise(F.raise_error(F.concat(F.lit("damaged payload "), F.col("sha256"))).cast("binary"))
        .alias("payload"),
    )
    length = F.coalesce(field(F.col("header"), "X-Payload-Length"), field(F.col("header"), "Content-Length"))
    return headers.join(checked, F.col("sha256") == F.col("held"), "left").select(
        "page_id",
        "header",
        F.when(F.octet_length("payload") == length.cast("bigint"), F.col("payload"))
        .otherwise(F.raise_error(F.concat(F.lit("no payload of the stated length for "), F.col("sha256"))).cast("binary"))
        .alias("payload"),
    )


def record_bytes(header: Column, payload: Column) -> Column:
    """A complete WARC record; the block of a revisit is empty."""
    block = F.when(field(header, "WARC-Type") == "response", payload).otherwise(F.lit(b""))
    return F.concat(header.cast("binary"), block, F.lit((CRLF + CRLF).encode()))


def digest(headers: DataFrame, payloads: DataFrame) -> DataFrame:
    """What the archive says of each record, payload figures taken from the payload read back."""
    read = records(headers, payloads)
    return read.select(
        "page_id",
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"),
        field(F.col("header"), "WARC-Type").alias("record_type"),
        field(F.col("header"), "X-Refers-To-Page").try_cast("bigint").alias("refers_to"),
        (field(F.col("header"), "WARC-Payload-Digest") == F.concat(F.lit("sha1:"), base32_sha1(F.col("payload")))).alias(
            "digest_matches"
        ),
    )


PAGES_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages
), d AS (
  SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS h,
         max(page_id) OVER (PARTITION BY sha256(html)) AS keeper FROM p
)
SELECT page_id, payload_bytes,
  translate(concat({groups}), '{digits}', '{rfc}') AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM keeper THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM keeper THEN keeper END AS refers_to,
  true AS digest_matches
FROM d
""".format(
    groups=", ".join(f"lpad(to_base(('0x' || substr(h, {1 + 5 * i}, 5))::BIGINT, 32), 4, '0')" for i in range(8)),
    digits=DIGITS_32,
    rfc=RFC_4648,
)
