"""WARC derivatives: every response becomes a linked metadata record and a plain-text conversion record.

All of it is column expressions, so a page is read, converted and written where it lies: no shuffle.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CRLF = "\r\n"
#: Entities that a conversion decodes; the ampersand comes last, so that nothing is decoded twice. Fixed values.
ENTITIES = [("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")]
#: (pattern, replacement) in order: what has no text goes, blocks end lines, other tags go, spaces collapse.
STEPS = [
    (r"(?is)<script\b.*?</script\s*>", " "),
    (r"(?is)<style\b.*?</style\s*>", " "),
    (r"(?is)<head\b.*?</head\s*>", " "),
    (r"(?s)<!--.*?-->", " "),
    (r"(?i)</?(?:address|article|aside|blockquote|body|br|div|dl|dd|dt|footer|form|h[1-6]|header|hr|li|main|nav|ol|p|pre|section|table|td|th|tr|ul)\b[^>]*>", "\n"),
    (r"<[!/A-Za-z][^>]*>", ""),
]
SPACES = [(r"[ \t\r\f\x0B]+", " "), (r" ?\n[ \n]*", "\n"), (r"^[ \n]+|[ \n]+$", "")]


def plain_text(html: Column) -> Column:
    """Readable text of a page, one block a line; empty for null."""
    out = F.coalesce(html, F.lit(""))
    for pattern, to in STEPS:
        out = F.regexp_replace(out, pattern, to)
    for name, to in ENTITIES:
        out = F.replace(out, F.lit(name), F.lit(to))
    for pattern, to in SPACES:
        out = F.regexp_replace(out, pattern, to)
    return out


def urn(*parts: Column) -> Column:
    """A name that only depends on the parts, in the form of a UUID."""
    h = F.md5(F.concat_ws("\n", *parts))
    cuts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def sha256_of(x: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(x, 256))


def responses(pages: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Response records of (page_id, url, html): the crawl's own form of a page, one a row.

    Null urls and bodies count as empty. Pages of equal page_id, url and body get equal record ids.
    """
    url, html = F.coalesce("url", F.lit("")), F.coalesce("html", F.lit(""))
    head = F.concat(
        F.lit("HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF + "Content-Length: "),
        F.octet_length(html).cast("string"),
        F.lit(CRLF),
    )
    return pages.select(
        "page_id",
        url.alias("target_uri"),
        F.lit(date).alias("warc_date"),
        head.alias("http_headers"),
        html.alias("payload"),
        sha256_of(html).alias("payload_digest"),
    ).withColumn(
        "record_id", urn(F.lit("response"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), "target_uri", "payload_digest")
    )


def derivatives(records: DataFrame) -> DataFrame:
    """Two rows for every response: warc_type metadata and conversion, each with headers, block and digests.

    Both refer to the response by its id; the metadata record names the conversion and keeps the source's HTTP
    headers, title, digest and link count; the conversion holds the plain text and keeps the source's digest.
    A page without text has an empty conversion. Repeated rows give repeated records. No rows give no rows.
    """
    text = records.withColumn("text", plain_text(F.col("payload"))).withColumn(
        "conversion_id", urn(F.lit("conversion"), F.col("record_id"))
    )
    title = F.trim(F.regexp_replace(F.regexp_extract("payload", r"(?is)<title\b[^>]*>(.*?)</title\s*>", 1), r"\s+", " "))
    links = F.size(F.regexp_extract_all("payload", F.lit(r"(?i)(<a\s[^>]*href\s*=)"), F.lit(1)))
    fields = F.concat(
        F.lit("title: "), title, F.lit(CRLF + "links: "), links.cast("string"),
        F.lit(CRLF + "conversion: "), F.col("conversion_id"),
        F.lit(CRLF + "source-payload-digest: "), F.col("payload_digest"), F.lit(CRLF), F.col("http_headers"),
    )
    both = F.array(
        F.struct(F.lit("metadata").alias("warc_type"), urn(F.lit("metadata"), F.col("record_id")).alias("record_id"), F.lit("application/warc-fields").alias("content_type"), fields.alias("block")),
        F.struct(F.lit("conversion").alias("warc_type"), F.col("conversion_id").alias("record_id"), F.lit("text/plain; charset=utf-8").alias("content_type"), F.col("text").alias("block")),
    )
    rows = text.select(
        "page_id", F.col("record_id").alias("refers_to"), "target_uri", "warc_date", F.col("payload_digest").alias("source_digest"), F.inline(both)
    )
    return rows.withColumn("block_digest", sha256_of(F.col("block"))).withColumn("content_length", F.octet_length("block").cast("long"))


def record_text(rows: DataFrame) -> DataFrame:
    """One column, value: every derivative as a whole WARC/1.1 record."""
    # A line break inside a url would forge headers.
    uri = F.regexp_replace("target_uri", r"[\r\n]", "")
    head = [
        ("WARC-Type", F.col("warc_type")), ("WARC-Record-ID", F.col("record_id")), ("WARC-Date", F.col("warc_date")),
        ("WARC-Target-URI", uri), ("WARC-Refers-To", F.col("refers_to")), ("WARC-Refers-To-Target-URI", uri),
        ("WARC-Source-Payload-Digest", F.col("source_digest")), ("WARC-Block-Digest", F.col("block_digest")),
        ("Content-Type", F.col("content_type")), ("Content-Length", F.col("content_length").cast("string")),
    ]
    lines = [F.concat(F.lit(f"{name}: "), value) for name, value in head]
    return rows.select(F.concat(F.concat_ws(CRLF, F.lit("WARC/1.1"), *lines), F.lit(CRLF * 2), "block", F.lit(CRLF * 2)).alias("value"))


def write_warc(rows: DataFrame, path: str) -> None:
    """WARC files under path, written by the executors through Spark's text writer.

    The writer ends every value with a line break, so a record's own last one is left to it.
    """
    cut = F.expr("substring(value, 1, char_length(value) - 1)")
    record_text(rows).select(cut.alias("value")).write.text(path)
