"""WARC derivatives of captured pages (operator 6).

Every response record gives two linked records: ``metadata`` (title, out-links
and the source's headers and digests) and ``conversion`` (the page as plain
text). Both name the response in ``WARC-Refers-To`` and carry its target URI
and date; the conversion also names the metadata in ``WARC-Concurrent-To``. Record ids are
UUIDs derived from the response's id, so a repeated run gives the same files.

Built from Spark's own string functions only; one pass, no shuffle.

Defined results: a null page or URL counts as empty text, and a page without
title or links has a metadata record without those fields; a null ``page_id``
gives records whose id is derived from an empty key; repeated pages give
repeated records with equal ids; an empty table gives an empty table; other
columns are ignored. Named character references outside ``ENTITIES`` and
numeric ones stay as written, in titles, links and text.

An out-link is the first ``href`` attribute of an ``a`` element, with double
quotes, single quotes or none and with or without spaces around ``=``; names
that only end in ``href`` are other attributes. The SQL oracle reads the
double-quoted form alone, the only one on the test pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CRLF = "\r\n"
#: Capture date written for tables that have none.
DATE = "1970-01-01T00:00:00Z"
#: Elements whose content is no text.
HIDDEN = ("script", "style", "noscript", "template", "title")
#: Elements that end a line.
BLOCKS = "address|article|aside|blockquote|br|dd|div|dl|dt|figcaption|figure|footer|form|h[1-6]|header|hr|li|main|nav|ol|option|p|pre|section|table|tbody|td|tfoot|th|thead|tr|ul"
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&#39;": "'", "&copy;": "©",
            "&reg;": "®", "&middot;": "·", "&hellip;": "…", "&ndash;": "–", "&mdash;": "—", "&amp;": "&"}
_GAP = "[ \\t\\r\\n\\f]"
#: (pattern, replacement) in order, as understood by both Java and RE2.
TEXT_STEPS = [
    ("(?is)<(?:!--.*?--|" + "|".join(f"{e}(?:{_GAP}[^>]*)?>.*?</{e}{_GAP}*" for e in HIDDEN) + ")>", ""),
    (f"(?i)</?(?:{BLOCKS})(?:[ \\t\\r\\n\\f/][^>]*)?>", "\n"),
    ("<[^>]*>", ""),
]
SPACE_STEPS = [(f"[ \\t\\r\\f]*\\n{_GAP}*", "\n"), ("[ \\t\\r\\f]+", " ")]
TITLE = "(?is)<title[^>]*>(.*?)</title"
#: The oracle's links.
LINK = "(?i)<a[ \\t\\r\\n\\f][^>]*?href=\"([^\"]*)\""
_VALUE = f"{_GAP}*={_GAP}*(?:\"[^\"]*+\"|'[^']*+'|[^ \\t\\r\\n\\f>\"'][^ \\t\\r\\n\\f>]*+)"
_NAME = "[^ \\t\\r\\n\\f>=/\"'][^ \\t\\r\\n\\f>=/]*+"
#: An anchor up to its first ``href`` attribute, with the value in its quotes:
#: other attributes are read as a whole, so that no value counts as a name.
ANCHOR = (f"(?i)<a(?={_GAP}|/)(?:(?:{_GAP}|/)++|(?<=[ \\t\\r\\n\\f/\"'])(?!href(?:{_GAP}|=|/|>)){_NAME}(?:{_VALUE})?+"
          f"|[\"'=][^ \\t\\r\\n\\f>=/]*+)*+(?<=[ \\t\\r\\n\\f/\"'])href{_GAP}*={_GAP}*"
          f"(\"[^\"]*+\"|'[^']*+'|[^ \\t\\r\\n\\f>\"'][^ \\t\\r\\n\\f>]*+)")


def _steps(column: Column, steps) -> Column:
    for pattern, to in steps:
        column = F.regexp_replace(column, F.lit(pattern), F.lit(to))
    return column


def _entities(column: Column) -> Column:
    for name, to in ENTITIES.items():
        column = F.replace(column, F.lit(name), F.lit(to))
    return column


def plain_text(html: Column) -> Column:
    return F.trim(_steps(_entities(_steps(html, TEXT_STEPS)), SPACE_STEPS), F.lit(" \n"))


def _line(column: Column) -> Column:
    """One header line's value: no line breaks."""
    return F.trim(F.regexp_replace(column, "[ \\t\\r\\n\\f]+", " "))


def _link(value: Column) -> Column:
    """A link from its attribute value as written."""
    quoted = F.substring(value, 1, 1).isin('"', "'")
    return _line(_entities(F.when(quoted, value.substr(F.lit(2), F.length(value) - 2)).otherwise(value)))


def urn(*key: Column) -> Column:
    h = F.md5(F.concat_ws("|", *key))
    return F.concat(F.lit("<urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-3"),
                    F.substring(h, 14, 3), F.lit("-a"), F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12),
                    F.lit(">"))


def digest(column: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(column, 256))


def responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """Response records of a ``page_id, url, html`` table."""
    page = pages.select(
        "page_id", F.coalesce("url", F.lit("")).alias("target_uri"), F.coalesce("html", F.lit("")).alias("payload"),
        urn(F.lit("response"), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
            F.coalesce("url", F.lit(""))).alias("response_id"),
        F.lit(date).alias("date"))
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.octet_length("payload").cast("string"))
    return page.withColumn("http_headers", head)


def derivatives(source: DataFrame) -> DataFrame:
    """One row per derived record: ``page_id, warc_type, record_id, refers_to,
    target_uri, content_type, content_length, block_digest, header, block``.

    ``source``: ``page_id, response_id, target_uri, date, http_headers, payload``.
    """
    fields = source.select(
        "page_id", "response_id", "date", _line(F.col("target_uri")).alias("target_uri"),
        urn(F.lit("metadata"), F.col("response_id")).alias("metadata_id"),
        urn(F.lit("conversion"), F.col("response_id")).alias("conversion_id"),
        plain_text(F.col("payload")).alias("text"),
        _line(_entities(F.regexp_extract("payload", TITLE, 1))).alias("title"),
        F.transform(F.regexp_extract_all("payload", F.lit(ANCHOR), F.lit(1)), _link).alias("links"),
        F.regexp_replace(F.col("http_headers"), "\\r\\n", F.lit(f"{CRLF}source-header: ")).alias("headers"),
        digest(F.col("payload")).alias("payload_digest"),
        digest(F.concat("http_headers", F.lit(CRLF + CRLF), "payload")).alias("block_digest"))
    metadata = F.concat(
        F.lit("source-header: "), "headers", F.lit(CRLF),
        F.lit("source-payload-digest: "), "payload_digest", F.lit(CRLF),
        F.lit("source-block-digest: "), "block_digest", F.lit(CRLF),
        F.when(F.col("title") != "", F.concat(F.lit("title: "), "title", F.lit(CRLF))).otherwise(F.lit("")),
        F.array_join(F.transform("links", lambda u: F.concat(F.lit("outlink: "), u, F.lit(CRLF))), ""))
    kinds = F.array(
        F.struct(F.lit("metadata").alias("warc_type"), F.col("metadata_id").alias("record_id"),
                 F.lit("application/warc-fields").alias("content_type"), F.lit("").alias("concurrent_to"),
                 metadata.alias("block")),
        F.struct(F.lit("conversion").alias("warc_type"), F.col("conversion_id").alias("record_id"),
                 F.lit("text/plain; charset=utf-8").alias("content_type"), F.col("metadata_id").alias("concurrent_to"),
                 F.col("text").alias("block")))
    records = fields.select("page_id", "response_id", "date", "target_uri", F.inline(kinds)).select(
        "*", F.octet_length("block").cast("long").alias("content_length"), digest(F.col("block")).alias("block_digest"))

    def line(name: str, column) -> Column:
        return F.concat(F.lit(f"{name}: "), column, F.lit(CRLF))

    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}"), line("WARC-Type", F.col("warc_type")), line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Date", F.col("date")),
        F.when(F.col("target_uri") != "", line("WARC-Target-URI", F.col("target_uri"))).otherwise(F.lit("")),
        line("WARC-Refers-To", F.col("response_id")),
        F.when(F.col("concurrent_to") != "", line("WARC-Concurrent-To", F.col("concurrent_to"))).otherwise(F.lit("")),
        line("WARC-Block-Digest", F.col("block_digest")), line("Content-Type", F.col("content_type")),
        line("Content-Length", F.col("content_length").cast("string")))
    return records.select("page_id", "warc_type", "record_id", F.col("response_id").alias("refers_to"), "target_uri",
                          "content_type", "content_length", "block_digest", header.alias("header"), "block")


def write_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """WARC files: the text writer's line separator ends each record."""
    whole = F.concat("header", F.lit(CRLF), "block", F.lit(CRLF))
    records.select(whole.alias("value")).write.option("lineSep", CRLF).option("compression", compression).text(path)


def summary(records: DataFrame) -> DataFrame:
    return records.select("page_id", "warc_type", "record_id", "refers_to", "target_uri", "content_type",
                          "content_length", "block_digest", F.sha2("header", 256).alias("header_sha256"))


def _quoted(value: str) -> str:
    escaped = value.replace("'", "''")
    return f"'{escaped}'"


def _sql_steps(column: str, steps) -> str:
    for pattern, to in steps:
        column = f"regexp_replace({column}, {_quoted(pattern)}, {_quoted(to)}, 'g')"
    return column


def _sql_entities(column: str) -> str:
    for name, to in ENTITIES.items():
        column = f"replace({column}, {_quoted(name)}, {_quoted(to)})"
    return column


def oracle(date: str = DATE) -> str:
    """The same records in DuckDB; patterns and fixed values are shared."""
    nl = "chr(13) || chr(10)"

    def sql_line(column: str) -> str:
        return f"trim(regexp_replace({column}, '[ \\t\\r\\n\\f]+', ' ', 'g'))"

    def sql_urn(kind: str, *key: str) -> str:
        h = "md5(concat_ws('|', " + ", ".join([_quoted(kind), *key]) + "))"
        return (f"('<urn:uuid:' || {h}[1:8] || '-' || {h}[9:12] || '-3' || {h}[14:16] || '-a' || {h}[18:20] || '-' || "
                f"{h}[21:32] || '>')")

    return f"""
with page as (
  select page_id, coalesce(url, '') url, coalesce(html, '') html,
         {sql_urn('response', "coalesce(cast(page_id as varchar), '')", "coalesce(url, '')")} response_id,
         'HTTP/1.1 200 OK' || {nl} || 'Content-Type: text/html; charset=utf-8' || {nl} || 'Content-Length: '
           || strlen(coalesce(html, '')) http from pages),
parts as (
  select page_id, response_id, {sql_line('url')} uri, {sql_urn('metadata', 'response_id')} metadata_id,
         {sql_urn('conversion', 'response_id')} conversion_id,
         trim({_sql_steps(_sql_entities(_sql_steps('html', TEXT_STEPS)), SPACE_STEPS)}, ' ' || chr(10)) body,
         {sql_line(_sql_entities(f"regexp_extract(html, {_quoted(TITLE)}, 1)"))} title,
         list_transform(regexp_extract_all(html, {_quoted(LINK)}, 1), lambda u: {sql_line('u')}) links,
         replace(http, {nl}, {nl} || 'source-header: ') headers, 'sha256:' || sha256(html) payload_digest,
         'sha256:' || sha256(http || {nl} || {nl} || html) source_digest from page),
records as (
  select page_id, response_id, uri, 'metadata' warc_type, metadata_id record_id, 'application/warc-fields' content_type,
         '' concurrent, 'source-header: ' || headers || {nl} || 'source-payload-digest: ' || payload_digest || {nl}
         || 'source-block-digest: ' || source_digest || {nl}
         || case when title <> '' then 'title: ' || title || {nl} else '' end
         || coalesce(array_to_string(list_transform(links, lambda u: 'outlink: ' || u || {nl}), ''), '') block
  from parts union all
  select page_id, response_id, uri, 'conversion', conversion_id, 'text/plain; charset=utf-8', metadata_id, body from parts)
select page_id, warc_type, record_id, response_id refers_to, uri target_uri, content_type,
       strlen(block)::bigint content_length, 'sha256:' || sha256(block) block_digest,
       sha256('WARC/1.1' || {nl} || 'WARC-Type: ' || warc_type || {nl} || 'WARC-Record-ID: ' || record_id || {nl}
         || 'WARC-Date: {date}' || {nl} || case when uri <> '' then 'WARC-Target-URI: ' || uri || {nl} else '' end
         || 'WARC-Refers-To: ' || response_id || {nl}
         || case when concurrent <> '' then 'WARC-Concurrent-To: ' || concurrent || {nl} else '' end
         || 'WARC-Block-Digest: sha256:' || sha256(block) || {nl} || 'Content-Type: ' || content_type || {nl}
         || 'Content-Length: ' || strlen(block) || {nl}) header_sha256
from records
"""
