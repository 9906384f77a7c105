"""Sources: payloads and pages that Spark builds from the given tables, read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftline.catalog import twins as X
from siftline.catalog.fixtures import AS_OF
from siftline.catalog.registry import query
from siftline.session import stage, stage_path
from siftline.sources import html_postings as H
from siftline.sources import json_postings as J
from siftline.sources.common import document_seq, numbered, recent, union_sources
from siftline.sources.file_sink import write_files
from siftline.operators.dedup import cap_per_source

_JSON_ITEM = """to_json(named_struct('id', seq, 'url', url,
  'position', named_struct('title', title, 'location', named_struct('name', location),
      'experience-level', named_struct('min', seq % 9, 'name', experience_required)),
  'company', named_struct('detail', named_struct('name', company)),
  'salary', named_struct('name', salary_info),
  'posting-timestamp', CAST(1700000000 + seq * 3600 AS STRING),
  'expiration-timestamp', posted_date))"""


def nested_payloads(t):
    """One payload per posting: an object, a list with noise, or broken text."""
    return t.postings.withColumn("item", F.expr(_JSON_ITEM)).selectExpr(
        "seq AS payload_id",
        """CASE WHEN seq % 10 = 4 THEN substring(item, 1, length(item) - 2)
           WHEN seq % 3 = 0 THEN '{"jobs": {"job": ' || item || '}}'
           ELSE '{"jobs": {"job": [' || item || ', {"id": ""}, ' || item || ']}}' END AS payload""",
    )


def packed(rows):
    """``seq`` of one source as a number, for documents and places as small as these."""
    return rows.withColumn("seq", F.col("seq.document") * 1048576 + F.col("seq.position"))


@query(
    "nested_json_source",
    """SELECT seq * 1048576 AS seq, source_id, url, title, company, location, experience_required,
       salary_info, strftime(TIMESTAMP '1970-01-01' + INTERVAL 1 SECOND * (1700000000 + seq * 3600),
       '%Y-%m-%dT%H:%M:%S') AS posted_date, posted_date AS deadline
       FROM @postings WHERE seq % 10 <> 4 AND seq % 9 <= 5""",
)
def nested_json_source(t):
    rows = J.nested_json_postings(nested_payloads(t), AS_OF)
    return packed(rows).drop("source", "jd_text", "scraped_at")


@query(
    "payload_files",
    """SELECT source_id, url, title, company, location, experience_required, salary_info
       FROM @postings WHERE seq % 10 <> 4 AND seq % 9 <= 5""",
)
def payload_files(t):
    """The payloads written to a file each, and read back."""
    path = stage_path(t.spark, "payloads")
    content = F.concat("payload", F.lit(" ")).cast("binary").alias("content")
    write_files(nested_payloads(t).select(F.lit("payload").alias("name"), content), path)
    rows = J.nested_json_postings(J.read_payloads(t.spark, path), AS_OF)
    return rows.select(
        "source_id", "url", "title", "company", "location", "experience_required", "salary_info"
    )


@query(
    "payload_file_reports",
    """SELECT file_id, CASE file_id % 7 WHEN 0 THEN 'not UTF-8' WHEN 1 THEN 'empty' WHEN 2 THEN 'truncated' END AS reason,
       CASE WHEN file_id % 7 > 2 THEN postings ELSE 0 END AS postings
       FROM (SELECT seq // 20 AS file_id, count(*) AS postings FROM @postings GROUP BY 1) f""",
)
def payload_file_reports(t):
    """Files of twenty postings each, some of them wrongly encoded, blank or cut short, read without failing."""
    root = stage_path(t.spark, "payload_files")
    items = F.concat(F.lit('{"jobs": {"job": ['), F.array_join(F.collect_list("item"), ", "), F.lit("]}}"))
    files = t.postings.withColumn("item", F.expr(_JSON_ITEM)).groupBy(F.expr("seq div 20").alias("file_id")).agg(items.alias("payload"))
    kind = F.col("file_id") % 7
    # Bytes that are no UTF-8, a blank, and the first bytes of a compressed file with nothing after them.
    content = (
        F.when(kind == 0, F.encode(F.concat("payload", F.lit("\n")), "UTF-16")).when(kind == 1, F.lit(b"  ")).when(kind == 2, F.lit(b"\x1f\x8b\x08\x08\n"))
        .otherwise(F.concat("payload", F.lit(" ")).cast("binary"))
    )
    name = F.concat(F.lit("file_id="), F.col("file_id").cast("string"))
    write_files(files.where(kind >= 0).select(name.alias("name"), content.alias("content")), root)
    found = J.payload_files(t.spark, root)
    file_id = F.regexp_extract("path", r"file_id=(\d+)", 1).cast("long")
    jobs = F.size(F.try_variant_get(F.try_parse_json("payload"), "$.jobs.job", "array<variant>"))
    return found.select(file_id.alias("file_id"), "reason", F.coalesce(F.when(F.col("payload").isNotNull(), jobs), F.lit(0)).cast("long").alias("postings"))


@query(
    "page_reader",
    r"""SELECT page_id, len(regexp_extract_all(html, '<li>')) AS items, len(regexp_extract_all(html, '<p>')) AS paragraphs
        FROM pages""",
)
def page_reader(t):
    """A user's own reader over Arrow batches of pages."""

    def count(batches):
        for b in batches:
            yield b[["page_id"]].assign(items=b["html"].str.count("<li>"), paragraphs=b["html"].str.count("<p>"))

    return H.extract_with(t.read("pages"), count, "page_id long, items long, paragraphs long")


@query("rejected_payloads", "SELECT seq AS payload_id FROM @postings WHERE seq % 10 = 4")
def rejected_payloads(t):
    return J.rejected_payloads(nested_payloads(t)).select("payload_id")


_POLY = """CASE event_id % 4
  WHEN 0 THEN '{"data": [{"id": ' || CAST(event_id AS STRING) || ', "company": {"name": "u' || CAST(user_id AS STRING) || '"}, "position": "' || event_type || '"}]}'
  WHEN 1 THEN '[{"id": ' || CAST(event_id AS STRING) || ', "company": "u' || CAST(user_id AS STRING) || '", "title": "' || event_type || '", "address": "none"}]'
  WHEN 2 THEN '{"data": [{"title": "no id"}, ' || props || ']}'
  ELSE '{"data": [{"id": "e' || CAST(event_id AS STRING) || '", "position": "' || event_type || '", "title": "x", "address": {"full_location": "L' || CAST(user_id AS STRING) || '"}}, {"id": "e' || CAST(event_id AS STRING) || '"}]}' END"""


@query(
    "polymorphic_json_source",
    """SELECT event_id * 1048576 AS seq,
       CASE WHEN event_id % 4 = 3 THEN 'e' ELSE '' END || CAST(event_id AS STRING) AS source_id,
       'https://www.wanted.co.kr/wd/' || CASE WHEN event_id % 4 = 3 THEN 'e' ELSE '' END
           || CAST(event_id AS STRING) AS url,
       event_type AS title,
       CASE WHEN event_id % 4 = 3 THEN '' ELSE 'u' || CAST(user_id AS STRING) END AS company,
       CASE WHEN event_id % 4 = 3 THEN 'L' || CAST(user_id AS STRING) ELSE '' END AS location
       FROM events WHERE event_id % 4 <> 2""",
)
def polymorphic_json_source(t):
    payloads = t.events.selectExpr("event_id AS payload_id", f"{_POLY} AS payload")
    return packed(J.polymorphic_json_postings(payloads, AS_OF)).select(
        "seq", "source_id", "url", "title", "company", "location"
    )


@query(
    "embedded_json_source",
    """SELECT conv_id * 1048576 + row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS seq,
       CAST(conv_id * 100 + turn AS STRING) AS source_id, text AS title, role AS company
       FROM conversations""",
)
def embedded_json_source(t):
    jobs = F.array_sort(
        F.collect_list(
            F.struct(
                "turn",
                (F.col("conv_id") * 100 + F.col("turn")).alias("id"),
                F.col("text").alias("position"),
                F.struct(F.col("role").alias("name")).alias("company"),
            )
        )
    )
    # A conversation is a few turns long; one page holds one conversation.
    pages = (
        t.read("conversations")
        .groupBy("conv_id")
        .agg(F.to_json(jobs).alias("jobs"))
        .select(
            F.col("conv_id").alias("page_id"),
            F.concat(
                F.lit("<html><script>var a = {};</script><script>window.__NEXT_DATA__ = "),
                F.lit('{"props": {"pageProps": {"jobs": '),
                "jobs",
                F.lit("}}};</script></html>"),
            ).alias("html"),
        )
    )
    return packed(J.embedded_json_postings(pages, AS_OF)).select("seq", "source_id", "title", "company")


_STRIP = "regexp_replace({c}, '^{w}|{w}$', '', 'g')"


def _stripped(column: str) -> str:
    return _STRIP.format(c=column, w=X.SPACE)


def _escaped(column: str) -> str:
    return f"replace(replace(replace({column}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


_HREF = "CASE WHEN seq % 6 = 0 THEN 'http://x.example.org/' ELSE '/view?job=' END || CAST(seq AS STRING)"
_LIST_CARD = f"""'<li class="x c_col y"><a class="cpname">no company</a><div class="cell_first"><div></div><a class="cpname" href="#">' || {_escaped('company')}
  || '</a></div><div class="cell_mid"><a href="' || {_HREF} || '"> <b>' || {_escaped('title')}
  || '</b> </a><span class="cl_md">서울</span><span class="cl_md"> ' || experience_required
  || '</span></div><div class="cell_last"><div>&middot;</div><span>' || posted_date || '</span></div></li>'"""


def list_pages(t):
    """Twenty postings to a page, in the layout of a list source."""
    cards = F.array_sort(F.collect_list(F.struct("seq", "card")))["card"]
    return (
        t.postings.withColumn("card", F.expr(_LIST_CARD))
        .groupBy(F.expr("seq div 20").alias("page_id"))
        .agg(F.array_join(cards, "\n").alias("cards"))
        .select(
            "page_id",
            F.concat(
                F.lit('<html><ul><li class="c_col"><a href="/nav">menu</a></li></ul>'),
                F.lit('<div class="cBbslist_contenst"><ul>'),
                "cards",
                # Strays after the list: an item, and a company and a date without an item.
                F.lit('</ul></div><div class="side"><ul><li class="c_col"><div class="cell_mid">'),
                F.lit('<a href="/view?job=999999999">aside</a></div></li></ul></div></html>'),
            ).alias("html"),
        )
    )


@query(
    "html_list_source",
    f"""SELECT (seq // 20) * 1048576 + seq % 20 + 1 AS seq,
        CASE WHEN seq % 6 = 0 THEN {_HREF} ELSE CAST(seq AS STRING) END AS source_id,
        CASE WHEN seq % 6 = 0 THEN {_HREF} ELSE 'https://job.incruit.com' || {_HREF} END AS url,
        {_stripped('title')} AS title, {_stripped('company')} AS company,
        CASE WHEN contains(experience_required, '경력') OR contains(experience_required, '신입')
             THEN experience_required ELSE '' END AS experience_required, '·' || posted_date AS posted_date
        FROM @postings""",
)
def html_list_source(t):
    return packed(H.html_list_postings(list_pages(t), AS_OF)).select(
        "seq", "source_id", "url", "title", "company", "experience_required", "posted_date"
    )


_PLAIN_LIST = H.ListLayout(host="https://pages.example.org", item=r"<li\b[^>]*>")


@query(
    "html_list_pages",
    r"""SELECT source_id, 'https://pages.example.org' || source_id AS url, title
        FROM (SELECT href AS source_id, replace(label, '&amp;', '&') AS title,
                     row_number() OVER (PARTITION BY href ORDER BY page_id, n) AS nth
              FROM (SELECT page_id,
                      unnest(regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 1)) AS href,
                      unnest(regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 2)) AS label,
                      unnest(range(len(regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>')))) AS n
                    FROM pages) x) y
        WHERE nth = 1""",
)
def html_list_pages(t):
    return H.html_list_postings(t.read("pages"), AS_OF, layout=_PLAIN_LIST).select(
        "source_id", "url", "title"
    )


_REGION = "CASE WHEN seq % 3 = 0 THEN '서울 강남' WHEN seq % 3 = 1 THEN '경기' ELSE '' END"
_CARD = f"""'<div class="list shadow-list-item b"><a href="/GI_Read/logo">x</a><a href="/Recruit/GI_Read/'
  || CAST(seq AS STRING) || '?c=1"><strong> ' || {_escaped('title')} || ' </strong></a><a href="/Recruit/GI_Read/'
  || CAST(seq AS STRING) || '">' || {_escaped('company')} || '</a><a href="/other">a longer text</a><div><span>&#xB300;&#44592;</span></div><span>'
  || experience_required || '</span><span>' || {_REGION} || '</span></div>'"""


def card_pages(t):
    cards = F.array_sort(F.collect_list(F.struct("seq", "card")))["card"]
    return (
        t.postings.withColumn("card", F.expr(_CARD))
        .groupBy(F.expr("seq div 20").alias("page_id"))
        .agg(F.concat(F.lit("<html><body>"), F.array_join(cards, "\n"),
                      # A footer after the last card is part of none.
                      F.lit('<div><a href="/GI_Read/1">Other company</a><span>서울 경력</span></div></body></html>')).alias("html"))
    )


_T, _C = _stripped("title"), _stripped("company")


@query(
    "html_card_source",
    f"""SELECT (seq // 20) * 1048576 + seq % 20 + 1 AS seq, CAST(seq AS STRING) AS source_id,
        'https://www.jobkorea.co.kr/Recruit/GI_Read/' || CAST(seq AS STRING) || '?c=1' AS url,
        CASE WHEN length({_T}) > 5 THEN {_T} ELSE {_C} END AS title,
        CASE WHEN length({_T}) > 5 AND length({_C}) > 1 THEN {_C} ELSE '' END AS company,
        {_REGION} AS location,
        CASE WHEN contains(experience_required, '경력') OR contains(experience_required, '신입')
             THEN experience_required ELSE '' END AS experience_required
        FROM @postings WHERE length({_T}) > 5 OR length({_C}) > 5""",
)
def html_card_source(t):
    return packed(H.html_card_postings(card_pages(t), AS_OF)).select(
        "seq", "source_id", "url", "title", "company", "location", "experience_required"
    )


def _four_sources(t):
    """The text tables as the four sources, each with its own numbering."""
    turns = t.read("conversations")
    return {
        "wanted": t.read("pages").selectExpr(
            "page_id AS seq", "'wanted' AS source", "CAST(page_id AS STRING) AS source_id", "url"
        ),
        "saramin": t.documents.selectExpr(
            "doc_id AS seq", "'saramin' AS source", "CAST(doc_id AS STRING) AS source_id"
        ),
        "incruit": turns.select(
            document_seq(F.col("conv_id"), F.col("turn")).alias("seq"),
            F.lit("incruit").alias("source"),
            F.concat_ws("-", "conv_id", "turn").alias("source_id"),
        ),
        "jobkorea": t.events.selectExpr(
            "event_id AS seq", "'jobkorea' AS source", "CAST(event_id AS STRING) AS source_id"
        ),
    }


_UNION = """
SELECT doc_id AS seq, 'saramin' AS source, CAST(doc_id AS STRING) AS source_id, NULL AS url FROM documents
UNION ALL SELECT 18014398509481984 + conv_id * 1048576 + turn, 'incruit',
    CAST(conv_id AS STRING) || '-' || CAST(turn AS STRING), NULL FROM conversations
UNION ALL SELECT 36028797018963968 + event_id, 'jobkorea', CAST(event_id AS STRING), NULL FROM events
UNION ALL SELECT 54043195528445952 + page_id, 'wanted', CAST(page_id AS STRING), url FROM pages"""


@query(
    "source_union", f"SELECT *, source || ':' || source_id AS dedup_key FROM ({_UNION}) u"
)
def source_union(t):
    return _ranked(union_sources(_four_sources(t))).select("seq", "source", "source_id", "url", "dedup_key")


def _ranked(batch):
    """``seq`` as a number, for ranks, documents and places as small as these."""
    own = F.when(F.col("source") == "incruit", F.col("seq.document") * 1048576 + F.col("seq.position"))
    return batch.withColumn("seq", F.col("seq.rank") * (1 << 54) + F.coalesce(own, F.col("seq.document")))


@query(
    "numbered_union",
    f"""SELECT row_number() OVER (ORDER BY seq) - 1 AS seq, source, source_id FROM ({_UNION}) u""",
)
def numbered_union(t):
    """The batch of all sources with whole numbers from 0 in order of arrival."""
    return numbered(stage(union_sources(_four_sources(t)), "union")).select("seq", "source", "source_id")


@query(
    "source_union_capped",
    f"""SELECT source, source_id, seq FROM (SELECT *, row_number() OVER (PARTITION BY source
        ORDER BY seq) AS n FROM ({_UNION}) u) v WHERE n <= 50""",
)
def source_union_capped(t):
    return _ranked(cap_per_source(union_sources(_four_sources(t)), 50)).select("source", "source_id", "seq")


@query(
    "recent_events",
    "SELECT event_id, user_id FROM events WHERE ts >= DATE '2024-01-21'",
)
def recent_events(t):
    return recent(t.events, AS_OF, days=10, column="ts").select("event_id", "user_id")
