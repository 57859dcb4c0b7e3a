"""The operators' queries with production parameters, and their SQL where it can say the same."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from . import chat, exact_dedup, html_extract, langid, line_dedup, pieces, simhash, toxicity, warc, winnow
from .common import spread, table

#: Where the model file is; a parameter of the engine, not part of it.
PIECE_MODEL = os.environ.get("ALMAGEST_PIECE_MODEL", "piece_bpe_32k.model")


def piece_model() -> str:
    """Path of the model file: as set, or where the installed package of public tokenizers has it."""
    if os.path.sep in PIECE_MODEL:
        return PIECE_MODEL
    import public_tokenizers

    return str(public_tokenizers.path(PIECE_MODEL))


def op1_chat_format(spark, sf_dir):
    """Maximal conversations of ``conversations``, rendered; see ``chat.format_chats``."""
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op2_sentencepiece(spark, sf_dir):
    """Ids and decoded text of every document, as digests; see ``pieces.encode_texts``."""
    return pieces.encode_texts(spread(table(spark, sf_dir, "documents")), piece_model())


def op3_toxicity(spark, sf_dir):
    """A toxicity score for every document; see ``toxicity.toxicity``."""
    return toxicity.toxicity(spread(table(spark, sf_dir, "documents")), table(spark, sf_dir, "labels"))


def op4_decontamination(spark, sf_dir):
    """Benchmark passages in every document; see ``winnow.decontaminate``."""
    return winnow.decontaminate(spread(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


def op5_simhash(spark, sf_dir):
    """Fingerprint and near-duplicate group of every document; see ``simhash.near_duplicates``."""
    return simhash.near_duplicates(spread(table(spark, sf_dir, "documents")))


def op6_language_id(spark, sf_dir):
    """Language of every document; see ``langid.identify``."""
    return langid.identify(spread(table(spark, sf_dir, "documents")))


def op7_line_dedup(spark, sf_dir):
    """Lines and dropped lines of every document; see ``line_dedup.line_report``."""
    return line_dedup.line_report(spread(table(spark, sf_dir, "documents")))


def op8_warc_revisits(spark, sf_dir):
    """Every revisit of a log made of ``pages``, resolved; see ``warc.page_captures`` and ``warc.resolve_revisits``."""
    out = warc.resolve_revisits(warc.page_captures(spread(table(spark, sf_dir, "pages"))))
    header = lambda n: F.element_at("headers", n)
    return out.select("record_id", "canonical_url", "state", "source_id", header("etag").alias("etag"), header("content-type").alias("content_type"), header("date").alias("header_date"), F.sha2("payload", 256).alias("payload_sha256"))


def op9_html_extraction(spark, sf_dir):
    """Main text of every page; see ``html_extract.extract``."""
    return html_extract.extract(spread(table(spark, sf_dir, "pages")))


def op10_exact_dedup(spark, sf_dir):
    """Exact-duplicate group of every document; see ``exact_dedup.exact_duplicates``."""
    return exact_dedup.exact_duplicates(spread(table(spark, sf_dir, "documents")))


QUERIES = {f.__name__: f for f in (op1_chat_format, op2_sentencepiece, op3_toxicity, op4_decontamination, op5_simhash, op6_language_id, op7_line_dedup, op8_warc_revisits, op9_html_extraction, op10_exact_dedup)}

_CHAT_SQL = """
with rows as (select distinct conv_id, turn, role, text from conversations where conv_id is not null),
t as (select *, row_number() over w as n, lead(turn) over w is null as last,
  list({'r': role, 't': text}) over (partition by conv_id order by turn nulls first, role nulls first, text nulls first rows unbounded preceding) as path
  from rows window w as (partition by conv_id order by turn nulls first, role nulls first, text nulls first)),
ends as (select path, min(conv_id) as conv_id, max(n) as n_turns, count(*) as n_copies from t where last group by path),
stay as (select * from ends where path not in (select path from t where not last))
select conv_id, cast(n_turns as bigint) as n_turns, n_copies,
  array_to_string(list_transform(path, lambda x: '<|' || coalesce(x.r, '') || '|>' || chr(10) || coalesce(x.t, '') || chr(10) || '<|end|>' || chr(10)), '') as rendered
from stay"""

_WORDS_SQL = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_DECONTAMINATION_SQL = f"""
with d as (select row_number() over () as rid, doc_id, {_WORDS_SQL} as w from documents),
i as (select cast(item_id as varchar) as item_id, {_WORDS_SQL} as w from benchmark),
iw as (select distinct item_id, least(len(w), 13) as k, unnest(list_transform(range(1, len(w) - least(len(w), 13) + 2), lambda p: array_to_string(w[p:p + least(len(w), 13) - 1], ' '))) as g from i where len(w) > 0),
ks as (select distinct k from iw),
dw as (select rid, k, unnest(range(1, len(w) - k + 2)) as p, unnest(list_transform(range(1, len(w) - k + 2), lambda p: array_to_string(w[p:p + k - 1], ' '))) as g from d, ks where len(w) >= k),
h as (select dw.rid, dw.p, dw.k, iw.item_id from dw join iw on dw.g = iw.g and dw.k = iw.k),
n as (select rid, count(distinct q) as n_hit from (select rid, unnest(range(p, p + k)) as q from (select distinct rid, p, k from h)) group by rid),
s as (select rid, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids from (select distinct rid, item_id from h) group by rid)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join n using (rid) left join s using (rid)"""

_LINE_SQL = f"""
with d as (select row_number() over () as rid, doc_id, source, text from documents),
l as (select rid, doc_id, source, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as pos from d),
tot as (select source, count(*) as total from d group by source),
bad as (select l.source, trim(line) as t from l join tot on l.source is not distinct from tot.source where trim(line) <> ''
  group by l.source, trim(line), total having count(distinct rid) >= {line_dedup.HELD_BY} and count(distinct rid) > total * {line_dedup.RATIO}),
m as (select l.rid, l.pos, l.line, bad.t is not null as cut from l left join bad on l.source is not distinct from bad.source and trim(l.line) = bad.t),
g as (select rid, count(*) as n_lines, count(*) filter (where cut) as n_dropped, string_agg(line, chr(10) order by pos) filter (where not cut) as kept from m group by rid)
select doc_id, coalesce(n_lines, 0) as n_lines, coalesce(n_dropped, 0) as n_dropped, sha256(coalesce(kept, '')) as text_sha256
from d left join g using (rid)"""

_WARC_SQL = r"""
with u as (select page_id, coalesce(html, '') as html, regexp_replace(trim(url), '#.*$', '') as bare from pages),
v as (select page_id, html, '"' || md5(html) || '"' as tag,
  regexp_replace(regexp_replace(lower(regexp_extract(bare, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?]*)', 1)), '^(http://.*):80$', '\1'), '^(https://.*):443$', '\1') as head,
  regexp_replace(bare, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*', '') as rest from u),
c as (select page_id, html, tag, head || case when regexp_replace(rest, '\?.*$', '') = '' then '/' else regexp_replace(rest, '\?.*$', '') end ||
  coalesce('?' || nullif(array_to_string(list_sort(list_filter(string_split(regexp_extract(rest, '\?(.*)$', 1), '&'), lambda x: x <> '' and not regexp_matches(x, '^(utm_[a-z]+|ref|fbclid|gclid|sessionid)(=|$)'))), '&'), ''), '') as url from v),
a as (select distinct 'a' || page_id as record_id, url, page_id * 60 as t, tag, html from c where page_id is not null and url is not null),
r as (select 'b' || page_id as record_id, url, page_id * 60 + 21600 as t, case when page_id % 5 = 0 then '"stale"' else tag end as tag, 'd1' as d from c
  union all select 'c' || page_id, url, page_id * 60 - 3600, tag, 'd2' from c where page_id % 3 = 0),
m as (select r.*, (select max({'t': a.t, 'id': a.record_id, 'tag': a.tag}) from a where a.url = r.url and a.t < r.t) as src from r),
s as (select m.*, a.html, src['id'] as source_id, case when src is null then 'NO_EARLIER_RESPONSE' when a.tag = m.tag then 'RESOLVED' else 'VALIDATOR_MISMATCH' end as state from m left join a on a.record_id = m.src['id'] and a.tag = m.src['tag'] and a.t = m.src['t'] and a.url = m.url)
select record_id, url as canonical_url, state, source_id, tag as etag, case when state = 'RESOLVED' then 'text/html' else 'text/none' end as content_type,
  d as header_date, case when state = 'RESOLVED' then sha256(html) end as payload_sha256 from s"""

_EXACT_SQL = r"""
with d as (select row_number() over () as rid, doc_id, coalesce(text, '') as text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as t from documents),
k as (select *, first_value(doc_id) over w as keep_id, row_number() over w = 1 as kept, count(*) over (partition by t) as group_size from d
  window w as (partition by t order by length(text) desc, doc_id nulls last, rid))
select doc_id, keep_id, group_size, kept, sha256(t) as text_sha256 from k"""

ORACLE_SQL = {"op1_chat_format": _CHAT_SQL, "op4_decontamination": _DECONTAMINATION_SQL, "op7_line_dedup": _LINE_SQL, "op8_warc_revisits": _WARC_SQL, "op10_exact_dedup": _EXACT_SQL}
