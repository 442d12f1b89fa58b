"""The queries of these operators over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm import bpe, cosine, iblt, line_dedup, merkle, mixing, quality, revisits, simhash, suffix_array, token_store, whitening, window_dedup
from marketlake.llm.common import table
from marketlake.session import stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = quality.measure(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "__m")
    judged = quality.judge(stage(measured, "measures"))
    m = [F.col(f"__m.{c}") for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return judged.select("doc_id", *m, F.col("__failed").alias("base_failed"), F.col("__kept").alias("kept"), F.col("__post").alias("p_good"))


@_query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.drop_boilerplate(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return out.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"), F.sha2("text", 256).alias("text_sha256"))


ORACLES["op2_line_dedup"] = f"""
with doc as (select doc_id, source, text from documents),
line as (select doc_id, source, unnest(list_distinct(string_split(text, chr(10)))) line from doc),
page as (select source, count(*) pages from doc group by source),
bad as (
  select l.source, l.line from line l join page p on p.source is not distinct from l.source
  where regexp_matches(l.line, '[^ \\t\\n\\x0B\\f\\r]') group by l.source, l.line, p.pages
  having count(*) >= {line_dedup.LEAST_PAGES} and 100 * count(*) > {line_dedup.RATIO_PERCENT} * p.pages),
bads as (select source, list(line) bad from bad group by source),
cut as (
  select d.doc_id, d.text, string_split(d.text, chr(10)) lines,
    list_filter(string_split(d.text, chr(10)), lambda x: not list_contains(coalesce(b.bad, []), x)) stay
  from doc d left join bads b on b.source is not distinct from d.source)
select doc_id, coalesce(len(lines), 0)::bigint n_lines, coalesce(len(lines) - len(stay), 0)::bigint n_dropped,
  sha256(case when text is not null then array_to_string(stay, chr(10)) end) text_sha256
from cut
"""


@_query
def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    back = bpe.encode(docs, ranks, public_tokenizers.PATTERN, decoded="decoded")
    return back.select("doc_id", bpe.n_tokens().alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@_query
def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_array.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@_query
def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = token_store.read_model(public_tokenizers.path("byte_bpe_50k.json"))
    return token_store.write_and_read(table(spark, sf_dir, "documents"), model)


@_query
def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iblt.fingerprints(table(spark, sf_dir, "documents"))


def web_records(pages: DataFrame) -> DataFrame:
    """Archive records derived from ``pages``: a full response per page, and two later not-modified revisits.

    The first revisit asks with the page's own ETag, or with one that no response had (each seventh page); the second,
    hours later, with Last-Modified only, or with nothing (each fifth). Times spread over a year by page.
    """
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.pmod(F.col("page_id") * 7919, F.lit(31_536_000)))
    day = F.date_format(at, "yyyy-MM-dd")
    body = F.sha2("html", 256)
    etag = F.substring(body, 1, 16)
    size = F.octet_length("html").cast("string")
    text = lambda c: F.coalesce(c, F.lit(""))
    full = F.create_map(F.lit("ETag"), text(etag), F.lit("Last-Modified"), day, F.lit("Content-Length"), text(size), F.lit("Cache-Control"), F.lit("max-age=60"))
    asked = F.when(F.col("page_id") % 7 == 0, F.lit("gone")).otherwise(text(etag))
    first = F.create_map(F.lit("etag"), asked, F.lit("Cache-Control"), F.lit("max-age=600"), F.lit("content-length"), F.lit("0"))
    second = F.when(F.col("page_id") % 5 == 0, F.create_map(F.lit("Age"), F.lit("7"))).otherwise(F.create_map(F.lit("last-modified"), day))
    none = F.lit(None).cast("string")
    record = lambda k, kind, time, headers, payload: F.struct(
        (F.col("page_id") * 3 + k).alias("record_id"), F.lit(kind).alias("kind"), time.alias("time"), headers.alias("headers"), payload.alias("payload")
    )
    rows = F.array(
        record(0, "response", at, full, body),
        record(1, "revisit", at + F.expr("interval 1 hour"), first, none),
        record(2, "revisit", at + F.expr("interval 9 hours"), second, none),
    )
    return pages.select("url", F.explode(rows).alias("r")).select("r.record_id", "r.kind", "url", "r.time", "r.headers", "r.payload")


@_query
def op7_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = stage(web_records(table(spark, sf_dir, "pages")), "records")  # bodies stay behind, their digest goes on
    out = revisits.resolve(records)
    head = lambda name: revisits.header(F.col("headers"), name)
    return out.select(
        "record_id", "url", "status", "response_id", "checked", "payload", head("etag").alias("etag"), head("last-modified").alias("last_modified"),
        head("cache-control").alias("cache_control"), head("content-length").alias("content_length"), head("age").alias("age"),
    )


ORACLES["op7_warc_revisits"] = r"""
with c1 as (select page_id, html, regexp_replace(regexp_replace(url, '#.*$', ''), '([?&])utm_[^=&]*=[^&]*', '\1', 'g') u from pages),
c2 as (select page_id, html, regexp_replace(regexp_replace(regexp_replace(u, '[?&]+$', ''), '\?&+', '?', 'g'), '&&+', '&', 'g') u from c1),
c3 as (select page_id, html, lower(regexp_extract(u, '^([^/]*//[^/?]*)', 1)) top, regexp_replace(u, '^[^/]*//[^/?]*', '') rest from c2),
c4 as (select page_id, html, regexp_replace(regexp_replace(top, '^(http://.*):80$', '\1'), '^(https://.*):443$', '\1') top, rest from c3),
page as (select page_id, regexp_replace(regexp_replace(top, '^https?://(www\.)?', '') || rest, '/+$', '') url,
    1700000000 + (page_id * 7919) % 31536000 as sec, sha256(html) body, octet_length(encode(html))::varchar size from c4),
day as (select *, strftime(make_timestamp(sec * 1000000), '%Y-%m-%d') d, left(body, 16) tag from page),
response as (select page_id * 3 record_id, url, sec, body, size, tag, d from day),
revisit as (
  select page_id * 3 + 1 record_id, url, sec + 3600 as sec, case when page_id % 7 = 0 then 'gone' else tag end tag, null d, 'max-age=600' cc, '0' len, null age from day
  union all select page_id * 3 + 2, url, sec + 32400, null, case when page_id % 5 = 0 then null else d end, null, null, case when page_id % 5 = 0 then '7' end from day),
ranked as (
  select v.*, r.record_id response_id, r.tag r_tag, r.d r_d, r.body, r.size,
    row_number() over (partition by v.record_id order by r.sec desc nulls last, r.record_id desc) k
  from revisit v left join response r on r.url = v.url and r.sec < v.sec),
judged as (
  select *, case when response_id is null then null when tag is not null then case when tag = r_tag then 'etag' else 'mismatch' end
    when d is not null then case when d = r_d then 'last_modified' else 'mismatch' end else 'none' end checked
  from ranked where k = 1),
stated as (select *, case when response_id is null then 'missing' when checked = 'mismatch' then 'mismatch' else 'resolved' end status from judged)
select record_id, url, status, response_id, checked, case when status = 'resolved' then body end payload,
  case when status = 'resolved' then coalesce(tag, r_tag) else tag end etag,
  case when status = 'resolved' then coalesce(d, r_d) else d end last_modified,
  case when status = 'resolved' then coalesce(cc, 'max-age=60') else cc end cache_control,
  case when status = 'resolved' then size else len end content_length, age
from stated
"""


@_query
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = window_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@_query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text"))
    names = {"__topic": "topic", "__tokens": "n_tokens", "__probability": "probability", "__sampled": "sampled"}
    return out.select("doc_id", "source", "lang", *[F.col(k).alias(v) for k, v in names.items()])


@_query
def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@_query
def op11_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cosine.near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLES["op11_embedding_near_dedup"] = f"""
with recursive given as (
  select row_number() over () k, vec_id, label, embedding::double[] e, coalesce(label is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)
    and len(list_filter(embedding, lambda x: x <> 0)) > 0, false) ok
  from embeddings),
near as (
  select a.k a, b.k b from given a join given b on a.label = b.label and len(a.e) = len(b.e) and a.k <> b.k
  where a.ok and b.ok and list_cosine_similarity(a.e, b.e) >= {cosine.THRESHOLD}),
reach as (select k a, k b from given union select r.a, n.b from reach r join near n on n.a = r.b),
least as (select r.a k, min(g.vec_id) component_id from reach r join given g on g.k = r.b group by r.a),
links as (select a k, count(*) n from near group by a)
select g.vec_id, coalesce(l.n, 0)::bigint n_links, c.component_id, coalesce(g.vec_id = c.component_id, false) kept
from given g join least c using (k) left join links l using (k)
"""


@_query
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@_query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = merkle.manifest(merkle.leaves(table(spark, sf_dir, "documents")))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def _merkle_sql(levels: int = 5, run: int = merkle.FANOUT) -> str:
    """Trees of up to run ** levels nodes; a tree that is done stays as it is on the levels above."""
    lower = merkle._UPPER.lower()
    field = lambda c: f"coalesce(strlen({c}::varchar)::varchar || ':' || {c}::varchar, '-')"
    leaf = lambda text: "sha256(" + " || ".join(field(c) if c != "text" else field(text) for c in merkle.COLUMNS) + ")"

    def tree(name: str, base: str) -> str:
        parts, at = [], base
        for k in range(levels):
            inside = f"partition by g, place // {run} order by place rows between"
            parts.append(f"""{name}{k} as (select g, place, size, hash,
    coalesce(string_agg(hash, '') over ({inside} unbounded preceding and 1 preceding), '') l,
    coalesce(string_agg(hash, '') over ({inside} 1 following and unbounded following), '') r from {at})""")
            at = f"""(select g, place // {run} place, (max(size) + {run - 1}) // {run} size,
      case when max(size) > 1 then sha256(string_agg(hash, '' order by place)) else max(hash) end hash from {name}{k} group by g, place // {run})"""
        return ", ".join([*parts, f"{name}{levels} as {at}"])

    joins = "\n".join(
        f"join {name}{k} {name}_{k} on {name}_{k}.g {key} and {name}_{k}.place = {place} // {run**k}"
        for name, key, place in (("n", "= x.g", "x.place"), ("s", "= 'all'", "o.place")) for k in range(levels)
    )
    steps = [f"{name}_{k}" for name in ("n", "s") for k in range(levels)]
    proof = " || ".join(f"{t}.l || {t}.r" for t in steps)
    inner = f"""select x.doc_id, x.leaf, x.h, n{levels}.hash subroot, sha256({proof}) proof_sha256,
    {", ".join(f"{t}.l {t}l, {t}.r {t}r, {t}.size {t}z" for t in steps)}
  from x join o on o.g = x.g {joins} join n{levels} on n{levels}.g = x.g"""
    chain = f"w0 as ({inner})"  # each step is a column of its own, so that no expression holds another twice
    for i, t in enumerate(steps):
        chain += f", w{i + 1} as (select * replace (case when {t}z > 1 then sha256({t}l || h || {t}r) else h end as h) from w{i})"
    crc = (
        "xor(list_reduce(list_transform(range(1, length(doc_id::varchar) + 1), lambda i: ascii(substr(doc_id::varchar, i, 1))::bigint), lambda c, b: "
        "list_reduce(range(8), lambda x, i: xor(x >> 1, case when x & 1 = 1 then 3988292384 else 0 end), xor(c, b)), 4294967295), 4294967295)"
    )
    return f"""
with d as (select *, coalesce('1' || source, '0') g, {leaf("text")} leaf from documents),
x as (select doc_id, g, leaf, case when doc_id is not null and {crc} % 5 = 0 then {leaf(f"translate(text, '{merkle._UPPER}', '{lower}')")} else leaf end h,
    row_number() over (partition by g order by doc_id nulls first, leaf) - 1 place, count(*) over (partition by g) size from d),
{tree("n", "(select g, place, size, leaf hash from x)")},
o as (select g, row_number() over (order by g) - 1 place, count(*) over () size, hash from n{levels}),
{tree("s", "(select 'all' g, place, size, hash from o)")},
{chain}
select doc_id, leaf, subroot, (select hash from s{levels}) root, proof_sha256, h folded_root, h = (select hash from s{levels}) verified from w{len(steps)}
"""


ORACLES["op13_merkle_manifest"] = _merkle_sql()


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES["pipeline"] = pipeline
