"""The queries of this subpackage: one thin query per operator, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, divergence, line_dedup, packing, pii, quality, secrets, simhash, token_ids, topk, vector_codes, warc
from . import mixture as mixing
from ._shared import table


def spans_text(found: Column) -> Column:
    """``kind:start:end`` of spans that are in order, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_kind(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.read_archives(warc.convert(table(spark, sf_dir, "pages")))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", *[count_kind(F.col("base"), k).alias(f"n_{k}") for k in pii.KINDS], F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"), spans_text(F.col("found")).alias("spans")
    )


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op4_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_ids.read_tokens(token_ids.write_tokens(table(spark, sf_dir, "documents"), tokenizer_path()))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths, new = secrets.scan_blobs(table(spark, sf_dir, "documents"))
    secrets.append_ledger(new)
    found, text = F.col("found"), spans_text(F.col("found"))
    return paths.select(
        F.col("path").alias("doc_id"), *[count_kind(found, r.kind).alias(f"n_{r.kind}") for r in secrets.BASE.rules], F.sha2(text, 256).alias("base_sha256"), text.alias("spans"), "blob"
    )


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_groups(table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    forest = quality.train(docs, table(spark, sf_dir, "labels"), usable=~held)
    scored = quality.score(docs.select("doc_id", "text"), forest)
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))
    return coded.withColumn("codebooks_sha256", F.lit(vector_codes.codebooks_sha256(books)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_warc, op2_pii, op3_topk, op4_token_ids, op5_secrets, op6_decontaminate, op7_mixture, op8_line_dedup, op9_simhash, op10_quality, op11_divergence, op12_packing, op13_vector_codes)}


OP1_SQL = """
with p as (select page_id, coalesce(html, '') h from pages),
d as (select page_id, strlen(h)::bigint payload_bytes, sha1(h) hx, max(page_id) over (partition by h) keep from p)
select page_id, payload_bytes,
 array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(hx, i * 5 // 4 + 1, 2))::int >> (3 - i * 5 % 4)::int) & 31) + 1, 1)), '') payload_digest,
 case when keep = page_id then 'response' else 'revisit' end record_type, case when keep <> page_id then keep end refers_to from d
"""

OP3_SQL = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) v from embeddings where len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint score from v q join v c on q.vec_id % 20 = 0 and c.vec_id <> q.vec_id),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s)
select query_id, rank, vec_id, score from r where rank <= 20
"""

_RULES = ", ".join(f"('{r.kind}', {n}, {r.least}, {r.group}, '{r.pattern.replace(chr(39), chr(39) * 2)}')" for n, r in enumerate(secrets.BASE.rules))
OP5_SQL = f"""
with d as (select doc_id, coalesce(text, '') t from documents), rules(kind, ord, least, grp, pat) as (values {_RULES}),
m as (select doc_id, kind, ord, least, grp, pat, regexp_extract_all(t, pat) ms, regexp_split_to_array(t, pat) gs from d, rules),
x as (select *, unnest(range(1, len(ms) + 1)) i from m),
y as (select doc_id, kind, ord, ms[i] s, list_sum(list_transform(gs[1:i], lambda g: length(g)))::bigint + coalesce(list_sum(list_transform(ms[1:i - 1], lambda g: length(g))), 0)::bigint st
 from x where length(case when grp = 2 then regexp_replace(ms[i], '^' || pat || '$', '\\2') else ms[i] end) >= least),
a as (select doc_id, count_if(kind = 'assign') n_assign, count_if(kind = 'access') n_access, count_if(kind = 'hex') n_hex, string_agg(kind || ':' || st || ':' || (st + length(s)), ',' order by st, ord) spans from y group by 1)
select doc_id, coalesce(n_assign, 0)::bigint n_assign, coalesce(n_access, 0)::bigint n_access, coalesce(n_hex, 0)::bigint n_hex, sha256(coalesce(spans, '')) base_sha256, coalesce(spans, '') spans, sha256(t) blob from d left join a using (doc_id)
"""

OP11_SQL = f"""
with d as (select coalesce(lang, '') lang, coalesce(source, '') source, regexp_extract_all(translate(coalesce(text, ''), '{divergence._UPPER}', '{divergence._LOWER}'), '{divergence.TERM}') ts from documents),
g as (select distinct lang, source from d), o as (select lang, source, unnest(ts) term from d), f as (select lang, unnest(list_distinct(ts)) term from d),
k as (select lang, term from f group by all having count(*) >= {divergence.LEAST}), v as (select g.lang, g.source, count(k.term) v from g left join k using (lang) group by all),
c as (select lang, source, term, count(*) n from o join k using (lang, term) group by all), t as (select lang, source, v, coalesce((select sum(n) from c where c.lang = v.lang and c.source = v.source), 0) total from v),
lc as (select lang, term, sum(n) n from c group by all), lt as (select lang, sum(n) total from lc group by all),
p as (select lang, source, k.term, coalesce(c.n, 0) n, 1 + (1000000000::hugeint * (coalesce(c.n, 0) + 5)) // (t.total + 5 * v) p, 1 + (1000000000::hugeint * (lc.n + 5)) // (lt.total + 5 * v) q
 from t join k using (lang) left join c using (lang, source, term) join lc using (lang, term) join lt using (lang)),
r as (select a.lang, a.source, 'pair' part, b.source item, coalesce((select sum(abs(x.p - y.p)) from p x join p y using (lang, term) where x.lang = a.lang and x.source = a.source and y.source = b.source), 0)::bigint as value from g a join g b on a.lang = b.lang and a.source <> b.source
 union all select lang, source, 'term', term, (p - q)::bigint from p where n > 0 and p > q)
select lang, source, part, item, value, row_number() over (partition by lang, source, part order by value desc, encode(item))::int as rank from r qualify part = 'pair' or rank <= {divergence.TOP}
"""

_CODED = """
{n} as (select * from (select vec_id, label, part, x, entry, c, list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint d, row_number() over (partition by r, part order by d, entry) nth from v join {books} using (part)) where nth = 1),
"""
_MOVED = """
{n} as (select b.part, b.entry, coalesce(m.c, b.c) c from {books} b left join (select part, entry, list(m order by i) c from (select part, entry, i, ((sum(x[i]) - (sum(x[i]) % count(*) + count(*)) % count(*)) // count(*))::bigint m from {coded}, unnest(range(1, len(x) + 1)) u(i) group by all) group by all) m using (part, entry)),
"""
OP13_SQL = (
    """
with k as (select *, row_number() over (order by vec_id) r from (select vec_id, label, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) v from embeddings where len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)),
v as (select r, vec_id, label, part, v[part * len(v) // 16 + 1 : (part + 1) * len(v) // 16] x from k, range(16) u(part)),
b0 as (select part, r - 1 entry, x c from v where r <= 64),
"""
    + _CODED.format(n="c0", books="b0") + _MOVED.format(n="b1", books="b0", coded="c0") + _CODED.format(n="c1", books="b1") + _MOVED.format(n="b2", books="b1", coded="c1") + _CODED.format(n="c2", books="b2")
    + """
h as (select sha256(string_agg(array_to_string(c, ','), ',' order by part, entry)) codebooks_sha256 from b2),
e as (select vec_id, label, string_agg(format('{:02x}', entry), '' order by part) code, sum(d)::bigint error from c2 group by all)
select vec_id, code, error, (sum(error) over (partition by label))::bigint label_error, codebooks_sha256 from e, h
"""
)


def oracle_sql() -> dict[str, str]:
    """SQL where DuckDB can express the contract; the other queries are held against plain versions in the tests."""
    return {"op1_warc": OP1_SQL, "op3_topk": OP3_SQL, "op5_secrets": OP5_SQL, "op11_divergence": OP11_SQL, "op13_vector_codes": OP13_SQL}
