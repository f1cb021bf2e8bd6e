"""The registered queries of the training-data operators: each applies one to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venuekit.llm import (
    audit, bpe, chat, fingerprints, html, jaccard, language, lines, mixing, order_minhash, periodic, topk, toxicity,
)
from venuekit.llm.registry import query, table

TOP_K_SQL = """
with v as (
    select vec_id, [floor(256 * cast(x as double)) for x in embedding] as q from embeddings
    where embedding is not null and len(embedding) > 0 and vec_id is not null
      and len([x for x in embedding if x is null or not isfinite(x)]) = 0
), s as (
    select a.vec_id as query_id, b.vec_id as vec_id, cast(list_inner_product(a.q, b.q) as bigint) as score
    from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0
), r as (
    select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s
)
select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 5
"""

# Backslashes are doubled, and one goes in after the first character of each control string.
_escaped = "replace({}, '\\', '\\\\')"
for _c in chat.CONTROL:
    _escaped = f"replace({_escaped}, '{_c}', '{_c[0]}\\{_c[1:]}')"

CHAT_SQL = f"""
with t as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), f as (
    select *, replace({_escaped.format("role")}, chr(10), '\\' || chr(10)) as r, {_escaped.format("text")} as x from t
), g as (
    select conv_id, count(*) as n_turns,
           string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text) as said,
           coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '') as learned,
           sum(length('<|im_start|>' || r || chr(10) || x || '<|im_end|>' || chr(10))) as formatted_chars
    from f group by conv_id
)
select conv_id, n_turns, sha256(said) as turns_sha256, length(learned) as loss_chars, sha256(learned) as loss_sha256,
       cast(formatted_chars as bigint) as formatted_chars
from g
"""

# Pairs by their common shingles, then everything that links lead to.
JACCARD_SQL = r"""
with recursive w as (
    select doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'
    ) as w from documents
), g as (
    select doc_id, list_distinct(case when len(w) >= 4
        then [concat_ws(' ', w[i], w[i + 1], w[i + 2], w[i + 3]) for i in range(1, len(w) - 2)]
        when len(w) > 0 then [array_to_string(w, ' ')] else cast([] as varchar[]) end) as g from w
), s as (
    select doc_id, len(g) as n, unnest(g) as x from g
), links as (
    select a.doc_id as a, b.doc_id as b from s a join s b on a.x = b.x and a.doc_id <> b.doc_id
    group by a.doc_id, b.doc_id having 185 * count(*) >= 85 * (min(a.n) + min(b.n))
), reach as (
    select doc_id as a, doc_id as b from documents union select r.a, l.b from reach r join links l on r.b = l.a
)
select doc_id, cast(len(g) as bigint) as n_shingles, component_id
from g join (select a as doc_id, min(b) as component_id from reach group by a) using (doc_id)
"""

# Equal words of a text at distance q, in stretches, are its runs with period q; the smallest q of equal stretches counts.
RUNS_SQL = r"""
with plain as (
    select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
           list_reduce(
               [4294967295] || [cast(ascii(c) as bigint) for c in string_split(cast(doc_id as varchar), '')],
               lambda c, b: list_reduce(
                   [xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384)
               )
           ) as crc
    from documents
), planted as (
    select doc_id, w, len(w) as n, xor(crc, 4294967295) as h, xor(crc, 4294967295) // 10 as g from plain
), ended as (
    select *, case when h % 10 = 0 and n > 0 then g % n end as a from planted
), cut as (
    select *, 1 + (n - a) // (3 + g % 8) as p from ended
), texts as (
    select doc_id, n, case when a is null then w
           else [w[case when i < a then i else a + (i - a) % p end + 1] for i in range(n)] end as w
    from cut
), words as (
    select doc_id, n, unnest(range(n)) as i, unnest(w) as word from texts
), equal as (
    select x.doc_id, x.i, x.i - y.i as q from words x join words y
    on x.doc_id = y.doc_id and x.word = y.word and x.i > y.i and 3 * (x.i - y.i) <= x.n
), islands as (
    select doc_id, q, min(i) - q as start, count(*) + q as length
    from (select *, i - row_number() over (partition by doc_id, q order by i) as island from equal) group by doc_id, q, island
), runs as (
    select doc_id, start, length, min(q) as period from islands where length >= greatest(24, 3 * q) group by all
), best as (
    select *, row_number() over (partition by doc_id order by cast(length as double) / period desc, start, period) as place
    from runs
), told as (
    select doc_id, count(*) as n_runs,
           string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as line
    from runs group by doc_id
), kept as (
    select doc_id, string_agg(word, ' ' order by i) as line from words
    where not exists (
        select 1 from runs r where r.doc_id = words.doc_id and words.i >= r.start + r.period and words.i < r.start + r.length
    ) group by doc_id
)
select t.doc_id, coalesce(n_runs, 0) as n_runs, start, length, period, 1000 * length // period as exponent_milli,
       sha256(coalesce(told.line, '')) as runs_sha256, sha256(coalesce(kept.line, '')) as collapsed_sha256
from texts t left join told using (doc_id) left join kept using (doc_id)
left join (select * from best where place = 1) b using (doc_id)
"""

# For each set of failed filters the first of them in an order removes; the others that fail are redundant there.
AUDIT_SQL = r"""
with d as (
    select doc_id, coalesce(source, '') as part, coalesce(text, '') as text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
           min(doc_id) over (partition by coalesce(text, '')) as first
    from documents
), f as (
    select doc_id, part,
           case when len(w) < 50 then 'A' else '' end
           || case when 100 * len(list_distinct(w)) < 65 * len(w) then 'B' else '' end
           || case when 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) then 'C' else '' end
           || case when regexp_matches(text, '[#$%&*|]') then 'D' else '' end
           || case when doc_id > first then 'E' else '' end as fails
    from d
), l as (
    select doc_id, max(cast(quality = 1 as integer)) as good, max(cast(toxic = 1 as integer)) as toxic from labels group by doc_id
), c as (
    select part, fails, count(*) as n, coalesce(sum(good), 0) as good, coalesce(sum(toxic), 0) as toxic
    from f left join l using (doc_id) group by part, fails
), x as (select unnest(['A', 'B', 'C', 'D', 'E']) as x), o as (
    select concat(p.x, q.x, r.x, s.x, t.x) as filter_order from x p, x q, x r, x s, x t
    where len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5
), s as (
    select filter_order, cast(unnest(range(1, 6)) as integer) as step from o
), e as (
    select part, filter_order, step, substr(filter_order, step, 1) as letter, fails, n, good, toxic,
           list_min([instr(filter_order, y) for y in string_split(fails, '')]) as hit
    from c, s where fails <> ''
    union all select part, filter_order, step, substr(filter_order, step, 1), fails, n, good, toxic, 99 from c, s where fails = ''
), m as (
    select part, filter_order, step, letter,
           sum(if(hit > step, n, 0)) as kept, sum(if(hit = step, n, 0)) as removed,
           sum(if(hit < step and contains(fails, letter), n, 0)) as redundant, sum(if(fails = letter, n, 0)) as unique_fails,
           sum(if(hit = step, good, 0)) as good_lost, sum(if(hit = step, toxic, 0)) as toxic_lost
    from e group by part, filter_order, step, letter
)
select part, filter_order, step, cast(kept as bigint) as kept, cast(removed as bigint) as removed,
       cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails,
       cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost,
       cast(sum(removed) over (partition by part, letter) as bigint) as shapley
from m
"""


def documents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents")


@query("op1_mixing")
def op1_mixing(spark: SparkSession, d: str) -> DataFrame:
    """Every document with the words that the mix takes of it."""
    return mixing.mix(documents(spark, d)).select("doc_id", "size", "source_size", "target", "taken", "source")


@query("op2_topk", TOP_K_SQL)
def op2_topk(spark: SparkSession, d: str) -> DataFrame:
    """The five highest inner products of every fiftieth vector with all others."""
    rows = table(spark, d, "embeddings").where(topk.usable(F.col("embedding")))
    vectors = rows.select("vec_id", topk.quantized(F.col("embedding")).alias("vector"))
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


@query("op3_line_dedup")
def op3_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Every document with its lines, their links to different lines, and the positions of the lines that go."""
    return lines.line_decisions(documents(spark, d)).drop("version")


@query("op4_fingerprints")
def op4_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    """Fingerprints of every text and its edited text."""
    return fingerprints.document_fingerprints(documents(spark, d))


@query("op5_bpe")
def op5_bpe(spark: SparkSession, d: str) -> DataFrame:
    """Digests of the ids of every text and of the text they decode to."""
    return bpe_digests(bpe.decode(bpe.encode(documents(spark, d))))


def bpe_digests(decoded: DataFrame) -> DataFrame:
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), bpe.ids_digest(F.col("ids")).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


@query("op6_near_dedup")
def op6_near_dedup(spark: SparkSession, d: str) -> DataFrame:
    """The class of near copies of every document."""
    return order_minhash.near_classes(documents(spark, d))


@query("op7_chat", CHAT_SQL)
def op7_chat(spark: SparkSession, d: str) -> DataFrame:
    """Digests read back from the formatted text of every conversation, and one that is made of control strings."""
    turns = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    return chat.conversation_digests(chat.format_conversations(turns.unionByName(extra)))


@query("op8_language")
def op8_language(spark: SparkSession, d: str) -> DataFrame:
    """The language of every document."""
    return language.document_languages(documents(spark, d))


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, d: str) -> DataFrame:
    """The toxicity of every document."""
    return toxicity.document_toxicity(documents(spark, d), table(spark, d, "labels"))


@query("op10_html")
def op10_html(spark: SparkSession, d: str) -> DataFrame:
    """The main text of every page."""
    found = html.main_text(table(spark, d, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op11_jaccard", JACCARD_SQL)
def op11_jaccard(spark: SparkSession, d: str) -> DataFrame:
    """The number of shingles and the component of every document."""
    return jaccard.jaccard_components(documents(spark, d))


@query("op12_periodic", RUNS_SQL)
def op12_periodic(spark: SparkSession, d: str) -> DataFrame:
    """The periodic runs of every document, a tenth of which get a periodic end."""
    return periodic.run_digests(periodic.periodic_runs(periodic.with_planted_runs(documents(spark, d))))


@query("op13_audit", AUDIT_SQL)
def op13_audit(spark: SparkSession, d: str) -> DataFrame:
    """What each of five filters removes in every order, by source."""
    return audit.audit(documents(spark, d), table(spark, d, "labels"))
