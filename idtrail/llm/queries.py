"""The registered queries of this package and their SQL forms, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from idtrail.llm import align, bpe, lines, packing, pieces, preference, quality, runs, secrets, simhash, suffix, topk, toxicity
from idtrail.llm.common import table

QUERIES, SQL = {}, {}


def registered(sql: str | None = None):
    def put(query):
        QUERIES[query.__name__] = query
        if sql:
            SQL[query.__name__] = sql
        return query

    return put


@registered()
def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix.dedup(table(spark, folder, "documents"))


def _sql_spans(kind: str, pattern: str, group: int, least: int) -> str:
    """Spans of one kind in DuckDB: the gaps between matches and the matches, added up."""
    pattern = pattern.replace("'", "''")
    return f"""
    select doc_id, '{kind}' as kind, e - m as s, e, g >= {least} as good from (
      select doc_id, sum(gap + m) over (partition by doc_id order by i) as e, m, g from (
        select doc_id, unnest(generate_series(1, len(found))) as i, unnest(list_transform(found, lambda x: length(x))) as m,
               unnest(list_transform(vals, lambda x: length(x))) as g, unnest(list_transform(gaps[1:len(found)], lambda x: length(x))) as gap
        from (select doc_id, regexp_extract_all(text, '{pattern}', 0) as found, regexp_extract_all(text, '{pattern}', {group}) as vals,
                     regexp_split_to_array(text, '{pattern}') as gaps from docs where regexp_matches(text, '{pattern}'))))"""


SECRETS_SQL = f"""
with docs as (select doc_id, coalesce(text, '') as text from documents),
hits as ({" union all ".join(_sql_spans(kind, pattern, group, least) for kind, _, pattern, group, least in secrets.RULES)}),
good as (select *, case kind when 'assign' then 0 when 'access' then 1 else 2 end as k from hits where good),
told as (select doc_id, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access,
                count(*) filter (kind = 'hex') as n_hex,
                string_agg(kind || ':' || s::bigint || ':' || e::bigint, ',' order by s, k) as spans from good group by doc_id)
select d.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
       sha256(coalesce(spans, '')) as base_sha256, coalesce(spans, '') as spans
from docs d left join told t on d.doc_id = t.doc_id
"""


@registered(SECRETS_SQL)
def op2_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """The ledger starts empty, so every text of the table is new to it."""
    return secrets.digest(table(spark, folder, "documents"))


@registered()
def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(table(spark, folder, "documents"))


@registered()
def op4_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@registered("""
with lined as (select doc_id, i, trim(line, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)) as line from (
  select doc_id, unnest(x) as line, generate_subscripts(x, 1) - 1 as i from (select doc_id, string_split(coalesce(text, ''), chr(10)) as x from documents))),
said as (select *, row_number() over (partition by doc_id order by i) as n from lined where line <> ''),
two as (select a.doc_id, a.i, b.i as j, a.line || chr(10) || b.line as content, a.n from said a join said b on a.doc_id = b.doc_id and b.n = a.n + 1),
one as (select doc_id, i, i as j, line as content, n from said where len(regexp_split_to_array(line, '[ \t\x0B\f\r]+')) >= 5),
windows as (select *, 2 as k from two union all select *, 1 as k from one),
ranked as (select *, row_number() over (partition by k, content order by doc_id, i) as r from windows),
gone as (select doc_id, i from ranked where r > 1 union select doc_id, j from ranked where r > 1),
whole as (select doc_id, unnest(x) as line, generate_subscripts(x, 1) - 1 as i from (select doc_id, string_split(coalesce(text, ''), chr(10)) as x from documents)),
kept as (select w.doc_id, string_agg(w.line, chr(10) order by w.i) as text from whole w left join gone g on w.doc_id = g.doc_id and w.i = g.i
         where g.doc_id is null group by w.doc_id),
counted as (select s.doc_id, count(*) as n_lines, count(g.doc_id) as n_removed from said s left join gone g on s.doc_id = g.doc_id and s.i = g.i group by s.doc_id)
select d.doc_id, coalesce(n_lines, 0) as n_lines, coalesce(n_removed, 0) as n_removed, sha256(coalesce(k.text, '')) as kept_sha256
from documents d left join counted c on d.doc_id = c.doc_id left join kept k on d.doc_id = k.doc_id
""")
def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lines.digest(table(spark, folder, "documents"))


PAIRS_SQL = """
with said as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations),
chosen as (select * from said),
other as (select xor(conv_id, 1) as conv_id, turn, min(text) as text from said where role = 'assistant' group by all),
rejected as (select s.conv_id, s.turn, s.role, case when s.role = 'assistant' then coalesce(o.text, s.text) else s.text end as text
             from said s left join other o on s.conv_id = o.conv_id and s.turn is not distinct from o.turn),
turns as (select conv_id as pair_id, 'chosen' as side, turn, replace(role, '<|', '< |') as role, replace(text, '<|', '< |') as text from chosen
          union all select conv_id, 'rejected', turn, replace(role, '<|', '< |'), replace(text, '<|', '< |') from rejected),
placed as (select *, row_number() over (partition by pair_id, side order by turn nulls first, role, text) as i from turns),
sized as (select pair_id, count(*) filter (side = 'chosen') as nc, count(*) filter (side = 'rejected') as nr from placed group by pair_id),
apart as (select c.pair_id, min(c.i) as i from placed c join placed r on c.pair_id = r.pair_id and c.i = r.i
          where c.side = 'chosen' and r.side = 'rejected' and (c.role <> r.role or c.text <> r.text) group by c.pair_id),
cut as (select s.pair_id, coalesce(a.i - 1, least(nc, nr)) as k from sized s left join apart a on s.pair_id = a.pair_id),
drawn as (select p.pair_id, side, i, k, role, '<|im_start|>' || role || chr(10) as head, text || '<|im_end|>' as body from placed p join cut c on p.pair_id = c.pair_id),
rest as (select *, coalesce(sum(length(head) + length(body) + 1) over (partition by pair_id, side order by i rows between unbounded preceding and 1 preceding), 0) as pos
         from drawn where i > k),
told as (select pair_id, side, string_agg(head || body || chr(10), '' order by i) as text,
                string_agg((pos + length(head))::bigint || ':' || (pos + length(head) + length(body))::bigint, ',' order by i) filter (role = 'assistant') as mask
         from rest group by pair_id, side),
heads as (select pair_id, string_agg(head || body || chr(10), '' order by i) as prompt from drawn where i <= k and side = 'chosen' group by pair_id)
select c.pair_id, c.k as n_prompt, coalesce(h.prompt, '') as prompt, coalesce(a.text, '') as chosen, coalesce(b.text, '') as rejected,
       coalesce(a.mask, '') as chosen_mask, coalesce(b.mask, '') as rejected_mask, a.mask is not null and b.mask is not null as differs
from cut c left join heads h on c.pair_id = h.pair_id left join told a on c.pair_id = a.pair_id and a.side = 'chosen'
     left join told b on c.pair_id = b.pair_id and b.side = 'rejected'
"""


def conversation_pairs(said: DataFrame) -> DataFrame:
    """Pairs from whole conversations: ``chosen`` is the conversation, ``rejected`` the same with each assistant turn replaced by the
    assistant turn of that number in the neighbour (ids 2n and 2n+1 are neighbours), where it has one; of several the least text.

    Every row of ``said`` is in both sides. Rows without id are one conversation, without a neighbour; turns without number meet.
    """
    said = said.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    replies = said.where("role = 'assistant'").groupBy(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("of"), F.col("turn").alias("at")).agg(F.min("text").alias("other"))
    both = said.join(replies, (F.col("conv_id") == F.col("of")) & F.col("turn").eqNullSafe(F.col("at")), "left")
    text = F.when(F.col("role") == "assistant", F.coalesce("other", "text")).otherwise(F.col("text"))
    sides = F.array(F.struct(F.lit("chosen").alias("side"), F.col("text")), F.struct(F.lit("rejected").alias("side"), text.alias("text")))
    return both.select(F.col("conv_id").alias("pair_id"), "turn", "role", F.explode(sides).alias("s")).select("pair_id", "turn", "role", "s.*")


@registered(PAIRS_SQL)
def op6_preferences(spark: SparkSession, folder: str) -> DataFrame:
    found = preference.preferences(conversation_pairs(table(spark, folder, "conversations")))
    told = {
        f"{s}_mask": F.array_join(F.transform(f"{s}_mask", lambda x: F.concat_ws(":", x.start.cast("string"), x.end.cast("string"))), ",")
        for s in ("chosen", "rejected")
    }
    return found.withColumns(told)


@registered("""
with whole as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
               where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (select q.vec_id as query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint as score
           from whole q join whole c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0),
ranked as (select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score from scored)
select * from ranked where rank <= 5
""")
def op7_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"), 5)


@registered()
def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_groups(table(spark, folder, "documents"))


@registered()
def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score(table(spark, folder, "documents"), table(spark, folder, "labels"))


@registered()
def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(
        table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


@registered()
def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return align.align(
        table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN, public_tokenizers.path("piece_bpe_32k.model"), digest=True,
    ).withColumnRenamed("groups", "groups_sha256")


@registered()
def op12_pieces(spark: SparkSession, folder: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    told = pieces.decode(pieces.encode(table(spark, folder, "documents"), model), model)
    return told.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def planted(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: in a tenth of the documents, dealt by their ids, the words from some place on repeat with some period."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g, n, a = F.floor(h / 10), F.size("words"), F.col("a")
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[ \t\n\x0B\f\r]+"), lambda x: x != "")
    dealt = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("words"), g.alias("g"))
    placed = dealt.withColumn("a", F.when(n > 0, F.col("g") % n)).withColumn("p", 1 + F.floor((n - a) / (3 + F.col("g") % 8)))
    repeated = F.transform("words", lambda x, i: F.when(i < a, x).otherwise(F.get("words", (a + (i - a) % F.col("p")).cast("int"))))
    return placed.select("doc_id", F.when(a.isNotNull(), F.concat_ws(" ", repeated)).otherwise(F.col("text")).alias("text"))


@registered()
def op13_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = runs.runs(planted(table(spark, folder, "documents")))
    told = F.arrays_zip("starts", "lengths", "periods")
    best = F.array_min(F.transform(told, lambda r: F.struct((-r["lengths"]).alias("length"), r["starts"].alias("start"), r["periods"].alias("period"))))
    run_lines = F.transform(told, lambda r: F.concat(F.concat_ws(",", r["starts"], r["lengths"], r["periods"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("starts").cast("long").alias("n_runs"), F.col("best.start").cast("long").alias("start"),
        (-F.col("best.length")).cast("long").alias("length"), F.col("best.period").cast("long").alias("period"),
        F.floor(-F.col("best.length").cast("long") * 1000 / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.concat_ws("", run_lines), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
