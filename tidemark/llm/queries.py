"""The registered queries of the training-data operators, and DuckDB SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe_codec, collocations, conversation_repair, decontaminate, knn_quality, line_crf, minhash, piece_codec, suffix_dedup, token_counts, tool_calls, url_rules, warc
from ._common import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_crf.judge(docs, line_crf.train(docs, table(spark, sf_dir, "labels")))


def op2_knn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    space = knn_quality.train(docs, table(spark, sf_dir, "labels"), learnable=~held_out)
    return knn_quality.classify(docs, space).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.hit_digest(decontaminate.find_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


#: The tools that chat turns are read as.
TOOLS = [("reply", {"prompt": "string", "chars": "integer"}, {}), ("instruct", {"prompt": "string", "chars": "integer"}, {})]


def op4_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = tool_calls.calls_of_chat(table(spark, sf_dir, "conversations"))
    schemas = spark.createDataFrame(TOOLS, "name string, required map<string,string>, optional map<string,string>")
    linked = tool_calls.link(calls, results, schemas).withColumn("problems", F.array_join("problems", ","))
    lost = tool_calls.orphans(calls, results).select("conv_id", "call_id", "content", F.lit("orphan").alias("problems"), F.lit(False).alias("valid"))
    return linked.unionByName(lost, allowMissingColumns=True)


#: verdict, host, path
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judge(pages, url_rules.rules_table(spark, URL_RULES)).select("page_id", "host", "path", "rule", "verdict")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns are of 400-byte strings; n_passage_bytes counts repeated passages of over 50 words as well."""
    return suffix_dedup.repeats(table(spark, sf_dir, "documents"), words=suffix_dedup.WORDS)


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), k=4, percent=80)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    archive = warc.write(pages)
    found = warc.lookup(archive, warc.wanted_of(pages))
    return warc.read(archive, found).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.digest(table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    damaged = conversation_repair.damage(turns)
    return conversation_repair.digest(turns, conversation_repair.repair(damaged.where("alive")))


def op13_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.digest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_knn_quality": op2_knn_quality,
    "op3_decontamination": op3_decontamination,
    "op4_tool_calls": op4_tool_calls,
    "op5_url_rules": op5_url_rules,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_minhash": op7_minhash,
    "op8_warc": op8_warc,
    "op9_piece_codec": op9_piece_codec,
    "op10_token_counts": op10_token_counts,
    "op11_collocations": op11_collocations,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_bpe_codec": op13_bpe_codec,
}

#: CRC-32 of a text in DuckDB, by a table made from the polynomial.
_CRC_TABLE = "select list(v order by i) crcs from (select i, list_reduce(list_prepend(i, range(8)), lambda c, _: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end) v from range(256) r(i))"
_CRC = "xor(list_reduce(list_prepend(4294967295, list_transform(range(1, strlen({0}) + 1), lambda i: ascii(substr({0}, i, 1)))), lambda c, b: xor(crcs[xor(c % 256, b) + 1], c // 256)), 4294967295)"

_WORDS3 = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_WORDS1 = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"



def _line(before: str, role: str, text: str) -> str:
    return f"{before} || case when {before} = '' then '' else chr(10) end || {role} || ':' || {text}"


def _more(way: str, role: str) -> str:
    """A way (cost, audit, repaired text) of the conversation repair after one insertion."""
    return f"{{'c': ({way}).c + 5, 'a': ({way}).a || 'I', 'r': {_line(f'({way}).r', repr(role), repr(''))}}}"


def _way(way: str, edit: str, initial: str = "") -> str:
    """After one row is deleted, kept or changed; ways that do not stand cost too much ever to be chosen."""
    if edit == "D":
        return f"{{'c': {way}.c + 2, 'a': {way}.a || 'D', 'r': {way}.r}}"
    role, closed = ("role", f"must or i <> '{initial}'") if edit == "K" else (repr("user" if initial == "u" else "assistant"), "must")
    return f"{{'c': {way}.c + more + {int(edit == 'R')} + case when {closed} then 1000000000 else 0 end, 'a': {way}.a || '{edit}', 'r': {_line(f'{way}.r', role, 'x')}}}"


ORACLES: dict[str, str] = {
    "op11_collocations": r"""
with piece as (select coalesce(lang, 'und') lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) p from documents where text is not null),
w as materialized (select lang, regexp_extract_all(p, '[^\x20\x09]+') w from piece),
gram as (select lang, k, array_to_string(w[s:s + k - 1], ' ') phrase from (select lang, w, k, unnest(range(1, len(w) - k + 2)) s from w, (values (1), (2), (3)) x(k) where len(w) >= k)),
f as materialized (select lang, k, phrase, count(*) f from gram group by all),
total as (select lang, sum(f) n from f where k = 1 group by 1),
cand as materialized (select lang, k, phrase, string_split(phrase, ' ') w, f a from f where k > 1 and f >= 10),
cut as (select lang, phrase, c.k size, c.a, x.cut, array_to_string(w[1:x.cut], ' ') head, array_to_string(w[x.cut + 1:], ' ') tail from cand c, (values (1), (2)) x(cut) where x.cut < c.k),
scored as (select cut.lang, cut.phrase, size, a, h.f l, t.f r, cut, cast((1000000 * cast(a as hugeint) * a) // (cast(h.f as hugeint) * t.f) as bigint) score
 from cut join f h on h.lang = cut.lang and h.phrase = head and h.k = cut join f t on t.lang = cut.lang and t.phrase = tail and t.k = size - cut),
best as (select lang, phrase, size, a, arg_min(l, (score, cut)) l, arg_min(r, (score, cut)) r, min(score) score from scored group by all),
longer as (select lang, sub, max(a) most from (select lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) sub from cand where k = 3) group by all),
kept as (select best.* from best left join longer on longer.lang = best.lang and sub = phrase and size = 2 where most is null or 100 * most < 50 * a),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) rank from kept)
select lang, rank, phrase, a, l, r, cast(n as bigint) n, score from ranked join total using (lang) where rank <= 2000""",
    "op12_conversation_repair": f"""
with recursive crc as ({_CRC_TABLE}),
src as (select conv_id, turn, coalesce(role, ' ') role, coalesce(text, ' ') t, coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') k from conversations),
fated as materialized (select src.* exclude (k), {_CRC.format("k")} % 20 fate from src, crc),
alive as (select conv_id, turn, case when fate = 4 then 'user' else role end role, case fate when 1 then '' when 2 then regexp_replace(t, '[.!?]', '', 'g') else t end x, unnest(range(case when fate = 3 then 2 else 1 end)) time from fated where fate <> 0),
placed as (select conv_id, turn, role, x, row_number() over (partition by conv_id order by turn nulls first, role, x) n from alive),
judged as (select *, row_number() over (partition by conv_id, role, x order by n) again, regexp_extract(x, '[^\\x20\\x09-\\x0D]([\\x20\\x09-\\x0D]*)$') tail from placed),
rows as materialized (select conv_id, turn, role, x, n, substr(role, 1, 1) i, case when tail = '' then 'blank' when again > 1 then 'duplicate' when substr(tail, 1, 1) not in ('.', '!', '?') then 'truncated' end fault from judged),
counts as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) gaps, count(*) filter (fault = 'blank') blank, count(*) filter (fault = 'duplicate') duplicate, count(*) filter (fault = 'truncated') truncated,
 count(*) filter (bad) illegal, max(n) n from (select *, lag(i) over (partition by conv_id order by n) || i not in ('su', 'ua', 'au') bad from rows) group by 1),
walk(conv_id, n, s0, s1, s2, s3) as (
 select conv_id, cast(0 as bigint), {{'c': 0, 'a': '', 'r': ''}}, {{'c': 1000000000, 'a': '', 'r': ''}}, {{'c': 1000000000, 'a': '', 'r': ''}}, {{'c': 1000000000, 'a': '', 'r': ''}} from counts
 union all
 select conv_id, n, {_way("e0", "D")}, least({_way("e1", "D")}, {_way("e0", "K", "s")}),
  least({_way("e2", "D")}, {", ".join(_way(e, k, "u") for e in ("e0", "e1", "e3") for k in "KR")}), least({_way("e3", "D")}, {_way("e2", "K", "a")}, {_way("e2", "R", "a")})
 from (select r.conv_id, r.n, r.role, r.i, r.x, fault in ('blank', 'duplicate') and fault is not null must, case when fault = 'truncated' then 5 else 0 end more,
   w.s0 e0, w.s1 e1, least(w.s2, {_more("w.s0", "user")}, {_more("w.s1", "user")}, {_more("w.s3", "user")}) e2, least(w.s3, {_more("w.s2", "assistant")}, {_more(_more("w.s0", "user"), "assistant")}, {_more(_more("w.s1", "user"), "assistant")}) e3
  from walk w join rows r on r.conv_id is not distinct from w.conv_id and r.n = w.n + 1)),
ended as (select w.conv_id, least(s0, s3, {_more("s2", "assistant")}, {_more(_more("s1", "user"), "assistant")}) z from walk w join counts c on c.conv_id is not distinct from w.conv_id and c.n = w.n)
select o.conv_id, coalesce(gaps, 0) gaps, coalesce(blank, 0) blank, coalesce(duplicate, 0) duplicate, coalesce(truncated, 0) truncated, coalesce(illegal, 0) illegal, cast(coalesce(z.c, 0) as bigint) "cost", coalesce(z.a, '') audit, sha256(coalesce(z.r, '')) repaired_sha256
from (select distinct conv_id from conversations) o left join counts c on c.conv_id is not distinct from o.conv_id left join ended e on e.conv_id is not distinct from o.conv_id""",
    "op4_tool_calls": """
with recursive sized as (select conv_id, turn, role, text, coalesce(text, '') prompt, cast(coalesce(length(text), 0) as integer) chars from conversations),
ask as materialized (select *, 'call-' || turn call_id, (3 * conv_id + turn) % 8 kind, chars % 10 form,
 case when turn >= 2 then ['call-' || (turn - 2)] when turn = 1 then ['call-0'] else [] end before from sized where role in ('user', 'system')),
needs as (select conv_id, call_id, unnest(list_distinct(case when kind <= 2 then before when kind = 3 then list_concat(before, case when turn >= 4 then ['call-' || (turn - 4)] else [] end)
 when kind = 4 then ['call-' || (turn + 2)] when kind = 5 then list_concat(['call-' || (turn + 2)], before) when kind = 7 then list_concat(before, ['call-none']) else [] end)) need from ask),
edge as materialized (select n.conv_id, n.call_id, need from needs n join ask a on a.conv_id = n.conv_id and a.call_id = need),
lost as (select conv_id, call_id from needs n where not exists (from ask a where a.conv_id = n.conv_id and a.call_id = need) group by all),
many as (select conv_id, count(*) most from ask group by 1),
walk(conv_id, call_id, d) as (select conv_id, call_id, 0 from ask union select e.conv_id, e.call_id, w.d + 1 from walk w join edge e on e.conv_id = w.conv_id and e.need = w.call_id join many m on m.conv_id = w.conv_id where w.d < m.most),
lev as (select conv_id, call_id, case when max(d) < any_value(most) then max(d) end lev from walk join many using (conv_id) group by 1, 2),
given as (select conv_id, case when chars % 12 = 5 then 'lost-' || turn else 'call-' || (turn - 1) end call_id, text content, unnest(range(case when chars % 12 = 7 then 2 else 1 end)) from sized where role = 'assistant'),
back as (select conv_id, call_id, min(content) content, count(*) n from given group by 1, 2),
named as (select ask.*, case when form = 9 then 'shout' when role = 'user' then 'reply' else 'instruct' end name,
 case form when 4 then to_json({'chars': chars}) when 1 then to_json({'chars': cast(chars as varchar), 'prompt': prompt}) when 2 then to_json({'chars': chars, 'loud': true, 'prompt': prompt}) when 3 then null else to_json({'chars': chars, 'prompt': prompt}) end args,
 case form when 4 then 'missing:prompt' when 1 then 'type:chars' when 2 then 'unexpected:loud' when 3 then 'bad_json' when 9 then 'unknown_tool' end problem from ask),
judged as (select named.*, lev, content, coalesce(n, 0) n, concat_ws(',', problem, case when lost.call_id is not null then 'unknown_dependency' end, case when lev is null then 'cycle' end, case when n is null then 'no_result' end) problems
 from named join lev using (conv_id, call_id) left join back using (conv_id, call_id) left join lost using (conv_id, call_id))
select cast(conv_id as varchar) conv_id, call_id, cast(turn as bigint) as "position", cast(lev as integer) as "level", name, cast(args as varchar) arguments, content, n n_results, problems, problems = '' valid,
 '{"arguments":' || coalesce(cast(args as varchar), 'null') || ',"id":"' || call_id || '","name":"' || name || '","result":' || coalesce(cast(to_json(content) as varchar), 'null') || ',"valid":' || case when problems = '' then 'true' else 'false' end || '}' message from judged
union all
select cast(conv_id as varchar), call_id, null, null, null, null, content, null, 'orphan', false, null from given g where not exists (from ask a where a.conv_id = g.conv_id and a.call_id = g.call_id)""",
    "op5_url_rules": f"""
with rule(v, h, p) as (values {", ".join(str(r) for r in URL_RULES)}),
u as (select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end r from pages),
w as (select page_id, regexp_extract(r, '^[^/?#]*') h, r from u),
x as (select page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host, regexp_extract(substr(r, length(h) + 1), '^[^?#]*') path from w),
m as (select page_id, arg_max(h || p, length(h || p)) rule, arg_max(v, length(h || p)) v from x join rule on (host = h or ends_with(host, '.' || h)) and starts_with(path, p) group by 1)
select page_id, host, path, rule, coalesce(v, 'allow') verdict from x left join m using (page_id)""",
    "op7_minhash": f"""
with recursive doc as (select doc_id, {_WORDS1} w from documents),
sh as materialized (select distinct doc_id, array_to_string(w[s:s + 3], ' ') g from (select doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) s from doc where len(w) > 0)),
n as materialized (select doc_id, count(*) n from sh group by 1),
both_ as (select a.doc_id x, b.doc_id y, count(*) c from sh a join sh b on a.g = b.g and a.doc_id < b.doc_id group by all),
link as materialized (select x, y from both_ join n p on p.doc_id = x join n q on q.doc_id = y where 100 * c >= 80 * (p.n + q.n - c)),
edge as materialized (select x, y from link union all select y, x from link),
reach(node, seen) as (select doc_id, doc_id from documents union select e.y, r.seen from reach r join edge e on e.x = r.node and r.seen < e.y)
select doc_id, coalesce(n.n, 0) n_shingles, c component_id, c = doc_id kept
from (select node doc_id, min(seen) c from reach group by 1) left join n using (doc_id)""",
    "op3_decontamination": f"""
with item as (select cast(item_id as varchar) i, {_WORDS3} w from benchmark where text is not null),
win as (select i, least(10, len(w)) k, unnest(range(1, greatest(len(w) - 9, 1) + 1)) s, w from item where len(w) > 0),
pat as (select distinct i, k, array_to_string(w[s:s + k - 1], ' ') p from win),
doc as (select doc_id, coalesce({_WORDS3}, []) w from documents),
pos as (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) s from doc, (select distinct k from pat) where len(w) >= k),
hit as (select doc_id, s, pat.k, i from pos join pat on pat.k = pos.k and pat.p = array_to_string(w[s:s + pos.k - 1], ' ')),
words as (select doc_id, count(distinct x) n from (select doc_id, unnest(range(s, s + k)) x from hit) group by all),
items as (select doc_id, count(*) n, string_agg(i, ',' order by i) ids from (select distinct doc_id, i from hit) group by all)
select doc_id, cast(len(w) as bigint) n_words, cast(coalesce(words.n, 0) as bigint) n_hit, cast(coalesce(items.n, 0) as bigint) n_items,
 sha256(coalesce(ids, '')) items_sha256, coalesce(words.n, 0) > 0 contaminated
from doc left join words using (doc_id) left join items using (doc_id)""",
    "op8_warc": """
with p as (select page_id, coalesce(html, '') h from pages),
d as (select page_id, octet_length(encode(h)) n, sha1(h) s from p),
best as (select s, max(page_id) best from d where n >= 1000 group by s)
select page_id, cast(n as bigint) payload_bytes, d.s payload_digest, case when best is null or best = page_id then 'response' else 'revisit' end record_type,
 case when best <> page_id then best end refers_to
from d left join best on best.s = d.s and d.n >= 1000""",
}
