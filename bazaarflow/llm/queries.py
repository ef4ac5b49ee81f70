"""The registered queries of the corpus operators, with their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from bazaarflow.session import apply_rules

from . import (
    decontamination,
    jaccard_join,
    language,
    licences,
    line_dedup,
    mixing,
    permutation_index,
    pii,
    radix_trie,
    sharding,
    span_dedup,
    structure,
    toxicity,
)
from .frames import held_out, stored, table

TOXIC_FROM = 0.3


def prepared(spark: SparkSession) -> SparkSession:
    """Run-time rules of a session; Arrow batches are kept small, as texts may be long."""
    apply_rules(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def op1_toxicity(spark: SparkSession, root: str) -> DataFrame:
    docs = table(prepared(spark), root, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, root, "labels"))
    found = toxicity.scored(docs, model)
    predicted = (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted")
    return found.select("doc_id", held_out().alias("held_out"), "score", predicted)


def op2_permutation_index(spark: SparkSession, root: str) -> DataFrame:
    vectors = table(prepared(spark), root, "embeddings")
    found = permutation_index.search(vectors, F.col("id") % 20 == 0)
    return found.withColumnRenamed("id", "vec_id")


def op3_line_dedup(spark: SparkSession, root: str) -> DataFrame:
    docs = table(prepared(spark), root, "documents").select("doc_id", "text")
    found = line_dedup.deduplicated(docs, min_docs=10)
    text = F.coalesce("text", F.lit(""))
    return found.select(
        "doc_id",
        F.size(line_dedup.lines_of(text)).cast("bigint").alias("n_lines"),
        "n_dropped",
        F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"),
    )


def op4_personal_data(spark: SparkSession, root: str) -> DataFrame:
    return pii.digest(pii.personal_data(table(prepared(spark), root, "documents")))


def op5_decontamination(spark: SparkSession, root: str) -> DataFrame:
    return decontamination.contained(table(prepared(spark), root, "documents"), table(spark, root, "benchmark"))


def op6_language(spark: SparkSession, root: str) -> DataFrame:
    docs = table(prepared(spark), root, "documents")
    found = language.identified(docs, language.learn(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op7_mixing(spark: SparkSession, root: str) -> DataFrame:
    docs = table(prepared(spark), root, "documents").select("doc_id", "text", "source")
    found = mixing.mixed(docs)
    return found.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op8_jaccard_join(spark: SparkSession, root: str) -> DataFrame:
    return jaccard_join.classes(table(prepared(spark), root, "documents"))


def op9_span_dedup(spark: SparkSession, root: str) -> DataFrame:
    return span_dedup.deduplicated(table(prepared(spark), root, "documents"))


def op10_licences(spark: SparkSession, root: str) -> DataFrame:
    found = licences.scanned(table(prepared(spark), root, "documents"))
    return found.select("doc_id", *[F.array_join(c, ",").alias(c) for c in ("sentence_ids", "rules", "licences")])


def op11_prefix_trie(spark: SparkSession, root: str) -> DataFrame:
    turns = radix_trie.sequences(table(prepared(spark), root, "conversations"))
    return radix_trie.prefix_trie(radix_trie.rebuilt(stored(turns, "conversations")))


def op12_structure_repair(spark: SparkSession, root: str) -> DataFrame:
    turns = structure.damaged(table(prepared(spark), root, "conversations"))
    return structure.repair_report(turns, held=F.col("held"))


def op13_sharding(spark: SparkSession, root: str) -> DataFrame:
    return sharding.placed(table(prepared(spark), root, "documents"), shards=24)


QUERIES = {f.__name__: f for f in list(globals().values()) if getattr(f, "__name__", "").startswith("op")}

SQL: dict[str, str] = {}

SQL["op3_line_dedup"] = """
with lines as (
  select doc_id, text, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos,
    unnest(string_split(coalesce(text, ''), chr(10))) as line
  from documents),
keys as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from lines),
common as (select key from keys where length(key) >= 1 group by key having count(distinct doc_id) >= 10),
marked as (select k.*, c.key is not null as dropped from keys k left join common c on k.key = c.key)
select doc_id, count(*) as n_lines, count(*) filter (dropped) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not dropped), '')) as kept_sha256
from marked group by doc_id"""


def _licence_sql() -> str:
    pairs = ", ".join(f"('{s}', '{i}')" for s, i in licences.known().items())
    held = [" " + " ".join(ids) + " " for _, _, ids in licences.RULES]
    rules = ", ".join(f"({k}, '{name}', '{spdx}', '{' '.join(ids)}')" for k, (name, spdx, ids) in enumerate(licences.RULES))
    longer = ", ".join(f"('{a.strip()}', '{b.strip()}')" for a in held for b in held if a != b and a in b)
    blank = "[\\x20\\x09-\\x0D]"
    return f"""
with known(sentence, id) as (values {pairs}),
rules(nr, rule, spdx, ids) as (values {rules}),
longer(ids, more) as (values {longer}),
parts as (
  select doc_id, generate_subscripts(p, 1) as pos, unnest(p) as part
  from (select doc_id, string_split(regexp_replace(coalesce(text, ''), '([.!?;:]){blank}+', '\\1' || chr(10), 'g'), chr(10)) as p
    from documents) t),
found as (
  select doc_id, pos, id from parts join known on trim(regexp_replace(translate(part,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+', ' ', 'g')) = sentence),
lines as (select doc_id, string_agg(id, ',' order by pos) as sentence_ids, ' ' || string_agg(id, ' ' order by pos) || ' ' as line
  from found group by doc_id),
hits as (
  select doc_id, nr, rule, spdx from lines join rules r on contains(line, ' ' || r.ids || ' ')
  where not exists (select 1 from longer l where l.ids = r.ids and contains(line, ' ' || l.more || ' '))),
firsts as (select doc_id, spdx, min(nr) as nr from hits group by doc_id, spdx),
named as (select doc_id, string_agg(rule, ',' order by nr) as rules from hits group by doc_id),
licensed as (select doc_id, string_agg(spdx, ',' order by nr) as licences from firsts group by doc_id)
select d.doc_id, coalesce(sentence_ids, '') as sentence_ids, coalesce(rules, '') as rules, coalesce(licences, '') as licences
from documents d left join lines using (doc_id) left join named using (doc_id) left join licensed using (doc_id)"""


SQL["op10_licences"] = _licence_sql()


# The checksum of bytes by its table of 256 remainders; {0} is a text.
CRC_TABLE = """crc_table(t) as (
  select list(v order by i) from (
    select i, list_reduce(range(0, 8), lambda v, k: case when v % 2 = 1 then xor(v // 2, 3988292384) else v // 2 end, i) as v
    from range(0, 256) r(i)) s)"""


def _crc_sql(text: str) -> str:
    size = f"octet_length(encode({text}))"
    return f"""xor(list_reduce(list_transform(range(0, {size}), lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::bigint),
      lambda a, b: xor(a // 256, t[xor(a % 256, b) + 1]), 4294967295::bigint), 4294967295)"""


def _sharding_sql(shards: int = 24, copies: int = sharding.COPIES) -> str:
    draw = lambda text: f"('0x' || substr(md5({text}), 1, {sharding.DIGITS}))::bigint"
    return f"""
with {CRC_TABLE},
sized as (
  select doc_id, octet_length(encode(coalesce(text, ''))) + {sharding.ROW_BYTES} as size, {_crc_sql("coalesce(text, '')")} as text_crc32,
    coalesce(length(doc_id::varchar) || ':' || doc_id, '-') as key
  from documents, crc_table),
draws as (
  select doc_id, key, i, {draw("key || '@' || i")} as draw
  from (select distinct doc_id, key from sized) k, range(0, {shards + 1}) r(i)),
won as (
  select key, arg_max(i, (draw, -i)) filter (i < {shards}) as shard, arg_max(i, (draw, -i)) as grown_shard from draws group by key),
pieces as (
  select *, (row_number() over (partition by key, size, text_crc32) - 1) // {copies} as piece from sized),
placed as (select *, {draw("key || '/' || size || '/' || text_crc32 || '/' || piece")} as place from pieces join won using (key))
select doc_id, size, text_crc32, '{sharding.LAW}' as law, shard::int as shard,
  row_number() over (partition by shard order by place, doc_id nulls first, size, text_crc32, piece) - 1 as slot,
  grown_shard::int as grown_shard
from placed"""


SQL["op13_sharding"] = _sharding_sql()

SQL["op11_prefix_trie"] = f"""
with {CRC_TABLE},
turns as (
  select conv_id, turn, coalesce(text, '') as text, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as id
  from conversations where conv_id is not null),
convs as (
  select conv_id, list(id order by turn nulls first, id) as ids, list(octet_length(encode(text)) order by turn nulls first, id) as lens
  from turns group by conv_id),
cuts as (select *, conv_id - ((conv_id % 5) + 5) % 5 as donor, {_crc_sql("conv_id::varchar")} % 9 as h from convs, crc_table),
rebuilt as (
  select c.conv_id, list_concat(coalesce(d.ids[1:c.h], []), c.ids[c.h + 1:]) as ids, list_concat(coalesce(d.lens[1:c.h], []), c.lens[c.h + 1:]) as lens
  from cuts c left join convs d on d.conv_id = c.donor),
prefixes as (
  select conv_id, depth, md5(array_to_string(ids[1:depth], ',')) as path, case when depth > 0 then lens[depth] else 0 end as bytes,
    depth = len(ids) as ends
  from (select *, unnest(range(0, len(ids) + 1)) as depth from rebuilt) r),
nodes as (
  select depth, path, min(conv_id) as conv_id, count(*) as n_convs, max(bytes) as bytes,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ends), '')) as ends_sha256
  from prefixes group by depth, path),
linked as (
  select n.*, u.path as up_path, m.conv_id as parent_conv_id from nodes n
  left join prefixes u on u.conv_id = n.conv_id and u.depth = n.depth - 1
  left join nodes m on m.depth = u.depth and m.path = u.path),
counted as (
  select l.*, coalesce(k.n, 0) as n_children from linked l
  left join (select depth, up_path, count(*) as n from linked group by depth, up_path) k on k.depth = l.depth + 1 and k.up_path = l.path),
below as (
  select p.depth, p.path, sum((v.n_convs - 1) * v.bytes) as saved_tokens, count(*) filter (v.n_children = 0) as n_leaves
  from counted v join prefixes p on p.conv_id = v.conv_id and p.depth <= v.depth group by p.depth, p.path)
select conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens::bigint as saved_tokens, ends_sha256
from counted join below using (depth, path)"""


def _repair_sql() -> str:
    """The same least edits by recursion over turns, with the whole list of edits at each place; then the edits carried out."""
    insert, bad = structure.INSERT, "{c: 1000000000, w: ''}"
    more = lambda s, cost, letters: f"{{c: {s}.c + {cost}, w: {s}.w || '{letters}'}}"
    least = lambda *options: f"list_min([{', '.join(options)}])"
    when = lambda test, option: f"case when {test} then {option} else {bad} end"
    keep = lambda s: more(s, "late", "K")
    rerole = lambda s: when("not must_go", more(s, f"late + {structure.REROLE}", "R"))
    delete = lambda s: more(s, structure.DELETE, "D")
    asks = ("p0", "p1", "b3")
    blank = "[^\\x20\\x09-\\x0D]"
    return f"""
with recursive {CRC_TABLE},
cases as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    {_crc_sql("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 as damage
  from conversations, crc_table),
damaged as (
  select conv_id, turn, case damage when 4 then 'user' else role end as role,
    case damage when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
    unnest(case damage when 3 then [0, 1] else [0] end) as copy
  from cases where damage <> 0),
ordered as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i from damaged),
seen as (select *, row_number() over (partition by conv_id, role, text order by i) as again from ordered),
marked as (
  select *, left(role, 1) as initial, lag(left(role, 1)) over (partition by conv_id order by i) as before,
    not regexp_matches(text, '{blank}') as blank,
    regexp_matches(text, '{blank}') and again > 1 as duplicate,
    regexp_matches(text, '{blank}') and again = 1 and not regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') as truncated
  from seen),
turns as (select *, blank or duplicate as must_go, case when truncated then {structure.TRUNCATED} else 0 end as late from marked),
best(conv_id, i, p0, p1, p2, p3) as (
  select distinct conv_id, 0::bigint, {{c: 0, w: ''}}, {bad}, {bad}, {bad} from conversations
  union all
  select b.conv_id, t.i,
    {delete("p0")},
    {least(when("not must_go and initial = 's'", keep("p0")), delete("p1"))},
    {least(*[when("not must_go and initial = 'u'", keep(s)) for s in asks], *[rerole(s) for s in asks], delete("b2"))},
    {least(when("not must_go and initial = 'a'", keep("b2")), rerole("b2"), delete("b3"))}
  from (
    select *, {least("p2", more("p0", insert, "I"), more("p1", insert, "I"), more("p3", insert, "I"))} as b2,
      {least("p3", more("p2", insert, "I"), more("p0", 2 * insert, "II"), more("p1", 2 * insert, "II"))} as b3
    from best) b
  join turns t on t.conv_id is not distinct from b.conv_id and t.i = b.i + 1),
lists as (
  select conv_id, i as n, {least("p0", "p3", more("p2", insert, "I"), more("p1", 2 * insert, "II"))} as won
  from (select *, row_number() over (partition by conv_id order by i desc) as back from best) b where back = 1),
edits(conv_id, k, i, place, lines) as (
  select conv_id, 0::bigint, 0::bigint, '', []::varchar[] from lists
  union all
  select e.conv_id, e.k + 1, e.i + (letter <> 'I')::int,
    case letter when 'D' then place when 'K' then t.initial else asked end,
    case letter when 'D' then lines when 'K' then list_append(lines, t.role || ':' || t.text)
      else list_append(lines, (case asked when 'u' then 'user' else 'assistant' end) || ':' || case letter when 'R' then t.text else '' end) end
  from (
    select e.*, won.w[k + 1] as letter, case place when 'u' then 'a' else 'u' end as asked
    from edits e join lists l on l.conv_id is not distinct from e.conv_id where k < length(won.w)) e
  left join turns t on t.conv_id is not distinct from e.conv_id and t.i = e.i + 1 and letter <> 'I'),
repaired as (
  select e.conv_id, lines from edits e join lists l on l.conv_id is not distinct from e.conv_id where k = length(won.w)),
counted as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (blank) as blank,
    count(*) filter (duplicate) as duplicate, count(*) filter (truncated) as truncated,
    count(*) filter (before is not null and before || initial not in ('su', 'ua', 'au')) as illegal
  from turns group by conv_id)
select l.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
  coalesce(illegal, 0) as illegal, won.c::bigint as cost, won.w as audit, sha256(array_to_string(lines, chr(10))) as repaired_sha256
from lists l left join counted c on c.conv_id is not distinct from l.conv_id join repaired r on r.conv_id is not distinct from l.conv_id"""


SQL["op12_structure_repair"] = _repair_sql()
