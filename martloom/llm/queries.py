"""The operators over the driver's tables, each next to its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import langid, toxicity
from martloom.llm.common import Scratch, crc_mod, table, words
from martloom.llm.line_dedup import drop_spread_lines
from martloom.llm.mixing import mix
from martloom.llm.neighbours import nearest_neighbours
from martloom.llm.packing import pack
from martloom.llm.pieces import encode_texts
from martloom.llm.quality import judge_quality
from martloom.llm.ranked import build_index, search
from martloom.llm.runs import periodic_runs, plant_runs, strongest_run
from martloom.llm.simhash import simhash_groups
from martloom.llm.substrings import drop_repeats
from martloom.llm.warc import warc_round_trip

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def vocabulary_path() -> str:
    """The installed public vocabulary with byte pieces; operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def tokenizer_path() -> str:
    """The installed public BPE vocabulary with word ends; operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op1_nearest_neighbours")
def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), every=20, k=20)


@query("op2_language_id")
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), vocabulary_path()
    model = langid.fit(docs, path)
    rows = docs.select("doc_id", "text", (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"))
    found = langid.predict_language(rows, model, path)
    return found.select("doc_id", F.coalesce("held_out", F.lit(False)).alias("held_out"), "lang_pred", "score")


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    rows = docs.select("doc_id", "text", (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"))
    return toxicity.score_toxicity(rows, model).select(
        "doc_id", F.coalesce("held_out", F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def _level_sql(rows: str, weight: str, order: str) -> str:
    """c_<rows>: the factor that keeps 0.8 of all tokens if no row keeps more than it has, from rows in order of rate."""
    return f"""f_{rows} as (
  select *, (0.8 * sum(tokens) over () - coalesce(sum(tokens) over before, 0))
            / (sum({weight}) over () - coalesce(sum({weight}) over before, 0)) as c
  from {rows}
  window before as (order by {weight} / tokens desc, {order} rows between unbounded preceding and 1 preceding)),
c_{rows} as (select max(c) filter (c * {weight} / tokens < 1) as c from f_{rows})"""


def _mix_sql(rounds: int = 12) -> str:
    """The same bounded raking, one common table per step."""
    steps, last = [], "goals"
    for i in range(3 * rounds):
        k = i % 3
        steps.append(
            f"r{i} as (select * replace (least(cast(tokens as double), w * g{k} / sum(w) over (partition by k{k})) as w) from {last})"
        )
        last = f"r{i}"
    goal = [
        f"""m{k} as (select k{k}, sum(tokens) as tokens, pow(cast(sum(tokens) as double), 0.7) as r from cells group by k{k}),
{_level_sql(f"m{k}", "r", f"k{k}")},
t{k} as (select k{k}, least(cast(tokens as double), c * r) as g from m{k}, c_m{k})"""
        for k in range(3)
    ]
    return rf"""
with d as (
  select doc_id, source as k0, lang as k1,
         case when contains(t, ' | ') then 'table' when contains(t, 'icense') then 'legal'
              when contains(t, '@') then 'contact'
              when contains(t, '***') or contains(t, '$$$') or contains(t, '!!') then 'noisy'
              else 'prose' end as k2,
         len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) as tokens
  from (select *, coalesce(text, '') as t from documents)),
cells as (select k0, k1, k2, sum(tokens) as tokens from d group by all having sum(tokens) > 0),
{", ".join(goal)},
goals as (
  select c.k0, c.k1, c.k2, c.tokens, c.tokens * 0.8 as w, t0.g as g0, t1.g as g1, t2.g as g2
  from cells c join t0 on c.k0 is not distinct from t0.k0 join t1 on c.k1 is not distinct from t1.k1
       join t2 on c.k2 is not distinct from t2.k2),
{", ".join(steps)},
{_level_sql(last, "w", "k0, k1, k2")},
p as (
  select k0, k1, k2, round(least(1.0, c * w / tokens), 9) as p from {last}, c_{last})
select doc_id, d.k0 as source, d.k1 as lang, d.k2 as topic, cast(d.tokens as bigint) as n_tokens,
       coalesce(p, 1.0) as probability,
       coalesce(p, 1.0) >= 1 or cast('0x' || substr(md5('mix:' || coalesce(cast(doc_id as varchar), 'null')), 1, 12) as bigint)
         / 281474976710656.0 < p as kept
from d left join p on d.k0 is not distinct from p.k0 and d.k1 is not distinct from p.k1 and d.k2 = p.k2
"""


@query("op4_mix_sources", _mix_sql())
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), bounded=True).select(
        "doc_id", "source", "lang", "topic", "n_tokens", "probability", "kept"
    )


@query("op5_sentencepiece")
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_texts(rows, vocabulary_path()).drop("text")


QUALITY_SQL = r"""
with w as (
  select doc_id, lang, source, coalesce(text, '') as t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l
  from documents),
windows as (
  select doc_id, i, count(*) over (partition by doc_id, w[i], w[i + 1], w[i + 2]) as times
  from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from w)),
covered as (
  select doc_id, count(distinct i + k) as n
  from (select doc_id, i, unnest([0, 1, 2]) as k from windows where times > 1) group by doc_id),
base as (
  select w.doc_id, lang, source, cast(len(w) as bigint) as n_words,
         cast(length(array_to_string(w, '')) as bigint) as word_chars,
         cast(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
         cast(len(l) as bigint) as n_lines,
         cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines,
         cast(coalesce(c.n, 0) as bigint) as n_repeat_words
  from w left join covered c on c.doc_id = w.doc_id),
judged as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from base),
v as (
  select doc_id, lang, source, m, v from (
    select doc_id, lang, source, unnest([
      {'m': 'symbols', 'v': 10000 * n_symbols // word_chars},
      {'m': 'dup_lines', 'v': 10000 * n_dup_lines // n_lines},
      {'m': 'repeats', 'v': 10000 * n_repeat_words // n_words},
      {'m': 'word_length', 'v': 100 * word_chars // n_words}], recursive := true)
    from judged where not base_failed)),
b as (
  select lang, source, m, case when v < 256 then 0 else length(bin(v)) - 8 end as shift, (v >> shift) << shift as bin,
         bin + (1::bigint << shift) - 1 as last
  from v),
own as (
  select lang, source, m, max(total) as n, max(filled) as filled,
         min(bin) filter (4 * upto >= total) as q1, min(last) filter (4 * upto >= 3 * total) as q3,
         min(last) filter (20 * upto >= 19 * total) as tail,
         min(bin) filter (bin > 0 and 4 * (upto - total + filled) >= filled) as low
  from (select *, count(*) over g as total, count(*) filter (bin > 0) over g as filled, count(*) over (g order by bin) as upto
        from b window g as (partition by lang, source, m))
  group by all),
wide as (
  select lang, m, max(total) as n, max(filled) as filled,
         min(bin) filter (4 * upto >= total) as q1, min(last) filter (4 * upto >= 3 * total) as q3,
         min(last) filter (20 * upto >= 19 * total) as tail,
         min(bin) filter (bin > 0 and 4 * (upto - total + filled) >= filled) as low
  from (select *, count(*) over g as total, count(*) filter (bin > 0) over g as filled, count(*) over (g order by bin) as upto
        from b window g as (partition by lang, m))
  group by all),
both_limits as (
  select *, case when m = 'word_length' then q3 + 3 * (q3 - q1)
                 else greatest(q3 + 3 * greatest(q3 - q1, least(low, 20 * low * filled // n)), tail) end as hi,
         greatest(q1 - 3 * (q3 - q1), 0) as lo
  from (select 1 as level, * from own union all by name select 0 as level, * from wide)),
limits as (
  select o.lang, o.source, o.m, (o.n * o.hi + 100 * w.hi) // (o.n + 100) as hi, (o.n * o.lo + 100 * w.lo) // (o.n + 100) as lo
  from both_limits o join both_limits w on o.level = 1 and w.level = 0 and o.lang is not distinct from w.lang and o.m = w.m),
bad as (
  select distinct v.doc_id from v join limits t
    on v.lang is not distinct from t.lang and v.source is not distinct from t.source and v.m = t.m
  where v.v > t.hi or (v.m = 'word_length' and v.v < t.lo))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and doc_id not in (select doc_id from bad) as kept
from judged
"""


@query("op6_quality_rules", QUALITY_SQL)
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(table(spark, sf_dir, "documents"))


@query("op7_simhash_dedup")
def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


LINES_SQL = r"""
with l as (
  select doc_id, source, text, unnest(string_split(text, chr(10))) as raw,
         unnest(range(len(string_split(text, chr(10))))) as pos
  from documents where text is not null),
t as (select *, trim(raw, ' ' || chr(9) || chr(13) || chr(12) || chr(11)) as line from l),
k as (
  select doc_id, pos, line from t
  where line <> ''),
s as (
  select k.line, min((k.doc_id, k.pos)) as first
  from k join documents d on d.doc_id = k.doc_id
  group by k.line having count(distinct d.source) >= 10),
gone as (
  select k.doc_id, k.pos from k join s on s.line = k.line where (k.doc_id, k.pos) <> s.first),
kept as (
  select t.doc_id, string_agg(t.raw, chr(10) order by t.pos) filter (g.pos is null) as text,
         count(g.pos) as n_removed
  from t left join gone g on g.doc_id = t.doc_id and g.pos = t.pos group by t.doc_id)
select d.doc_id, case when d.text is null then null else coalesce(k.text, '') end as text,
       coalesce(k.n_removed, 0) as n_removed
from documents d left join kept k on k.doc_id = d.doc_id
"""


@query("op10_line_dedup", LINES_SQL)
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_spread_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_removed")


@query("op8_suffix_dedup")
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeats(table(spark, sf_dir, "documents"), with_kept=False).drop("kept")


WARC_SQL = r"""
with p as (
  select page_id, coalesce(html, '') as html, cast(strlen(coalesce(html, '')) as bigint) as n from pages),
best as (select html, max(page_id) as best from p where n >= 1000 group by html),
r as (select p.*, best.best from p left join best on best.html = p.html and p.n >= 1000)
select page_id, n as payload_bytes, sha1(html) as payload_digest,
       case when best is null or best = page_id then 'response' else 'revisit' end as record_type,
       case when best <> page_id then best end as refers_to
from r
"""


@query("op9_warc_archive", WARC_SQL)
def op9_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Scratch(spark, "warc").root
    return warc_round_trip(table(spark, sf_dir, "pages"), path)


RANKED_SQL = r"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
  from documents),
whole as (
  select cast(count(*) as bigint) as docs, cast(sum(len(terms)) as bigint) as terms from d where len(terms) > 0),
norms as (
  select doc_id, 75 + (25 * cast(len(d.terms) as bigint) * whole.docs) // whole.terms as m from d, whole where len(d.terms) > 0),
tf as (select doc_id, term, count(*) as tf from (select doc_id, unnest(terms) as term from d) group by all),
df as (select term, count(*) as df from tf group by term),
asked as (
  select item_id, term, count(*) as times from (
    select item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from benchmark)
  group by all),
weighed as (
  select item_id, term, times * cast(floor(1000 * ln(cast(2 * docs + 2 as double) / (2 * df + 1))) as bigint) as w
  from asked join df using (term), whole),
scored as (
  select item_id, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m))) as bigint) as score
  from weighed join tf using (term) join norms using (doc_id) group by all),
ranked as (
  select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scored where score > 0)
select item_id, cast(rank as integer) as rank, doc_id, score from ranked where rank <= 20
"""


@query("op11_ranked_search", RANKED_SQL)
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = Scratch(spark, "index").write(build_index(table(spark, sf_dir, "documents")))
    return search(index, table(spark, sf_dir, "benchmark"), k=20)


@query("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    mark = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    found = periodic_runs(plant_runs(docs, "text", words(F.col("text")), mark))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = F.col("best")
    return found.withColumn("best", strongest_run(F.col("runs"))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query("op13_pack_sequences")
def op13_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False)
