"""Registered queries of the training-data operators and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amendry.llm import (
    chat_format,
    decontaminate,
    embedding_dedup,
    html_extract,
    merkle,
    personal,
    pieces,
    quality,
    secret_scan,
    simhash,
    spelling,
    token_files,
    url_filter,
)
from amendry.sources.workspace import Workspace

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

SHINGLE, BITS = 4, 4


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op8_simhash_near_dedup(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return simhash.near_duplicates(docs, "doc_id", "text", SHINGLE, BITS)


@query
def op4_benchmark_decontamination(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.add_matches(docs, _table(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.array_sort(F.transform("item_ids", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id",
        "n_words",
        decontaminate.hit_words().alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
        "longest_match",
    )


@query
def op10_quality_classifier(spark, sf_dir):
    docs, labels = (_table(spark, sf_dir, t) for t in ("documents", "labels"))
    scored = quality.add_score(docs.select("doc_id", "text"), quality.fit(docs, labels))
    return scored.select(
        "doc_id",
        quality.held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= quality.CUT).cast("int").alias("predicted"),
    )


@query
def op3_secret_scans(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found, names = secret_scan.add_spans(docs), [r.name for r in secret_scan.RULES]
    counts = [secret_scan.count_of(F.col("spans"), k).alias(f"n_{name}") for k, name in enumerate(names)]
    listed = secret_scan.listed(F.col("spans"))
    return found.select("doc_id", *counts, F.sha2(listed, 256).alias("base_sha256"), listed.alias("spans"))


# the case of letters is spelt out, as (?i) would also take letters beyond ASCII there
_EITHER = lambda word: "".join(f"[{c.upper()}{c}]" for c in word)
_ASSIGN = (
    "(" + "|".join(map(_EITHER, ("password", "passwd", "secret", "token"))) + f"|{_EITHER('api')}_?{_EITHER('key')})"
    """["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
)


def _spans_sql(kind: str, turn: int, pattern: str, group: int, least: int) -> str:
    return f"""
    select doc_id, {turn} as turn, '{kind}' as kind, n_before + len(between[i]) as start,
           n_before + len(between[i]) + len(hits[i]) as stop
    from (select *, unnest(range(1, len(hits) + 1)) as i from
             (select doc_id, regexp_extract_all(t, '{pattern}', 0) as hits, regexp_extract_all(t, '{pattern}', {group}) as kept,
                     string_split_regex(t, '{pattern}') as between from docs)),
         lateral (select coalesce(list_sum(list_transform(between[:i - 1], lambda x: len(x))), 0)
                       + coalesce(list_sum(list_transform(hits[:i - 1], lambda x: len(x))), 0) as n_before)
    where len(kept[i]) >= {least}"""


ORACLES["op3_secret_scans"] = f"""
with docs as (select doc_id, coalesce(text, '') as t from documents),
spans as ({" union all ".join([
    _spans_sql("assign", 0, _ASSIGN, 2, 12),
    _spans_sql("access", 1, "AKIA[A-Z0-9]+", 0, 18),
    _spans_sql("hex", 2, "[0-9a-f]{16,}", 0, 16),
])}),
listed as (
    select doc_id, count(*) filter (turn = 0) as n_assign, count(*) filter (turn = 1) as n_access,
           count(*) filter (turn = 2) as n_hex,
           string_agg(kind || ':' || cast(cast(start as bigint) as varchar) || ':' || cast(cast(stop as bigint) as varchar), ','
                      order by start, turn) as spans
    from spans group by doc_id)
select d.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
       sha256(coalesce(spans, '')) as base_sha256, coalesce(spans, '') as spans
from docs d left join listed l on d.doc_id = l.doc_id"""


@query
def op5_token_files(spark, sf_dir):
    folder = Workspace(spark).path("tokens")
    docs = _table(spark, sf_dir, "documents")
    token_files.write(docs, folder, public_tokenizers.path("word_bpe_49k.json"), end=2)
    return token_files.read(spark, folder, digest=True)


@query
def op9_sentencepiece(spark, sf_dir):
    """Ids of every document, and whether the text decoded from them is the same again."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = pieces.add_ids(docs, public_tokenizers.path("piece_bpe_32k.model"), same="round_trip")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", "round_trip")


# fixed values: the rules of the URL filter, as host and path
URL_RULES = [
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
]


@query
def op7_url_filters(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    rules = spark.createDataFrame(URL_RULES, "rule string, verdict string")
    return url_filter.add_verdicts(pages, rules).select("page_id", "host", "path", "rule", "verdict")


ORACLES["op7_url_filters"] = f"""
with rules(rule, verdict) as (values {", ".join(map(str, URL_RULES))}),
split as (select rule, verdict, left(rule, position('/' in rule) - 1) as h, substr(rule, position('/' in rule)) as p from rules),
urls as (
    select page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
           coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') as path, row_number() over () as n
    from pages),
fits as (
    select n, arg_max(rule, length(rule)) as rule, arg_max(verdict, length(rule)) as verdict
    from urls join split on (host = h or ends_with(host, '.' || h)) and starts_with(path, p) group by n)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from urls left join fits using (n)"""


@query
def op2_embedding_near_dedup(spark, sf_dir):
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 0.95)


@query
def op1_html_extraction(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = html_extract.add_text(pages, "url", "html", "text", least=2, keep_page=False)
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query
def op6_chat_formatting(spark, sf_dir):
    return chat_format.rotate(_table(spark, sf_dir, "conversations"))


ORACLES["op6_chat_formatting"] = """
with t as (select conv_id, turn, coalesce(role, 'unknown') as s, coalesce(text, '') as x from conversations),
p as (select distinct conv_id, s as participant from t where s <> 'system'),
r as (select t.*, participant, row_number() over w - 1 as seq,
             case when s = 'system' then s when s = participant then 'assistant' else 'user' end as role,
             case when s <> 'system' and s <> participant then s end as name
      from t join p on t.conv_id is not distinct from p.conv_id
      window w as (partition by t.conv_id, participant order by turn)),
h as (select *, '<|im_start|>' || role || coalesce(' name=' || name, '') || chr(10) as head from r),
g as (select *, head || x || '<|im_end|>' || chr(10) as segment from h),
k as (select *, cast(sum(length(segment)) over (partition by conv_id, participant order by seq) as bigint) as stop from g)
select conv_id, participant, seq, role, name, segment, stop - length(segment) as start, stop,
       case when role = 'assistant' then stop - length(segment) + length(head) end as train_start,
       case when role = 'assistant' then stop - 11 end as train_stop
from k"""


@query
def op11_spelling_variants(spark, sf_dir):
    found = spelling.variants(_table(spark, sf_dir, "documents"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


@query
def op12_merkle_manifest(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    drawn = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.when(drawn, lowered).otherwise(F.col("text"))
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    found = merkle.add_proofs(docs, columns, altered={"text": tampered})
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.path_digest(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def _crc32_sql(codes: str) -> str:
    """CRC-32 of a list of bytes, bit by bit."""
    bits = ", ".join(["0"] * 8)
    step = f"list_reduce([xor(c, b), {bits}], lambda y, z: xor(y >> 1, (y & 1) * 3988292384))"
    return f"xor(list_reduce(list_concat([4294967295], {codes}), lambda c, b: {step}), 4294967295)"


def _leaf_sql(text: str) -> str:
    values = ("cast(doc_id as varchar)", "source", "lang", "cast(n_chars as varchar)", text)
    return "sha256(concat(" + ", ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + "))"


def _tree_sql(name: str, key: str, begin: str) -> str:
    return f"""
{name} as (
    {begin}
    union all
    select {key}, lvl + 1, pos // 16, sha256(string_agg(h, '' order by pos)), (n + 15) // 16
    from {name} where n > 1 group by {key}, lvl, pos // 16, n)"""


def _fold_sql(name: str, key: str, tree: str, begin: str) -> str:
    side = lambda test: f"coalesce(string_agg(t.h, '' order by t.pos) filter (t.pos {test} f.pos), '')"
    return f"""
{name} as (
    {begin}
    union all
    select f.d, f.{key}, f.lvl + 1, f.pos // 16, sha256({side('<')} || f.x || {side('>')}), f.proof || {side('<')} || {side('>')}
    from {name} f join {tree} t on f.{key} is not distinct from t.{key} and f.lvl = t.lvl and f.pos // 16 = t.pos // 16 and t.n > 1
    group by f.d, f.{key}, f.lvl, f.pos, f.x, f.proof)"""


ORACLES["op12_merkle_manifest"] = f"""
with recursive
drawn as (
    select *, {_crc32_sql("list_transform(string_split(cast(doc_id as varchar), ''), lambda d: cast(ascii(d) as bigint))")} % 5 = 0 as low
    from documents),
leaves as (
    select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as pos,
           count(*) over (partition by source) as n, row_number() over () as d
    from (select *, {_leaf_sql("text")} as leaf, {_leaf_sql(
        "(case when low then translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else text end)"
    )} as other from drawn)),
{_tree_sql("tree", "source", "select source, 0 as lvl, pos, leaf as h, n from leaves")},
subroots as (select source, h as subroot, row_number() over (order by source nulls first) - 1 as pos, count(*) over () as n, 0 as one
             from tree where n = 1),
{_tree_sql("top", "one", "select one, 0 as lvl, pos, subroot as h, n from subroots")},
{_fold_sql("inner_fold", "source", "tree", "select d, source, 0 as lvl, pos, other as x, '' as proof from leaves")},
grown as (select * from inner_fold qualify row_number() over (partition by d order by lvl desc) = 1),
{_fold_sql("outer_fold", "one", "top", "select d, one, 0 as lvl, s.pos, x, proof from grown f join subroots s on f.source is not distinct from s.source")},
done as (select * from outer_fold qualify row_number() over (partition by d order by lvl desc) = 1)
select doc_id, leaf, subroot, r.h as root, sha256(proof) as proof_sha256, x as folded_root, x = r.h as verified
from leaves l join done on l.d = done.d join subroots s on l.source is not distinct from s.source,
     (select h from top where n = 1) r"""


@query
def op13_personal_data(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = personal.add_spans(docs, personal.fit(docs))
    counts = [personal.count_of(F.col("spans"), k).alias(f"n_{name}") for k, name in enumerate(personal.KINDS)]
    base = F.sha2(personal.listed(F.col("spans"), base=True), 256)
    return found.select("doc_id", *counts, base.alias("base_sha256"), personal.listed(F.col("spans")).alias("spans"))


_RUN_BYTES = """flatten(list_transform(string_split(concat(doc_id, ':', run), ''),
    lambda c: case when unicode(c) < 128 then [cast(unicode(c) as bigint)] else [cast(195 as bigint), unicode(c) - 64] end))"""

ORACLES["op11_spelling_variants"] = f"""
with recursive
runs as (
    select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run, count(*) as k
    from (select doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) as run from documents) group by 1, 2),
hashed as (select run, k, {_crc32_sql(_RUN_BYTES)} as h from runs),
kept as (select k, case when h % 97 = 0 then left(run, cast(h % length(run) as int)) || substr(run, cast(h % length(run) as int) + 2)
                        else run end as word from hashed),
words as materialized (
    select word, cast(sum(k) as bigint) as n from kept where length(word) >= 5 group by word having sum(k) >= 3),
shorter as materialized (select distinct word, left(word, p - 1) || substr(word, p + 1) as less from
                         (select word, unnest(range(1, length(word) + 1)) as p from words)),
gaps as materialized (select word, p, left(word, p - 1) as a, substr(word, p + 1) as b from
                      (select word, unnest(range(1, length(word) + 1)) as p from words)),
pairs as (
    select word, less as other from shorter where less in (select word from words)
    union select less, word from shorter where less in (select word from words)
    union select x.word, y.word from gaps x join gaps y using (p, a, b) where x.word <> y.word),
near as (select p.word, other, w.n from pairs p join words w on w.word = p.other),
best as (select word, count(*) as n_near, first(other order by n desc, other) as form, max(n) as form_n from near group by word),
forms as materialized (
    select w.word, w.n, coalesce(n_near, 0) as n_near, case when form_n >= 2 * w.n then form end as form,
           case when form_n >= 2 * w.n then form_n end as form_n
    from words w left join best b on w.word = b.word),
ways as (
    select word, word as at, form as next from forms
    union all
    select ways.word, next, f.form from ways join forms f on f.word = next)
select word, f.form, ways.at as root, n, n_near, form_n from forms f join ways using (word) where next is null"""
