"""One query per operator over the whole driver tables, with its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from reviewlens.llm import (
    bpe,
    chat,
    dedup,
    language,
    licenses,
    mixing,
    quality,
    rules,
    sharding,
    similarity,
    spelling,
    toxicity,
    trie,
)
from reviewlens.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = 24
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
# The conversation that op6 adds.
ADDED_CONVERSATION = -7
ADDED_TEXT = "\\### Assistant: </turn> ok"


def op1_exact_dedup(spark, sf):
    return dedup.exact_duplicates(table(spark, sf, "documents"))


def op2_mixing(spark, sf):
    return mixing.mix_sources(table(spark, sf, "documents"))


def op3_license_scan(spark, sf):
    return licenses.scan_licenses(table(spark, sf, "documents")).drop("spans")


def op4_bpe(spark, sf):
    return bpe.encoding_digests(table(spark, sf, "documents"), TOKENIZER)


def op5_toxicity(spark, sf):
    docs = table(spark, sf, "documents")
    return toxicity.score_toxicity(docs, toxicity.fit(docs, table(spark, sf, "labels")))


def op6_chat_formatting(spark, sf):
    said = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame(
        [(ADDED_CONVERSATION, i, r, ADDED_TEXT) for i, r in enumerate(("user", "assistant"))],
        "conv_id bigint, turn bigint, role string, text string",
    )
    return chat.conversation_digests(said.unionByName(added)).drop("rewrites")


def op7_sharding(spark, sf):
    return sharding.assign_shards(table(spark, sf, "documents"), [1.0] * SHARDS)


def op8_jaccard_join(spark, sf):
    return similarity.similar_components(table(spark, sf, "documents"))


def op9_quality_classifier(spark, sf):
    return quality.classify_quality(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op10_quality_rules(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    return rules.compression_rules(docs, labels=labels)


def op11_prefix_trie(spark, sf):
    return trie.prefix_trie(table(spark, sf, "conversations"), group=5, most=9)


def op12_language_id(spark, sf):
    return language.identify_languages(table(spark, sf, "documents"))


def op13_spelling_groups(spark, sf):
    return spelling.spelling_groups(table(spark, sf, "documents"), every=31)


def _crc32(text: str) -> str:
    """SQL for the unsigned crc32 of a text, bit by bit."""
    octets = (
        f"list_transform(range(0, octet_length(encode({text}))), "
        f"lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::bigint)"
    )
    # Eight steps for each byte; the zeros only count them.
    byte = (
        "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], "
        "lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    )
    return f"xor(list_reduce(list_prepend(4294967295, {octets}), lambda c, b: {byte}), 4294967295)"


QUERIES: dict[str, Query] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_mixing": op2_mixing,
    "op3_license_scan": op3_license_scan,
    "op4_bpe": op4_bpe,
    "op5_toxicity": op5_toxicity,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_sharding": op7_sharding,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_quality_rules": op10_quality_rules,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_language_id": op12_language_id,
    "op13_spelling_groups": op13_spelling_groups,
}

ORACLES: dict[str, str] = {
    "op1_exact_dedup": r"""
select doc_id, min(doc_id) over same as keep_id, count(*) over same as group_size,
  doc_id = min(doc_id) over same as kept, sha256(body) as text_sha256
from (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as body
  from documents
)
window same as (partition by body)
""",
    "op2_mixing": r"""
with docs as (
  select doc_id, source, coalesce(text, '') as body from documents
), sized as (
  select doc_id, source,
    len(regexp_extract_all(body, '[^\x20\x09-\x0D]+')) as size,
    -ln((('0x' || substr(md5(coalesce(doc_id::varchar, 'null') || ':mix'), 1, 13))::bigint::double + 0.5)
        / 4503599627370496.0)
      / greatest(0.05, length(regexp_replace(body, '[^\pL]+', '', 'g'))::double
                       / greatest(length(body), 1)) as k
  from docs
), sources as (
  select source, sum(size)::bigint as source_size from sized group by source
), ranked as (
  select *, [3, 1, 2][((row_number() over (order by source nulls last)) - 1) % 3 + 1] as weight,
    2 * source_size as cap
  from sources
), levels as (
  select *, row_number() over fill as place,
    (1.5 * sum(source_size) over () - (sum(cap) over fill - cap))
      / sum(weight) over (fill rows between current row and unbounded following) as level
  from ranked window fill as (order by cap / weight, source nulls last)
), common as (
  select arg_min(level, place) as level from levels where level * weight <= cap
), targets as (
  select source, source_size, least(common.level * weight, cap::double) as target
  from levels, common
), placed as (
  select d.doc_id, d.size, t.source_size, t.target,
    case when t.source_size = 0 then 0
         else floor(floor(t.target) / t.source_size)::bigint end as turns,
    (sum(d.size) over (partition by d.source order by k, d.doc_id, d.size
                       rows unbounded preceding) - d.size)::bigint as before
  from sized d join targets t on d.source is not distinct from t.source
)
select doc_id, size::bigint as size, source_size, target,
  (turns * size + greatest(0, least(size,
     floor(target)::bigint - turns * source_size - before)))::bigint as taken
from placed
""",
    "op11_prefix_trie": rf"""
with said as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id
      order by turn nulls first, coalesce(role, ''), coalesce(text, '')) - 1 as place
  from conversations
), ids as (
  select conv_id, conv_id - conv_id % 5 as first, {_crc32("conv_id::varchar")} % 9 as h
  from (select distinct conv_id from said)
), rebuilt as (
  select i.conv_id, 0 as part, s.place, s.role, s.text
  from ids i join said s on s.conv_id = i.first and s.place < i.h
  union all
  select i.conv_id, 1, s.place, s.role, s.text
  from ids i join said s on s.conv_id = i.conv_id and s.place >= i.h
), convs as (
  select i.conv_id, coalesce(list({{'role': r.role, 'text': r.text}} order by part, place)
                             filter (where r.conv_id is not null), []) as turns
  from ids i left join rebuilt r on r.conv_id = i.conv_id group by i.conv_id
), members as (
  select conv_id, depth, turns[1:depth] as prefix, depth = len(turns) as ends
  from (select conv_id, turns, unnest(range(0, len(turns) + 1)) as depth from convs)
), nodes as (
  select prefix, depth, min(conv_id) as conv_id, count(*) as n_convs,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where ends), ''))
      as ends_sha256,
    case when depth = 0 then 0
         else (count(*) - 1) * octet_length(encode(prefix[depth].text)) end as saved
  from members group by prefix, depth
), children as (
  select k.prefix[1:k.depth - 1] as prefix, count(*) as n_children
  from nodes k where k.depth > 0 group by 1
), subtrees as (
  select u.prefix[1:k] as prefix, sum(u.saved) as saved_tokens,
    count(*) filter (where c.n_children is null) as n_leaves
  from (select prefix, saved, unnest(range(0, depth + 1)) as k from nodes) u
    left join children c on c.prefix = u.prefix
  group by 1
)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs,
  coalesce(c.n_children, 0)::bigint as n_children, s.n_leaves,
  s.saved_tokens::bigint as saved_tokens, n.ends_sha256
from nodes n join subtrees s on s.prefix = n.prefix
  left join children c on c.prefix = n.prefix
  left join nodes p on p.depth = n.depth - 1 and p.prefix = n.prefix[1:n.depth - 1]
""",
    "op13_spelling_groups": rf"""
with recursive runs as (
  select doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) as run from documents
), lowered as (
  select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run
  from runs
), counted as (
  select doc_id, run, count(*) as n from lowered where length(run) >= 7 group by doc_id, run
), hashed as (
  select run, n, {_crc32("coalesce(doc_id::varchar, '') || ':' || run")} as h from counted
), words as (
  select case when h % 31 = 0 then run[:h % length(run)] || run[h % length(run) + 2:]
              else run end as word, n
  from hashed
), vocabulary as (
  select word, sum(n)::bigint as n from words where length(word) >= 7
  group by word having sum(n) >= 2
), places as (
  select word, n, unnest(range(1, length(word) + 1)) as i from vocabulary
), shorter as (
  select distinct word, n, word[:i - 1] || word[i + 1:] as edit from places
), masked as (
  select word, n, word[:i - 1] || '*' || word[i + 1:] as edit from places
), near as (
  select a.word, b.word as other, b.n as other_n
  from masked a join masked b on a.edit = b.edit and a.word <> b.word
  union all select s.word, v.word, v.n from shorter s join vocabulary v on v.word = s.edit
  union all select v.word, s.word, s.n from shorter s join vocabulary v on v.word = s.edit
), best as (
  select word, count(*) as n_near, min({{'less': -other_n, 'other': other}}) as first
  from near group by word
), forms as (
  select v.word, v.n, coalesce(b.n_near, 0) as n_near,
    case when -b.first.less >= 10 * v.n then b.first.other end as form,
    case when -b.first.less >= 10 * v.n then -b.first.less end as form_n
  from vocabulary v left join best b on b.word = v.word
), paths as (
  select word, word as root from forms
  union all
  select p.word, f.form from paths p join forms f on f.word = p.root where f.form is not null
)
select f.word, f.n, f.n_near, f.form, f.form_n, p.root
from forms f join paths p on p.word = f.word
  join forms last on last.word = p.root and last.form is null
""",
}
