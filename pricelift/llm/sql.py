"""DuckDB SQL for the queries that SQL can state, written apart from the operators."""

from __future__ import annotations

from pricelift.llm.license_texts import KNOWN
from pricelift.llm.licenses import COPYRIGHT_LINES, SPELLINGS
from pricelift.llm.quality import STOP_WORDS


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

QUALITY_SQL = rf"""
with base as (
  select row_number() over () as r, doc_id, coalesce(text, '') as body, {_WORDS} as words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as lines
  from documents
), windows as (
  select r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] as w
  from (select r, words, unnest(range(1, len(words) - 1)) as i from base where len(words) >= 3)
), again as (
  select r, i from (select r, i, count(*) over (partition by r, w) as n from windows) where n > 1
), covered as (
  select r, count(*) as n from (select distinct r, i + k as place from again, (values (0), (1), (2)) as v(k)) group by r
), figures as (
  select doc_id, len(words) as n_words, length(array_to_string(words, '')) as word_chars,
         length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) as n_symbols,
         len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(n, 0) as n_repeat_words, len(lines) as n_lines,
         len(list_filter(words, lambda w: list_contains([{", ".join(map(_text, STOP_WORDS))}], lower(w)))) as n_stop_words
  from base left join covered using (r)
), judged as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from figures
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and word_chars / n_words between 2.0 and 15.0 and n_symbols / n_words <= 0.1
         and coalesce(n_dup_lines / nullif(n_lines, 0) <= 0.5, true) and n_stop_words >= 2 as kept,
       n_lines, n_stop_words
from judged
"""


def _canonical(text: str) -> str:
    out = f"regexp_replace(lower({text}), {_text(COPYRIGHT_LINES)}, ' ', 'g')"
    out = f"regexp_replace({out}, {_text(r'[\x00-\x2F\x3A-\x60\x7B-\x{BF}\x{2000}-\x{206F}]+')}, ' ', 'g')"
    for pattern, put in SPELLINGS:
        out = f"regexp_replace({out}, {_text(pattern)}, {_text(put)}, 'g')"
    return f"trim({out})"


_KNOWN_ROWS = ", ".join(f"({_text(name)}, {_text(body)})" for name, body in KNOWN.items())

LICENSE_SQL = f"""
with known as (
  select sha256({_canonical('body')}) as d, min(name) as license from (values {_KNOWN_ROWS}) as v(name, body) group by 1
), base as (
  select row_number() over () as r, doc_id, coalesce(text, '') as body from documents
), lines as (
  select distinct r, sha256({_canonical('line')}) as d
  from (select r, unnest(string_split(body, chr(10))) as line from base) where regexp_matches(line, '(?i)licen[sc]e')
), noticed as (
  select r, array_to_string(list_sort(list_distinct(list(license))), ',') as notices from lines join known using (d) group by r
), whole as (
  select r, doc_id, case when f <> '' then sha256(f) end as text_digest from (select r, doc_id, {_canonical('body')} as f from base)
)
select doc_id, text_digest, license, coalesce(notices, '') as notices
from whole left join known on text_digest = known.d left join noticed using (r)
"""

_JUMP = 2862933555777941757

SHARDING_SQL = f"""
with recursive jumps as (
  select doc_id, n, (case when doc_id < 0 then doc_id::hugeint + 18446744073709551616::hugeint else coalesce(doc_id, 0) end)::uhugeint as k,
         -1::bigint as b, 0::bigint as j
  from (select distinct doc_id from documents), (values (24), (25)) as v(n)
  union all
  select doc_id, n, k2, j, floor((j + 1) * (2147483648.0::double / ((k2 // 8589934592::uhugeint) + 1)::double))::bigint
  from (select *, (k * {_JUMP}::uhugeint + 1::uhugeint) % 18446744073709551616::uhugeint as k2 from jumps where j < n)
), settled as (
  select doc_id, max(case when n = 24 then b end)::int as shard, max(case when n = 25 then b end)::int as grown_shard
  from jumps where j >= n group by doc_id
), crc_table as (
  select list(c order by i) as t from (
    select i, list_reduce(list_prepend(i, range(8)), lambda c, x: xor(c >> 1, (c & 1) * 3988292384)) as c from (select unnest(range(256)) as i))
), sized as (
  select doc_id, octet_length(encode(coalesce(text, ''))) + 8 as size,
         xor(list_reduce(
           list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::bigint)),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) as text_crc32,
         coalesce(xor(list_reduce(
           list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(doc_id::varchar)), '..'), lambda x: ('0x' || x)::bigint)),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295), 0) as key_crc32
  from documents, crc_table
)
select sized.doc_id, size, text_crc32, 'key' as law, shard,
       row_number() over (partition by shard order by (key_crc32 + text_crc32) % 4096, sized.doc_id nulls first, text_crc32, size) - 1 as slot,
       grown_shard
from sized join settled on sized.doc_id is not distinct from settled.doc_id
"""

def _field(value: str) -> str:
    return f"coalesce(octet_length(encode({value}))::varchar || ':' || {value}, '-')"


def _leaf(n_chars: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id::varchar', 'source', 'lang', f'({n_chars})::varchar', 'text')))})"


MERKLE_SQL = f"""
with recursive crc_table as (
  select list(c order by i) as t from (
    select i, list_reduce(list_prepend(i, range(8)), lambda c, x: xor(c >> 1, (c & 1) * 3988292384)) as c from (select unnest(range(256)) as i))
), leaves as (
  select doc_id, coalesce('+' || lang, '') as tree, {_leaf('n_chars')} as leaf, {_leaf('n_chars + 1')} as changed,
         xor(list_reduce(
           list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(doc_id::varchar)), '..'), lambda x: ('0x' || x)::bigint)),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 7 = 0 as touched
  from documents, crc_table
), placed as (
  select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as pos from leaves
), nodes as (
  select tree, 0 as level, pos, leaf as d from placed
  union all
  select tree, level + 1, pos // 2, sha256(string_agg(d, '' order by pos))
  from (select *, count(*) over (partition by tree) as n from nodes) where n > 1 group by tree, level, pos // 2
), heights as (
  select tree, max(level) as h from nodes group by tree
), subroots as (
  select tree, d as subroot, row_number() over (order by tree) - 1 as pos from nodes join heights using (tree) where level = h
), upper as (
  select 0 as level, pos, subroot as d from subroots
  union all
  select level + 1, pos // 2, sha256(string_agg(d, '' order by pos)) from (select *, count(*) over () as n from upper) where n > 1 group by level, pos // 2
), top as (
  select level as h, d as root from upper where level = (select max(level) from upper)
), beside as (
  select p.tree, p.pos, l.level, case when s.d is null then '-' when s.pos % 2 = 0 then 'L' || s.d else 'R' || s.d end as step
  from (select tree, pos, h from placed join heights using (tree)) p, unnest(range(h)) as l(level)
  left join nodes s on s.tree = p.tree and s.level = l.level and s.pos = xor(p.pos >> l.level::int, 1)
), beside_upper as (
  select r.tree, l.level, case when s.d is null then '-' when s.pos % 2 = 0 then 'L' || s.d else 'R' || s.d end as step
  from (select tree, pos, h from subroots, top) r, unnest(range(h)) as l(level)
  left join upper s on s.level = l.level and s.pos = xor(r.pos >> l.level::int, 1)
), ways as (
  select tree, pos, list(step order by level) as steps from beside group by tree, pos
), upper_ways as (
  select tree, list(step order by level) as steps from beside_upper group by tree
), joined as (
  select doc_id, leaf, subroot, root, case when touched then changed else leaf end as claimed, coalesce(w.steps, []) || coalesce(u.steps, []) as steps
  from placed join subroots using (tree) cross join top left join ways w on w.tree = placed.tree and w.pos = placed.pos
  left join upper_ways u on u.tree = placed.tree
), folded as (
  select *, list_reduce(list_prepend(claimed, steps), lambda a, s: case
    when s = '-' then sha256(a) when s[1] = 'L' then sha256(s[2:] || a) else sha256(a || s[2:]) end) as folded_root from joined
)
select doc_id, leaf, subroot, root,
       sha256(array_to_string(list_transform(list_filter(steps, lambda s: s <> '-'), lambda s: s[2:]), '')) as proof_sha256,
       folded_root, folded_root = root as verified
from folded
"""

WARC_SQL = """
with sized as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages
), marked as (
  select *, max(page_id) over (partition by payload_digest) as original from sized
)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes >= 1000 and page_id <> original then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 1000 and page_id <> original then original end as refers_to
from marked
"""

#: Not registered: sums of doubles in another order differ in the last places.  The tests compare with a tolerance.
ANN_SQL = """
with v as (
  select vec_id, embedding::double[] as e from embeddings
  where embedding is not null and vec_id is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs as (
  select q.vec_id as query_id, c.vec_id, list_cosine_similarity(q.e, c.e) as score
  from v q join v c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id and len(q.e) = len(c.e)
)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score
from pairs qualify rank <= 5
"""
