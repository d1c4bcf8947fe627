"""DuckDB SQL of operators that SQL can express (set joins, string matching, the trie and the repair's search)."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

#: One row with the 256 entries of CRC-32's table, from its polynomial.
_CRC_TABLE = """crc_table as (
  select list_transform(range(256), lambda b: list_reduce(list_prepend(b, [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))) as crc_of_byte
)"""


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text; ``crc_table`` must be among the tables."""
    return f"""xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(1, length({text}) + 1), lambda i: ascii(substr({text}, i, 1))::bigint)),
      lambda acc, b: xor(acc >> 8, crc_of_byte[(xor(acc, b) & 255) + 1])), 4294967295)"""


OP2 = rf"""
    with recursive w as (
      select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') as words from documents
    ), sets as (
      select doc_id, case
        when len(words) >= 3 then list_distinct(list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]))
        when len(words) > 0 then [array_to_string(words, ' ')] else [] end as shingles
      from w
    ), flat as (
      select doc_id, len(shingles) as n, unnest(shingles) as shingle from sets
    ), links as (
      select a.doc_id as a, b.doc_id as b from flat a join flat b on a.shingle = b.shingle and a.doc_id < b.doc_id
      group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 90 * (a.n + b.n - count(*))
    ), both_ways as (
      select a, b from links union all select b, a from links
    ), reach as (
      select doc_id as a, doc_id as b from documents
      union select r.a, l.b from reach r join both_ways l on r.b = l.a
    ), least as (
      select a, min(b) as component_id from reach group by a
    )
    select doc_id, len(shingles) as n_shingles, component_id from sets join least on doc_id = a
"""

OP4 = """
    with h as (
      select doc_id, hex(encode(coalesce(text, ''))) as bytes from documents
    ), n as (
      select doc_id, bytes, length(bytes) // 2 as n_bytes from h
    ), stretches as (
      -- 200 first bytes and what their windows need beyond
      select doc_id, k, substr(bytes, 400 * k + 1, 498) as stretch from (select *, unnest(range((n_bytes + 150) // 200)) as k from n where n_bytes >= 50)
    ), windows as (
      select doc_id, 200 * k + i as pos, i, stretch from (select *, unnest(range(1, least(200, length(stretch) // 2 - 49) + 1)) as i from stretches)
    ), strings as (
      select doc_id, pos, substr(stretch, 2 * i - 1, 100) as string from windows
    ), firsts as (
      select string, min(doc_id) as first_doc from strings group by string
    ), hits as (
      select s.doc_id, s.pos from strings s join firsts f on s.string = f.string and f.first_doc < s.doc_id
    ), runs as (
      -- a hit begins a run of removed bytes if the hit before it ends more than one byte earlier
      select doc_id, pos, sum(case when pos - before <= 50 then 0 else 1 end) over (partition by doc_id order by pos) as run
      from (select doc_id, pos, lag(pos, 1, -1000) over (partition by doc_id order by pos) as before from hits)
    ), spans as (
      select doc_id, run, min(pos) as first_byte, max(pos) + 49 as last_byte from runs group by doc_id, run
    ), pieces as (
      select n.doc_id, s.run, substr(bytes, 2 * (lag(last_byte, 1, 0) over w) + 1, 2 * (first_byte - 1 - lag(last_byte, 1, 0) over w)) as piece
      from n join spans s on n.doc_id = s.doc_id window w as (partition by n.doc_id order by run)
    ), removed as (
      select doc_id, sum(last_byte - first_byte + 1)::bigint as n_removed, count(*) as n_spans, max(last_byte) as last_byte from spans group by doc_id
    ), heads as (
      select doc_id, string_agg(piece, '' order by run) as head from pieces group by doc_id
    )
    select n.doc_id, n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
      sha256(unhex(coalesce(head, '') || substr(bytes, 2 * coalesce(last_byte, 0) + 1))) as kept_sha256
    from n left join removed r on n.doc_id = r.doc_id left join heads on n.doc_id = heads.doc_id
"""

OP11 = rf"""
    with {_CRC_TABLE}, turns as (
      select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
        row_number() over (partition by conv_id order by turn nulls first, role, text) as pos
      from conversations where conv_id is not null
    ), ids as (
      select conv_id, conv_id - conv_id % 20 as base, {_crc32("conv_id::varchar")} % 4 as h
      from (select distinct conv_id from turns), crc_table
    ), rebuilt as (
      select i.conv_id, 0 as part, t.pos, t.role, t.text from ids i join turns t on t.conv_id = i.base and t.pos <= i.h
      union all select i.conv_id, 1, t.pos, t.role, t.text from ids i join turns t on t.conv_id = i.conv_id and t.pos > i.h
    ), steps as (
      select conv_id, row_number() over (partition by conv_id order by part, pos) as depth, md5(length(role) || ':' || role || text) as step,
        len(regexp_extract_all(text, '{WORD}')) as words
      from rebuilt
    ), prefixes as (
      select conv_id, depth, words, string_agg(step, '') over (partition by conv_id order by depth) as key from steps
      union all select conv_id, 0, 0, '' from ids
    ), nodes as (
      select key, depth, min(conv_id) as conv_id, count(*) as n_convs, max(words) as words from prefixes group by key, depth
    ), children as (
      select left(key, 32 * (depth - 1)::int) as key, count(*) as n_children from nodes where depth > 0 group by 1
    ), each as (
      select n.*, coalesce(n_children, 0) as n_children from nodes n left join children c on n.key = c.key
    ), above as (
      select left(key, 32 * k::int) as key, case when n_children = 0 then 1 else 0 end as leaf, (n_convs - 1) * words as saved
      from (select *, unnest(range(depth + 1)) as k from each)
    ), subtrees as (
      select key, sum(leaf)::bigint as n_leaves, sum(saved)::bigint as saved_tokens from above group by key
    ), ends as (
      select key, sha256(string_agg(conv_id::varchar, ',' order by conv_id)) as ends_sha256
      from (select conv_id, max_by(key, depth) as key from prefixes group by conv_id) group by key
    )
    select e.conv_id, e.depth, p.conv_id as parent_conv_id, e.n_convs, e.n_children, s.n_leaves, s.saved_tokens,
      coalesce(ends_sha256, sha256('')) as ends_sha256
    from each e join subtrees s on e.key = s.key left join nodes p on e.depth > 0 and p.key = left(e.key, 32 * (e.depth - 1)::int)
      left join ends on e.key = ends.key
"""

# states: 0 nothing yet, 1 after the system's turn, 2 after a user's, 3 after an assistant's
OP13 = rf"""
    with recursive {_CRC_TABLE}, raw as (
      select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
        coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as name
      from conversations
    ), kinds as (
      select *, {_crc32("name")} % 20 as kind from raw, crc_table
    ), damaged as (
      select conv_id, turn, case when kind = 4 then 'user' else role end as role,
        case kind when 1 then '' when 2 then translate(text, '.!?', '') else text end as text
      from (select * from kinds where kind <> 0 union all select * from kinds where kind = 3)
    ), seen as (
      select *, row_number() over (partition by conv_id, role, text order by turn nulls first) > 1 as again from damaged
    ), marked as (
      select *, row_number() over (partition by conv_id order by turn nulls first, role, text, again) as i,
        not regexp_matches(text, '[^\x20\x09-\x0D]') as blank, not regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') as broken
      from seen
    ), turns as (
      select *, left(role, 1) as initial, blank or again as faulty, broken and not blank and not again as truncated,
        lag(left(role, 1)) over (partition by conv_id order by i) as before
      from marked
    ), ids as (
      select conv_id from conversations group by conv_id
    ), figures as (
      select conv_id, max(i) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (blank) as blank,
        count(*) filter (again and not blank) as duplicate, count(*) filter (truncated) as truncated,
        count(*) filter (before is not null and before || initial not in ('su', 'ua', 'au')) as illegal
      from turns group by conv_id
    ), edits(state, letter, initial, next) as (
      values (0, 'D', '', 0), (1, 'D', '', 1), (2, 'D', '', 2), (3, 'D', '', 3),
        (0, 'K', 's', 1), (0, 'K', 'u', 2), (1, 'K', 'u', 2), (3, 'K', 'u', 2), (2, 'K', 'a', 3),
        (0, 'R', '', 2), (1, 'R', '', 2), (3, 'R', '', 2), (2, 'R', '', 3)
    ), inserts(state, letters, next, cost, lines) as (
      values (0, '', 0, 0, ''), (1, '', 1, 0, ''), (2, '', 2, 0, ''), (3, '', 3, 0, ''),
        (0, 'I', 2, 2, chr(10) || 'user:'), (1, 'I', 2, 2, chr(10) || 'user:'), (3, 'I', 2, 2, chr(10) || 'user:'), (2, 'I', 3, 2, chr(10) || 'assistant:'),
        (0, 'II', 3, 4, chr(10) || 'user:' || chr(10) || 'assistant:'), (1, 'II', 3, 4, chr(10) || 'user:' || chr(10) || 'assistant:'),
        (3, 'II', 3, 4, chr(10) || 'user:' || chr(10) || 'assistant:'), (2, 'II', 2, 4, chr(10) || 'assistant:' || chr(10) || 'user:')
    ), search as (
      select conv_id, 0::bigint as i, next as state, {{'cost': cost::bigint, 'audit': letters, 'lines': lines}} as best
      from ids, inserts where state = 0
      union all
      select s.conv_id, t.i, n.next, min({{
        'cost': (s.best.cost + n.cost + case letter when 'D' then 3 when 'R' then 2 else 0 end + case when truncated and letter <> 'D' then 1 else 0 end)::bigint,
        'audit': s.best.audit || letter || n.letters,
        'lines': s.best.lines || case letter when 'D' then '' when 'K' then chr(10) || role || ':' || text
          else chr(10) || (case e.next when 2 then 'user' else 'assistant' end) || ':' || text end || n.lines
      }})
      from search s join turns t on s.conv_id is not distinct from t.conv_id and t.i = s.i + 1
        join edits e on e.state = s.state and (letter = 'D' or not faulty and (letter = 'R' or e.initial = t.initial))
        join inserts n on n.state = e.next
      group by s.conv_id, t.i, n.next
    ), ended as (
      select s.conv_id, min(best) as best
      from search s left join figures f on s.conv_id is not distinct from f.conv_id
      where s.i = coalesce(n, 0) and state in (0, 3) group by s.conv_id
    )
    select e.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
      coalesce(illegal, 0) as illegal, best.cost as cost, best.audit as audit, sha256(substr(best.lines, 2)) as repaired_sha256
    from ended e left join figures f on e.conv_id is not distinct from f.conv_id
"""

ORACLE: dict[str, str] = {"op2_jaccard_join": OP2, "op4_suffix_dedup": OP4, "op11_prefix_trie": OP11, "op13_conversation_repair": OP13}
