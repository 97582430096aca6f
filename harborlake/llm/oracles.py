"""DuckDB SQL for the queries that SQL can express."""

# The white space that is stripped from lines.
_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

# Runs of white space, and words of letters, digits and characters beyond ASCII.
_SPACES = r"'[\x20\x09-\x0D]+'"
_WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

ORACLES: dict[str, str] = {
    "op6_decontamination": f"""with words as (
          select doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), {_WORDS}) as words from documents),
        items as (select item_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), {_WORDS}) as words from benchmark where item_id is not null),
        sized as (select item_id, words, least(13, len(words)) as size from items where len(words) > 0),
        starts as (select item_id, words, size, unnest(range(1, len(words) - size + 2)) as first from sized),
        windows as (select distinct item_id, size, array_to_string(words[first:first + size - 1], ' ') as phrase from starts),
        sizes as (select distinct size from windows),
        places as (select doc_id, words, size, unnest(range(1, len(words) - size + 2)) as first from words, sizes where len(words) >= size),
        said as (select doc_id, size, first, array_to_string(words[first:first + size - 1], ' ') as phrase from places),
        found as (select doc_id, item_id, size, first from said join windows using (size, phrase)),
        hit as (select doc_id, count(distinct place) as n_hit from (select doc_id, unnest(range(first, first + size)) as place from found) group by doc_id),
        named as (select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as names
          from (select distinct doc_id, item_id::varchar as item_id from found) group by doc_id)
        select doc_id, len(words) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(names, '')) as items_sha256,
          coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(words) as contaminated
        from words left join hit using (doc_id) left join named using (doc_id)""",
    "op10_exact_dedup": f"""with plain as (
          select doc_id, sha256(regexp_replace(coalesce(text, ''), {_SPACES}, ' ', 'g')) as text_sha256 from documents),
        grouped as (select *, min(doc_id) over (partition by text_sha256) as keep_id, count(*) over (partition by text_sha256) as group_size from plain)
        select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from grouped""",
    "op11_line_dedup": f"""with lines as (
          select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
            unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as pos from documents),
        keyed as (select *, translate(trim(line, {_WHITE}), {_LOWER}) as key from lines),
        shared as (select key from keyed where key <> '' group by key having count(distinct doc_id) >= 10)
        select doc_id, count(*) as n_lines, count(shared.key) as n_dropped,
          sha256(coalesce(string_agg(line, chr(10) order by pos) filter (shared.key is null), '')) as kept_sha256
        from keyed left join shared using (key) group by doc_id""",
    "op13_prefix_trie": """with turns as (
          select conv_id, row_number() over (partition by conv_id order by turn nulls first) as pos,
            {'role': coalesce(role, ''), 'text': coalesce(text, '')} as turn from conversations where conv_id is not null),
        own as (select conv_id, list(turn order by pos) as turns from turns group by conv_id),
        hashed as (
          select *, xor(list_reduce(list_prepend(4294967295::ubigint, list_transform(string_split(conv_id::varchar, ''), lambda c: ord(c)::ubigint)),
              lambda crc, c: list_reduce([xor(crc, c), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, i: xor(v >> 1, (v & 1) * 3988292384::ubigint))),
            4294967295::ubigint) % 6 as h from own),
        rebuilt as (
          select hashed.conv_id, list_concat(coalesce(origin.turns, [])[1:hashed.h], hashed.turns[hashed.h + 1:]) as turns
          from hashed left join own as origin on origin.conv_id = hashed.conv_id - hashed.conv_id % 100),
        members as (select conv_id, len(turns) as n, unnest(range(len(turns) + 1)) as depth, turns from rebuilt),
        nodes as (
          select turns[1:depth] as path, depth, min(conv_id) as conv_id, count(*) as n_convs,
            sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (n = depth), '')) as ends_sha256
          from members group by all),
        parents as (select path[1:depth - 1] as path, count(*) as n_children from nodes where depth > 0 group by 1),
        complete as (
          select nodes.*, coalesce(n_children, 0) as n_children,
            case when depth > 0 then (n_convs - 1) * length(path[depth].text) else 0 end as saved
          from nodes left join parents using (path)),
        above as (select path[1:unnest(range(depth + 1))] as path, n_children, saved from complete),
        sums as (select path, count(*) filter (n_children = 0) as n_leaves, cast(sum(saved) as bigint) as saved_tokens from above group by path)
        select c.conv_id, c.depth, p.conv_id as parent_conv_id, c.n_convs, c.n_children, n_leaves, saved_tokens, c.ends_sha256
        from complete c join sums on c.path = sums.path left join complete p on c.depth > 0 and p.path = c.path[1:c.depth - 1]""",
}
