"""The registered corpus queries and the SQL each is checked against."""

from __future__ import annotations

from slotwise.llm import (
    collocations, exact_dedup, filter_audit, html_text, language_id, line_dedup, merkle, minhash, mixing, piece_bpe, secrets,
    substring_dedup, url_filter,
)
from slotwise.llm.common import table


def op1_language_id(spark, sf_dir):
    return language_id.identify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages"))


def op2_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_sentencepiece(spark, sf_dir):
    return piece_bpe.digests(table(spark, sf_dir, "documents"), piece_bpe.default_vocabulary())


def op4_line_dedup(spark, sf_dir):
    return line_dedup.line_digests(table(spark, sf_dir, "documents"))


def op5_html_extraction(spark, sf_dir):
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op6_minhash(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=2)


def op7_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_classes(table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark, sf_dir):
    return substring_dedup.substring_digests(table(spark, sf_dir, "documents"))


def op9_secret_scans(spark, sf_dir):
    return secrets.secret_digests(table(spark, sf_dir, "documents"))


def op10_fingerprints(spark, sf_dir):
    return merkle.fingerprints(table(spark, sf_dir, "documents"))


def op11_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_filter_audit(spark, sf_dir):
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_url_filters(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge(pages, url_filter.listed_hosts(pages))


QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id, op2_mixing, op3_sentencepiece, op4_line_dedup, op5_html_extraction, op6_minhash, op7_exact_dedup,
        op8_substring_dedup, op9_secret_scans, op10_fingerprints, op11_collocations, op12_filter_audit, op13_url_filters,
    )
}

ORACLES = {
    "op2_mixing": r"""
        with rows as (
            select doc_id, source, md5(coalesce(doc_id::varchar, '')) as key,
                coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size
            from documents),
        sizes as (select source, sum(size)::bigint as source_size from rows group by source),
        ranked as (select *, row_number() over (order by source nulls last) as rank from sizes),
        weighed as (select *, [5, 2, 1][(rank - 1) % 3 + 1]::bigint as weight, 3 * source_size as cap from ranked),
        ratios as (
            select *, cap::double / weight::double as ratio, (sum(source_size) over ())::double as total,
                sum(weight) over () as weights from weighed),
        levels as (
            select *, (total - coalesce(sum(cap) over before, 0)::double)
                / (weights - coalesce(sum(weight) over before, 0))::double as part
            from ratios window before as (order by ratio, rank rows between unbounded preceding and 1 preceding)),
        targets as (
            select source, source_size, least(cap::double, weight::double * max(part) over ()) as target from levels),
        plan as (
            select *, case when source_size > 0 then least(floor(target)::bigint, 3 * source_size) // source_size else 0 end
                as whole from targets),
        placed as (
            select r.*, p.source_size, p.target, p.whole,
                least(floor(p.target)::bigint, 3 * p.source_size) - p.whole * p.source_size as rest,
                sum(size) over (partition by r.source order by key, doc_id, size
                    rows between unbounded preceding and current row) - size as before
            from rows r join plan p on r.source is not distinct from p.source)
        select doc_id, size, source_size, target,
            (size * whole + greatest(0, least(size, rest - before)))::bigint as taken
        from placed""",
    "op7_exact_dedup": """
        select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
            doc_id is not distinct from max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
        from documents window same as (partition by coalesce(text, ''))""",
    "op4_line_dedup": """
        with docs as (select coalesce(doc_id, -9223372036854775808) as id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
        flat as (select id, i, lines[i] as line from (select id, lines, unnest(range(1, len(lines) + 1)) as i from docs)),
        solid as (
            select id, i, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) as line from flat
            where trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) <> ''),
        runs as (
            select id, i, line, row_number() over next as k, lead(line) over next as line2, lead(i) over next as i2
            from solid window next as (partition by id order by i)),
        run_firsts as (
            select id, i, i2, k, min(id * 1000000 + i) over (partition by line, line2) as first from runs where line2 is not null),
        repeated as (
            select id, i, i2, k - row_number() over (partition by id order by k) as part
            from run_firsts where id * 1000000 + i <> first),
        maximal as (select id, min(i) - 1 as low, max(i2) - 1 as high, count(*) + 1 as n from repeated group by id, part),
        matches as (
            select id, sum(n)::bigint as n_in_runs, string_agg(low || ':' || high, ',' order by low) as runs from maximal group by id),
        firsts as (select id, i, min(id * 1000000 + i) over (partition by line) as first from solid),
        gone as (
            select id, i from firsts where id * 1000000 + i <> first
            union select id, i from repeated
            union select id, i2 from repeated)
        select f.id as doc_id, count(*) as n_lines, count(g.id) as n_removed,
            sha256(coalesce(string_agg(f.line, chr(10) order by f.i) filter (g.id is null), '')) as kept_sha256,
            coalesce(any_value(m.n_in_runs), 0)::bigint as n_in_runs, coalesce(any_value(m.runs), '') as runs
        from flat f left join gone g on f.id = g.id and f.i = g.i left join matches m on f.id = m.id group by f.id""",
    "op10_fingerprints": r"""
        with docs as (select doc_id, coalesce(text, '') as text from documents),
        follow as (
            select *, coalesce(lead(text) over o, first_value(text) over o) as next_text
            from docs window o as (order by doc_id desc nulls last, text)),
        edits as (
            select doc_id, text, next_text, length(text) as n_chars,
                substr(text, 1, length(text) - length(text) // 3) || substr(next_text, 1, length(text) // 3) as edited
            from follow),
        trees as (
            select *,
                list_transform(string_split(text, chr(10) || chr(10)), lambda s: list_transform(string_split(s, chr(10)), lambda p:
                    md5('paragraph:' || array_to_string(list_transform([regexp_extract_all(p, '[^\x20\x09-\x0D]+[\x20\x09\x0B-\x0D]*|[\x20\x09\x0B-\x0D]+')], lambda t: list_transform(range(1, len(t) + 1),
                        lambda i: md5(array_to_string(t[i:i + 2], ''))))[1], ',')))) as tree,
                list_transform(string_split(edited, chr(10) || chr(10)), lambda s: list_transform(string_split(s, chr(10)), lambda p:
                    md5('paragraph:' || array_to_string(list_transform([regexp_extract_all(p, '[^\x20\x09-\x0D]+[\x20\x09\x0B-\x0D]*|[\x20\x09\x0B-\x0D]+')], lambda t: list_transform(range(1, len(t) + 1),
                        lambda i: md5(array_to_string(t[i:i + 2], ''))))[1], ',')))) as edited_tree,
                list_distinct(flatten(list_transform(string_split(text, chr(10)), lambda p:
                    list_transform([regexp_extract_all(p, '[^\x20\x09-\x0D]+[\x20\x09\x0B-\x0D]*|[\x20\x09\x0B-\x0D]+')], lambda t: list_transform(range(1, len(t) + 1),
                        lambda i: array_to_string(t[i:i + 2], '')))[1]))) as leaves,
                list_distinct(flatten(list_transform(string_split(edited, chr(10)), lambda p:
                    list_transform([regexp_extract_all(p, '[^\x20\x09-\x0D]+[\x20\x09\x0B-\x0D]*|[\x20\x09\x0B-\x0D]+')], lambda t: list_transform(range(1, len(t) + 1),
                        lambda i: array_to_string(t[i:i + 2], '')))[1]))) as edited_leaves,
                list_distinct(flatten(list_transform(string_split(next_text, chr(10)), lambda p:
                    list_transform([regexp_extract_all(p, '[^\x20\x09-\x0D]+[\x20\x09\x0B-\x0D]*|[\x20\x09\x0B-\x0D]+')], lambda t: list_transform(range(1, len(t) + 1),
                        lambda i: array_to_string(t[i:i + 2], '')))[1]))) as next_leaves
            from edits),
        heads as (select *, coalesce(nullif(list_position(list_transform(range(1, least(len(tree), len(edited_tree)) + 1), lambda i: tree[i] = edited_tree[i]), false), 0), least(len(tree), len(edited_tree)) + 1) - 1 as head from trees),
        ends as (
            select *, least(least(len(tree), len(edited_tree)) - head,
                coalesce(nullif(list_position(list_transform(range(1, least(len(tree), len(edited_tree)) + 1), lambda i: tree[len(tree) - i + 1] = edited_tree[len(edited_tree) - i + 1]), false), 0), least(len(tree), len(edited_tree)) + 1) - 1) as tail
            from heads),
        sections as (
            select *, list_transform(range(1, greatest(len(tree), len(edited_tree)) - head - tail + 1), lambda k: struct_pack(
                a := case when head + k <= len(tree) - tail then tree[head + k] end,
                b := case when head + k <= len(edited_tree) - tail then edited_tree[head + k] end)) as pairs
            from ends),
        pair_heads as (
            select *, list_transform(list_filter(pairs, lambda x: x.a is distinct from x.b), lambda x: struct_pack(a := x.a, b := x.b,
                head := coalesce(nullif(list_position(list_transform(range(1, least(len(x.a), len(x.b)) + 1), lambda i: x.a[i] = x.b[i]), false), 0), least(len(x.a), len(x.b)) + 1) - 1)) as headed
            from sections),
        pair_ends as (
            select *, list_transform(headed, lambda x: struct_pack(a := x.a, b := x.b, head := x.head, tail := least(least(len(x.a), len(x.b)) - x.head,
                coalesce(nullif(list_position(list_transform(range(1, least(len(x.a), len(x.b)) + 1), lambda i: x.a[len(x.a) - i + 1] = x.b[len(x.b) - i + 1]), false), 0), least(len(x.a), len(x.b)) + 1) - 1))) as differ
            from pair_heads),
        counted as (
            select *, coalesce(list_sum(list_transform(differ, lambda x: case when x.a is null or x.b is null then 1 else
                len(list_filter(range(1, greatest(len(x.a), len(x.b)) - x.head - x.tail + 1), lambda k:
                    (case when x.head + k <= len(x.a) - x.tail then x.a[x.head + k] end)
                        is distinct from (case when x.head + k <= len(x.b) - x.tail then x.b[x.head + k] end))) end)), 0)::int as n_changed
            from pair_ends)
        select doc_id, n_chars, sha256(edited) as edited_sha256,
            md5('root:' || array_to_string(list_transform(tree, lambda s: md5('section:' || array_to_string(s, ','))), ',')) as fingerprint,
            md5('root:' || array_to_string(list_transform(edited_tree, lambda s: md5('section:' || array_to_string(s, ','))), ','))
                as edited_fingerprint,
            case when len(leaves) + len(edited_leaves) = 0 then 1.0
                else 2.0::double * len(list_intersect(leaves, edited_leaves)) / (len(leaves) + len(edited_leaves)) end::double as near_edited,
            case when len(leaves) + len(next_leaves) = 0 then 1.0
                else 2.0::double * len(list_intersect(leaves, next_leaves)) / (len(leaves) + len(next_leaves)) end::double as near_next,
            len(tree)::int as n_sections, n_changed
        from counted""",
    "op6_minhash": r"""
        with recursive words as (
            select doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
            from documents),
        sets as (
            select doc_id, case when len(w) < 2 then w
                else list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) end as s
            from words),
        flat as (select doc_id, len(s) as n, unnest(s) as g from sets),
        links as (
            select a.doc_id as a, b.doc_id as b
            from flat a join flat b
                on a.g = b.g and a.doc_id < b.doc_id and 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
            group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))),
        ends as (select a, b from links union all select b, a from links),
        reach as (select doc_id as id, doc_id as other from documents union select r.id, e.b from reach r join ends e on r.other = e.a),
        least_id as (select id, min(other) as component_id from reach group by id)
        select doc_id, len(s)::bigint as n_shingles, component_id, doc_id = component_id as kept from sets join least_id on doc_id = id""",
    "op8_substring_dedup": r"""
        with words as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
        windows as (
            select doc_id, k, array_to_string(w[k:k + 19], ' ') as win
            from (select doc_id, w, unnest(range(1, len(w) - 18)) as k from words where len(w) >= 20)),
        firsts as (
            select doc_id, k, doc_id::hugeint * 1000000000 + k as place,
                min(doc_id::hugeint * 1000000000 + k) over (partition by win) as first
            from windows),
        gone as (select distinct doc_id, unnest(range(k, k + 20)) as i from firsts where place <> first),
        flat as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as i from words),
        kept as (
            select f.doc_id, count(g.i) as n_removed, string_agg(f.word, ' ' order by f.i) filter (g.i is null) as text
            from flat f left join gone g on f.doc_id = g.doc_id and f.i = g.i group by f.doc_id)
        select d.doc_id, len(w)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(text, '')) as kept_sha256
        from words d left join kept k on d.doc_id = k.doc_id""",
    "op11_collocations": r"""
        with docs as (
            select row_number() over () as d, coalesce(lang, 'und') as lang,
                regexp_split_to_array(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') as pieces
            from documents),
        words as (
            select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from (select lang, unnest(pieces) as piece from docs)),
        sizes as (select unnest([1, 2, 3]) as size),
        starts as (
            select lang, w, size, unnest(range(1, len(w) - size + 2)) as i from words, sizes where len(w) >= size),
        f as (
            select lang, array_to_string(w[i:i + size - 1], ' ') as phrase, size, count(*) as n from starts group by all),
        totals as (select lang, sum(n)::bigint as n from f where size = 1 group by lang),
        cand as (select lang, phrase, size, n as a, string_split(phrase, ' ') as w from f where size >= 2 and n >= 10),
        cuts as (
            select lang, phrase, size, a, k, array_to_string(w[1:k], ' ') as first_part, array_to_string(w[k + 1:], ' ') as rest
            from (select *, unnest(range(1, size)) as k from cand)),
        scored as (
            select c.lang, c.phrase, c.a, c.k, x.n as l, y.n as r,
                ((1000000::hugeint * c.a * c.a) // (x.n::hugeint * y.n::hugeint))::bigint as score
            from cuts c join f x on c.lang = x.lang and c.first_part = x.phrase join f y on c.lang = y.lang and c.rest = y.phrase),
        chosen as (
            select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
        inner_parts as (
            select lang, a, array_to_string(w[1:2], ' ') as part from cand where size = 3
            union all select lang, a, array_to_string(w[2:3], ' ') from cand where size = 3),
        longest as (select lang, part, max(a) as most from inner_parts group by lang, part),
        stays as (
            select c.* from chosen c left join longest m on c.lang = m.lang and c.phrase = m.part
            where m.most is null or 100 * m.most < 50 * c.a),
        ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from stays)
        select r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score from ranked r join totals t on r.lang = t.lang where r.rank <= 2000""",
    "op12_filter_audit": r"""
        with texts as (
            select doc_id, coalesce(source, '') as part, coalesce(text, '') as t,
                regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
            from documents),
        good as (select distinct doc_id from labels where quality = 1),
        bad as (select distinct doc_id from labels where toxic = 1),
        docs as (
            select part, [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
                    100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t), regexp_matches(t, '[#$%&*|]'),
                    coalesce(doc_id > min(doc_id) over (partition by t), false)] as fails,
                (doc_id in (select doc_id from good))::int as good, (doc_id in (select doc_id from bad))::int as toxic
            from texts),
        kinds as (
            select part, fails, count(*) as n, coalesce(sum(good), 0)::bigint as good, coalesce(sum(toxic), 0)::bigint as toxic
            from docs group by part, fails),
        names as (select unnest(range(1, 6)) as f),
        orders as (
            select [a.f, b.f, c.f, d.f, e.f] as o from names a, names b, names c, names d, names e
            where len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
        steps as (select o, unnest(range(1, 6)) as step from orders),
        seen as (
            select part, o, step, o[step] as f, n, good, toxic, fails[o[step]] as hit,
                len(list_filter(o[1:step - 1], lambda i: fails[i])) > 0 as gone, len(list_filter(fails, lambda x: x)) as n_fails
            from kinds, steps),
        counts as (
            select part, array_to_string(list_transform(o, lambda i: 'ABCDE'[i]), '') as filter_order, step::int as step, f,
                coalesce(sum(n) filter (not hit and not gone), 0)::bigint as kept,
                coalesce(sum(n) filter (hit and not gone), 0)::bigint as removed,
                coalesce(sum(n) filter (hit and gone), 0)::bigint as redundant,
                coalesce(sum(n) filter (hit and n_fails = 1), 0)::bigint as unique_fails,
                coalesce(sum(good) filter (hit and not gone), 0)::bigint as good_lost,
                coalesce(sum(toxic) filter (hit and not gone), 0)::bigint as toxic_lost
            from seen group by part, o, step, f)
        select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
            (sum(removed) over (partition by part, f))::bigint as shapley
        from counts""",
    "op13_url_filters": r"""
        with hosts as (
            select page_id,
                translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path
            from pages),
        ruled as (
            select *, case
                when ('.' || host) like '%.example.net' and path like '/en/%' then 'example.net/en/'
                when ('.' || host) like '%.example.com' and path like '/de/%' then 'example.com/de/'
                when ('.' || host) like '%.org' and path like '/fr/%' then 'org/fr/'
                when ('.' || host) like '%.net' and path like '/%' then 'net/' end as rule
            from hosts)
        select page_id, host, path, rule,
            case when rule in ('net/', 'example.com/de/') then 'block' when rule is not null then 'allow'
                when list_has_any(string_split_regex(host, '[.-]'),
                    ['ads', 'adult', 'bets', 'casino', 'pills', 'poker', 'porn', 'spam', 'track', 'xxx']) then 'block'
                else 'allow' end as verdict
        from ruled""",
}
