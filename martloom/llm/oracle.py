"""DuckDB SQL for the rows of those queries that SQL can express."""

from __future__ import annotations

from martloom.llm import decontamination, licences

ORACLES: dict[str, str] = {}

SPACE = r"[\x20\x09-\x0D]+"

# Counts of words and lines as defined for the rules; frequent lines by plain grouping of texts.
ORACLES["op2_line_frequency"] = rf"""
with d as (
  select row_number() over () rid, doc_id, coalesce(source, '') host, coalesce(text, '') t from documents
), w as (
  select rid, doc_id, host, t,
    list_filter(regexp_split_to_array(t, '{SPACE}'), lambda x: x <> '') words,
    string_split(t, chr(10)) lines from d
), g as (
  select rid, i, words[i] || ' ' || words[i+1] || ' ' || words[i+2] gram
  from (select rid, words, unnest(range(1, len(words) - 1)) i from w)
), twice as (
  select rid, i from g qualify count(*) over (partition by rid, gram) > 1
), covered as (
  select rid, count(distinct p) n from (select rid, unnest([i, i+1, i+2]) p from twice) group by rid
), l as (
  select rid, host, doc_id, t, k, lines[k] line,
    lower(trim(regexp_replace(lines[k], '{SPACE}', ' ', 'g'))) norm
  from (select *, unnest(range(1, len(lines) + 1)) k from w)
), hosts as (
  select host, count(distinct t) texts from d group by host
), freq as (
  select host, norm, first_t from (
    select host, norm, arg_min(t, doc_id) first_t, count(*) n from (
      select host, norm, t, min(doc_id) doc_id from l where norm <> '' group by all)
    group by host, norm) join hosts using (host) 
  where n >= case when len(string_split(norm, ' ')) <= 3 then 500 else 50 end or n >= 10 and n * 100 > 5 * texts
), line_words as (
  select l.rid, l.norm <> '' has_word,
    len(list_filter(regexp_split_to_array(l.line, '{SPACE}'), lambda x: x <> '')) n, l.line,
    f.norm is not null and f.first_t <> l.t lost
  from l left join freq f on f.host = l.host and f.norm = l.norm
), per as (
  select rid, count(*) filter (has_word) - count(distinct line) filter (has_word) n_dup_lines,
    count(*) filter (lost) n_frequent_lines, coalesce(sum(n) filter (not lost), 0)::bigint n_words_left
  from line_words group by rid
), c as (
  select w.doc_id, len(words)::bigint n_words, length(regexp_replace(t, '{SPACE}', '', 'g'))::bigint word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::bigint n_symbols, per.n_dup_lines,
    coalesce(covered.n, 0)::bigint n_repeat_words, n_frequent_lines, n_words_left
  from w left join covered using (rid) left join per using (rid)
), b as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words base_failed from c
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and not (n_words_left < 50 or n_words_left * 100 < n_words * 50) kept,
  n_frequent_lines, n_words_left from b
"""


def licence_sql() -> str:
    """The rules as nested replacements over the identifiers of a document."""
    values = ", ".join(f"('{normal}', '{name}')" for normal, name in licences.known_sentences().items())
    left, steps = "',' || list_aggregate(ids, 'string_agg', ',,') || ','", []
    for k, (_, rule) in enumerate(licences.RULES):
        sequence = "," + ",,".join(rule) + ","
        source = "m" if k == 0 else f"r{k - 1}"
        seen = f"contains(s, '{sequence}') as rule{k}"
        first = f"(select *, {left} as s from m)" if k == 0 else source
        steps.append(f"r{k} as (select * exclude (s), {seen}, replace(s, '{sequence}', '') as s from {first})")
    names = ", ".join(f"case when rule{k} then '{name}' end" for k, (name, _) in enumerate(licences.RULES))
    return rf"""
with known(normal, sentence_id) as (values {values}),
s as (
  select rid, doc_id, unnest(parts) part, generate_subscripts(parts, 1) i from (
    select rid, doc_id, string_split(regexp_replace(joined,
      '([.!?:])[ \t]*\r?\n|([.!?:])[ \t]+|\n[^A-Za-z0-9\n]*\n'
      || '|https?://www\.apache\.org/licenses/LICENSE-2\.0(?:\.txt|\.html)?',
      '\1\2' || chr(1), 'g'), chr(1)) parts from (
      select row_number() over () rid, doc_id, regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''),
        '([Cc]opyright (?:\([Cc]\)|©|[0-9]{{4}})[^\n]*\n)', '\1' || chr(10), 'g'),
        '([ ,][Vv]\.)[^A-Za-z0-9]{{1,8}}([0-9])|([Ff]ree[^A-Za-z0-9]{{1,8}}[Ss]oftware|SPDX-License-Identifier):',
        '\1\2\3', 'g'),
        '(?m:^)[ \t]*(?:dnl|REM|rem)([ \t\r\n])', '\1', 'g') joined from documents))
), p as (
  select rid, doc_id, i, unnest(lines) line, generate_subscripts(lines, 1) j from (
    select *, case when contains(part, chr(10)) then list_concat([part], string_split(part, chr(10)))
      else [part] end as lines from s)
), m as (
  select rid, doc_id, list(sentence_id order by i, j, sentence_id) ids
  from p join known on trim(regexp_replace(lower(line), '{licences.NOT_LETTERS}', ' ', 'g')) = normal
  group by all
), {", ".join(steps)}
, f as (select doc_id, ids, s, list_filter([{names}], lambda x: x is not null) names from r{len(licences.RULES) - 1})
select doc_id,
  case when len(names) > 0 then list_aggregate(list_filter(names, lambda x, i: list_position(names, x) = i), 'string_agg', ',') end licences,
  list_aggregate(ids, 'string_agg', ',') sentences,
  len(list_filter(string_split(s, ','), lambda x: x <> ''))::bigint unmatched from f
"""


ORACLES["op8_licence_sentences"] = licence_sql()

# The mails are parsed line by line; links are looked up by text instead of by hash.
ORACLES["op5_quotation_linking"] = r"""
with recursive said as (
  select conv_id, turn, min(text) said from conversations group by all
), mails as (
  select row_number() over () rid, c.conv_id, c.turn,
    coalesce('> > ' || replace(b.said, chr(10), chr(10) || '> > ') || chr(10), '')
    || coalesce('> ' || replace(case when c.turn % 3 = 2 then string_split(a.said, chr(10))[1] else a.said end,
                                chr(10), chr(10) || '> ') || chr(10), '')
    || coalesce(c.text, '') mail
  from conversations c
  left join said a on a.conv_id = c.conv_id and a.turn + 1 = c.turn
  left join said b on b.conv_id = c.conv_id and b.turn + 2 = c.turn
), lines as (
  select rid, conv_id, turn, i, length(regexp_replace(regexp_extract(l, '^(?:[ \t]*>)+ ?'), '[^>]', '', 'g')) lvl,
    substr(l, length(regexp_extract(l, '^(?:[ \t]*>)+ ?')) + 1) said
  from (select rid, conv_id, turn, unnest(x) l, generate_subscripts(x, 1) i
        from (select *, string_split(mail, chr(10)) x from mails))
), runs as (
  select *, sum(case when lvl = prev then 0 else 1 end) over (partition by rid order by i) run
  from (select *, lag(lvl) over (partition by rid order by i) prev from lines)
), own as (
  select rid, conv_id, turn, coalesce(string_agg(said, chr(10) order by i) filter (lvl = 0), '') own
  from lines group by all
), passages as (
  select rid, conv_id, turn, lvl, run,
    lower(trim(regexp_replace(string_agg(said, ' ' order by i), '[\x20\x09-\x0D]+', ' ', 'g'))) whole,
    lower(trim(regexp_replace(arg_min(said, i), '[\x20\x09-\x0D]+', ' ', 'g'))) line
  from runs where lvl > 0 group by all having whole <> ''
), units as (
  select distinct conv_id, turn, u from (
    select conv_id, turn, lower(trim(regexp_replace(own, '[\x20\x09-\x0D]+', ' ', 'g'))) u from own
    union all
    select conv_id, turn, lower(trim(regexp_replace(l, '[\x20\x09-\x0D]+', ' ', 'g')))
    from (select conv_id, turn, unnest(string_split(own, chr(10))) l from own))
  where u <> ''
), here as (
  select conv_id, u, min(turn) turn from units group by all
), anywhere as (
  select u, min({'c': conv_id, 't': turn}) o from units group by all
), asked as (
  select rid, conv_id, turn, lvl, run, 0 how, whole u from passages
  union all select rid, conv_id, turn, lvl, run, 1, line from passages
), targets as (
  select q.rid, q.lvl, q.run, how,
    case when h.turn < q.turn then 0 else 1 end far,
    case when h.turn < q.turn then q.conv_id when a.o.c < q.conv_id then a.o.c end tc,
    case when h.turn < q.turn then h.turn when a.o.c < q.conv_id then a.o.t end tt
  from asked q left join here h on h.conv_id = q.conv_id and h.u = q.u left join anywhere a on a.u = q.u
), linked as (
  select rid, lvl, run, arg_min({'c': tc, 't': tt}, far * 2 + how) dest
  from targets where tc is not null group by all
), per as (
  select rid, count(*) n_linked, min({'l': lvl, 'c': -dest.c, 't': -dest.t}) best from linked group by all
), msgs as (
  select own.*, (select count(*) from passages p where p.rid = own.rid) n_passages,
    coalesce(n_linked, 0) n_linked, -best.c reply_conv, -best.t reply_turn
  from own left join per using (rid)
), tree as (
  select conv_id, turn, conv_id root_conv, turn root_turn, 0::bigint depth from msgs where reply_conv is null
  union all
  select m.conv_id, m.turn, t.root_conv, t.root_turn, t.depth + 1
  from msgs m join tree t on m.reply_conv = t.conv_id and m.reply_turn = t.turn
)
select m.conv_id, m.turn, n_passages, n_linked, reply_conv || ':' || reply_turn reply_to, root_conv, root_turn, depth, md5(own) own_md5
from msgs m join tree t using (conv_id, turn)
"""


def decontamination_sql() -> str:
    """Templates, their windows, slots and runs, joined by the windows themselves instead of by hash."""
    ends = "'.', '!', '?', chr(10)"
    quoted = lambda words: ", ".join(f"'{w}'" for w in words)
    return rf"""
with src as (
  select 'd' side, null::bigint item_id, x from (select distinct text x from documents where text is not null)
  union all select 'b', item_id, x from (select distinct item_id, coalesce(text, '') x from benchmark)
), tok as (
  select row_number() over () rid, side, item_id, x,
    regexp_extract_all(x, '[0-9]+(?:[.,:][0-9]+)*|[\p{{L}}][\p{{L}}\p{{M}}\p{{N}}]*|[.!?\n]') w from src
), e as (
  select rid, i, w[i] tk, lower(w[i]) lo, upper(w[i]) up, case when i = 1 then '.' else w[i - 1] end bf
  from (select rid, w, unnest(range(1, len(w) + 1)) i from tok)
), k as (
  select rid, i, tk, case
    when (tk >= '0' and tk <= '9~') or lo in ({quoted(decontamination.NUMBER_WORDS)}) then '<number>'
    when substr(tk, 1, 1) <> substr(lo, 1, 1) and tk <> up and bf not in ({ends}) then '<name>'
    when lo in ({quoted(decontamination.UNITS)}) then '<unit>' else lo end p
  from e where tk not in ({ends})
), whole as (
  select tok.rid, side, item_id, x, raw, tpl, least({decontamination.WINDOW}, len(tpl)) l
  from tok join (select rid, list(tk order by i) raw, list(p order by i) tpl from k group by rid) using (rid)
), cut as (
  select rid, item_id, tpl form, l, p, tpl[p:p + l - 1] win, list_transform(raw[p:p + l - 1], lambda z: lower(z)) a
  from (select *, unnest(range(1, len(tpl) - l + 2)) p from whole where side = 'b')
), kinds as (
  select *, len(list_filter(win, lambda z: starts_with(z, '<'))) * 2 > l exact from cut
), keyed as (
  select *, case when exact then a else win end seek from kinds
), spread as (
  select exact, seek, count(distinct form) n_forms from keyed group by all
), iw as (
  select *, count(*) over item n_windows, count(*) filter (not exact) over item n_told,
    count(*) filter (tell) over item n_tell, count(*) filter (tell and not exact) over item n_told_tell
  from (select *, n_forms <= greatest(10, min(n_forms) over (partition by form)) tell
        from keyed join spread using (exact, seek))
  window item as (partition by rid)
), dw as (
  select rid, x, p, tpl[p:p + n - 1] win, list_transform(raw[p:p + n - 1], lambda z: lower(z)) b from (
    select whole.*, n, unnest(range(1, len(tpl) - n + 2)) p
    from whole join (select distinct l n from iw) sizes on len(tpl) >= n where side = 'd')
), hit as (
  select dw.rid, dw.x, iw.rid irid, iw.p place, dw.p - iw.p diagonal, iw.* exclude (rid, p), dw.b
  from dw join iw on dw.win = iw.seek where not exact
  union all
  select dw.rid, dw.x, iw.rid irid, iw.p place, dw.p - iw.p diagonal, iw.* exclude (rid, p), dw.b
  from dw join iw on dw.b = iw.seek where exact
), likely as (
  select * from hit semi join (select distinct rid, irid from hit where tell) t using (rid, irid)
), slots as (
  select rid, irid, diagonal, win[j] kind, a[j] a, b[j] b, place + j spot
  from (select *, unnest(range(1, len(win) + 1)) j from likely) where starts_with(win[j], '<')
), wrong as (
  select rid, irid, diagonal from (
    select rid, irid, diagonal, kind, a, max(n) usual, sum(n) n from (
      select rid, irid, diagonal, kind, a, b, count(distinct spot) n from slots group by all)
    group by rid, irid, diagonal, kind, a)
  group by all having sum(usual) * 100 < sum(n) * 80
), judged as (
  select likely.*, w.rid is null consistent
  from likely left join wrong w on (likely.rid, likely.irid, likely.diagonal) = (w.rid, w.irid, w.diagonal)
), ranked as (
  select *, place - row_number() over (partition by rid, irid, diagonal order by place) run
  from judged where consistent or a = b
), runs as (
  select *, max(place) over r - min(place) over r + l >= 15 and bool_or(tell) over r long_run
  from ranked window r as (partition by rid, irid, diagonal, run)
), held as (
  select x, item_id, n_windows, n_told, n_tell, n_told_tell, bool_or(long_run) long_run,
    count(distinct place) n_found, count(distinct place) filter (not exact) n_told_found,
    count(distinct place) filter (tell) n_tell_found,
    count(distinct place) filter (tell and not exact) n_told_tell_found,
    max(len(list_filter(win, lambda z: starts_with(z, '<'))))::integer n_slots
  from runs where consistent or long_run
  group by rid, irid, x, item_id, n_windows, n_told, n_tell, n_told_tell
)
select doc_id, item_id, n_found, n_windows::integer n_windows, n_slots from documents join held on text = x
where long_run
  or n_tell > 0 and n_found * 100 >= n_windows * 30 and n_tell_found * 100 >= n_tell * 30
  or n_told > 0 and n_told_tell > 0 and n_told_found * 100 >= n_told * 30
    and n_told_tell_found * 100 >= n_told_tell * 30
"""


ORACLES["op3_template_decontamination"] = decontamination_sql()


ORACLES["op11_phrase_collocations"] = r"""
with p as (
  select coalesce(lang, 'und') lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) piece from documents
), w as (
  select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') ws from p
), g as (
  select lang, k, array_to_string(ws[i:i + k - 1], ' ') phrase
  from (select lang, ws, unnest(range(1, len(ws) + 1)) i from w), (select unnest(range(1, 5)) k)
  where i + k - 1 <= len(ws)
), f as (
  select lang, k, phrase, count(*) f from g group by all
), n as (
  select lang, sum(f)::bigint n from f where k = 1 group by lang
), c as (
  select lang, k, phrase, f a, string_split(phrase, ' ') ws from f where k > 1 and f >= 30
), cut as (
  select c.lang, c.phrase, a, x.f l, y.f r, (2000000::hugeint * a) // (x.f + y.f) score, j
  from (select *, unnest(range(1, k)) j from c) c
  join f x on x.lang = c.lang and x.phrase = array_to_string(ws[1:j], ' ')
  join f y on y.lang = c.lang and y.phrase = array_to_string(ws[j + 1:], ' ')
  qualify row_number() over (partition by c.lang, c.phrase order by score, j) = 1
), part as (
  select distinct lang, phrase whole, a whole_a, array_to_string(ws[i:i + m - 1], ' ') phrase
  from (select *, unnest(range(1, k + 1)) i from c), (select unnest(range(2, 4)) m)
  where m < k and i + m - 1 <= k
), best as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) rank from cut
  where not exists (select 1 from part where part.lang = cut.lang and part.phrase = cut.phrase
    and 100::hugeint * whole_a >= 80::hugeint * cut.a)
)
select lang, rank::bigint rank, phrase, a::bigint a, l::bigint l, r::bigint r, n, score::bigint score
from best join n using (lang) where rank <= 2000
"""

ORACLES["op13_minhash_near_dup"] = rf"""
with recursive w as (
  select doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{SPACE}'),
    lambda x: x <> '') ws from documents
), d as (
  select doc_id, list_sort(case when len(ws) = 0 then []::varchar[]
    when len(ws) < 5 then [array_to_string(ws, ' ')]
    else list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) end) s
  from w
), c as (
  select min(doc_id) node, s, len(s) n from d where len(s) > 0 group by s
), x as (
  select node, n, unnest(s) shingle from c
), e as (
  select a.node a, b.node b from x a join x b on a.shingle = b.shingle and a.node <> b.node
  group by a.node, b.node, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach as (
  select node, node root from c union select e.b, reach.root from reach join e on e.a = reach.node
), least_root as (
  select node, min(root) root from reach group by node
)
select doc_id, len(s)::bigint n_shingles, coalesce(root, doc_id) component_id,
  coalesce(root, doc_id) = doc_id kept
from d left join c using (s) left join least_root using (node)
"""
