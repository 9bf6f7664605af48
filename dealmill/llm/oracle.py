"""DuckDB SQL of the operators that SQL can express, each over the whole table; rows have no id but their own number."""

from __future__ import annotations

from dealmill.llm.collocations import ENDS, LEAST, LONGEST, TOP
from dealmill.llm.common import BLANK, WORD
from dealmill.llm.mixing import MAX_REPEATS, SCHEDULES, WEIGHTS
from dealmill.llm.quality_rules import BACK_OFF, COUNTS, MARKS, RATES, SPREADS, UPPER
from dealmill.llm.repeats import LENGTH
from dealmill.llm.secrets import BASE_KINDS, KINDS, MAX_OWNERS, MAX_REPOSITORIES


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _secrets() -> str:
    matches = " union all ".join(
        f"select row, source, {number} as kind_no, '{kind}' as kind, {least} as least, string_split_regex(t, {_text(p)}) as gaps, "
        f"regexp_extract_all(t, {_text(p)}, 0) as hits, regexp_extract_all(t, {_text(p)}, {group}) as vals from docs"
        for number, (kind, p, group, least) in enumerate(KINDS)
    )
    base = f"kind_no < {len(BASE_KINDS)}"
    counts = ", ".join(f"count(*) filter (where kind_no = {n}) as n_{kind}" for n, (kind, *_) in enumerate(BASE_KINDS))
    names = ", ".join(f"coalesce(n_{kind}, 0) as n_{kind}" for kind, *_ in BASE_KINDS)
    joined = "string_agg(kind || ':' || (stop - length(hit)) || ':' || stop, ',' order by stop - length(hit), kind_no)"
    return f"""
    with docs as (select row_number() over () as row, doc_id, source, coalesce(text, '') as t from documents),
    matches as ({matches}),
    each as (select row, source, kind_no, kind, least, unnest(range(1, len(hits) + 1)) as i, gaps, hits, vals from matches),
    placed as (
        select row, source, kind_no, kind, least, hits[i] as hit, vals[i] as value,
            cast(sum(length(gaps[i]) + length(hits[i])) over (partition by row, kind_no order by i) as bigint) as stop
        from each),
    long_enough as (
        select * from placed where length(value) >= least
            and ({base} or (regexp_matches(value, '[0-9]') and regexp_matches(value, '[A-Za-z]')))),
    spans as (
        select * from long_enough s where {base} or not exists (
            select 1 from long_enough b where b.row = s.row and b.{base}
                and b.stop - length(b.hit) < s.stop and b.stop > s.stop - length(s.hit))),
    owners as (select value, count(*) as n from (select distinct value, source from spans) o group by value),
    repositories as (select value, count(*) as n from (select distinct value, doc_id from spans join docs using (row)) r group by value),
    judged as (
        select s.*, o.n <= {MAX_OWNERS} and r.n <= {MAX_REPOSITORIES} as live
        from spans s join owners o using (value) join repositories r using (value)),
    found as (
        select row, {counts}, {joined} filter (where {base}) as base, {joined} as spans,
            count(*) filter (where live) as n_live, count(*) filter (where not live) as n_example
        from judged where {base} or live group by row)
    select doc_id, {names}, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans,
        coalesce(n_live, 0) as n_live, coalesce(n_example, 0) as n_example
    from docs left join found using (row)"""


def _mix() -> str:
    by_rank = lambda values: f"([{', '.join(map(str, values))}])[rank % {len(values)} + 1]"
    first, last = ([s[i] for s in SCHEDULES] for i in (0, 1))
    return f"""
    with docs as (
        select doc_id, source, len(regexp_extract_all(coalesce(text, ''), {_text(WORD)})) as size,
            md5(coalesce(cast(doc_id as varchar), '')) as draw
        from documents),
    ranked as (
        select source, cast(sum(size) as bigint) as source_size, row_number() over (order by source nulls last) - 1 as rank
        from docs group by source),
    weighed as (
        select *, {by_rank(WEIGHTS)} as weight, {MAX_REPEATS} * source_size as cap,
            cast({by_rank(first)} as double) as first, cast({by_rank(last)} as double) as last
        from ranked),
    -- The level of weight 1 if just the sources whose cap is below that of one source, per weight, were full.
    levels as (
        select k.rank, any_value(k.cap / k.weight) as ratio,
            ((select sum(source_size) from weighed) - coalesce(sum(f.cap) filter (where f.cap / f.weight < k.cap / k.weight), 0))
                / cast(sum(f.weight) filter (where f.cap / f.weight >= k.cap / k.weight) as double) as level
        from weighed k cross join weighed f group by k.rank),
    common as (select arg_min(level, ratio) as level from levels where level <= ratio),
    targets as (
        select w.*, case when weight * level <= cap then weight * level else cast(cap as double) end as target
        from weighed w cross join common),
    placed as (
        select d.doc_id, d.size, t.*, cast(round(target) as bigint) as words,
            coalesce(sum(d.size) over (partition by d.source order by draw, d.doc_id nulls first, d.size
                rows between unbounded preceding and 1 preceding), 0) as start
        from docs d join targets t on d.source is not distinct from t.source),
    shares as (
        select *, case when source_size > 0 then words // source_size else 0 end as rounds,
            least(start / target, 1.0) * (first + last) / 2.0 as share
        from placed)
    select doc_id, size, source_size, target,
        cast(rounds * size + greatest(0, least(size, words - rounds * source_size - start)) as bigint) as taken,
        case when target > 0 then 2.0 * share / (first + sqrt(first * first + 2.0 * (last - first) * share)) end as position
    from shares"""


def _quality() -> str:
    count = lambda signs: f"length(t) - length(regexp_replace(t, {_text(signs)}, '', 'g'))"
    rates = {
        "symbol_rate": ("n_symbols", "word_chars"), "upper_rate": ("n_upper", "word_chars"), "mark_rate": ("n_marks", "word_chars"),
        "dup_line_rate": ("n_dup_lines", "n_lines"), "repeat_rate": ("n_repeat_words", "n_words"), "word_length": ("word_chars", "n_words"),
    }
    measured = ", ".join(f"case when {b} > 0 then {a} / cast({b} as double) end as {name}" for name, (a, b) in rates.items())
    quartiles = ", ".join(f"quantile_disc({r}, [0.25, 0.5, 0.75]) as {r}" for r in RATES)
    mix = lambda own, above: f"({own[0]}.n * coalesce({own}, {above}) + {BACK_OFF} * coalesce({above}, {own})) / ({own[0]}.n + {BACK_OFF})"
    lines = ", ".join(f"{mix(f'l.{r}[{i}]', f'c.{r}[{i}]')} as {r}{i}" for r in RATES for i in (1, 2, 3))
    mixed = ", ".join(f"{mix(f'g.{r}[{i}]', f'k.{r}{i}')} as {r}{i}" for r in RATES for i in (1, 2, 3))
    tests = []
    for r, (step, both) in RATES.items():
        reach = f"greatest({2 * SPREADS} * least(q.{r}2 - q.{r}1, q.{r}3 - q.{r}2), {step})"
        tests.append(f"coalesce(m.{r} <= q.{r}2 + {reach}, true)")
        if both:
            tests.append(f"coalesce(m.{r} >= q.{r}2 - {reach}, true)")
    failed = "(n_words < 50 or 100 * n_repeat_words > 50 * n_words)"
    return f"""
    with docs as (
        select row_number() over () as row, doc_id, lang, source, coalesce(text, '') as t,
            regexp_extract_all(coalesce(text, ''), {_text(WORD)}) as words,
            list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, {_text(WORD)})) as lines
        from documents),
    counted as (
        select row, doc_id, lang, source, len(words) as n_words, length(t) - ({count(BLANK)}) as word_chars,
            {count("[#*$%&|<>]")} as n_symbols, len(lines) - len(list_distinct(lines)) as n_dup_lines, len(lines) as n_lines,
            {count(UPPER)} as n_upper, {count(MARKS)} as n_marks
        from docs),
    one as (select row, unnest(words) as a, unnest(range(len(words))) as i from docs),
    three as (
        select row, i, a, lead(a, 1) over w as b, lead(a, 2) over w as c from one window w as (partition by row order by i)),
    twice as (select row, i, c is not null and count(*) over (partition by row, a, b, c) > 1 as again from three),
    covered as (
        select row, again or coalesce(lag(again, 1) over w, false) or coalesce(lag(again, 2) over w, false) as inside
        from twice window w as (partition by row order by i)),
    repeated as (select row, count(*) filter (where inside) as n_repeat_words from covered group by row),
    full_counts as (select c.*, coalesce(r.n_repeat_words, 0) as n_repeat_words from counted c left join repeated r using (row)),
    measured as (select *, {measured} from full_counts),
    sketched as (
        select lang, source, grouping(lang) as all_langs, grouping(source) as all_sources, cast(count(*) as double) as n, {quartiles}
        from measured group by rollup(lang, source)),
    languages as (
        select l.lang, {lines}
        from (select * from sketched where all_langs = 0 and all_sources = 1) l, (select * from sketched where all_langs = 1) c),
    quartiles as (
        select g.lang, g.source, {mixed}
        from (select * from sketched where all_sources = 0) g join languages k on k.lang is not distinct from g.lang)
    select doc_id, {', '.join(COUNTS)}, {failed} as base_failed, not {failed} and {' and '.join(tests)} as kept
    from measured m join quartiles q on q.lang is not distinct from m.lang and q.source is not distinct from m.source"""


def _repeats() -> str:
    return f"""
    with docs as (select row_number() over () as row, doc_id, encode(coalesce(text, '')) as data from documents),
    sized as (select *, octet_length(data) as n from docs),
    starts as (select row, unnest(range(1, n - {LENGTH - 1} + 1)) as i, data from sized),
    strings as (select row, i, md5(data[i : i + {LENGTH - 1}]) as string from starts),
    again as (select row, i from (select *, count(*) over (partition by string) as seen from strings) s where seen > 1),
    opened as (select *, coalesce(i > lag(i) over w + {LENGTH}, true) as fresh from again window w as (partition by row order by i)),
    runs as (
        select row, min(i) as first, max(i) + {LENGTH - 1} as last
        from (select *, sum(cast(fresh as int)) over (partition by row order by i) as run from opened) o group by row, run),
    gaps as (
        select row, coalesce(lag(r.last) over w, 0) + 1 as first, r.first - 1 as last from runs r window w as (partition by row order by r.first)
        union all select row, coalesce(max(r.last), 0) + 1, any_value(n) from sized left join runs r using (row) group by row),
    kept as (
        select row, string_agg(hex(data[g.first : g.last]), '' order by g.first) as bytes
        from gaps g join sized using (row) where g.last >= g.first group by row),
    removed as (select row, cast(sum(last - first + 1) as bigint) as n_removed, count(*) as n_spans from runs group by row)
    select doc_id, n as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
        sha256(unhex(coalesce(bytes, ''))) as kept_sha256
    from sized left join removed using (row) left join kept using (row)"""


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _ranked_search(k: int = 10) -> str:
    found = f"regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
    return f"""
    with docs as (select row_number() over () as row, doc_id, {found} as terms from documents),
    items as (select row_number() over () as place, item_id, list_distinct({found}) as terms from benchmark),
    sized as (select row, doc_id, cast(len(terms) as bigint) as n from docs where len(terms) > 0),
    totals as (select cast(count(*) as bigint) as n_docs, cast(sum(n) as bigint) as n_terms from sized),
    counted as (select row, term, cast(count(*) as bigint) as tf from (select row, unnest(terms) as term from docs) w group by row, term),
    weighed as (
        select term, cast(floor(1000 * ln(cast(2 * n_docs + 2 as double) / cast(2 * df + 1 as double))) as bigint) as w
        from (select term, count(*) as df from counted group by term) d, totals),
    asked as (select place, item_id, unnest(terms) as term from items),
    scored as (
        select place, item_id, row, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))) as bigint) as score
        from asked join weighed using (term) join counted using (term) join sized using (row), totals
        group by place, item_id, row, doc_id),
    ranked as (
        select *, row_number() over (partition by place order by score desc, doc_id nulls last) as rank from scored where score > 0)
    select item_id, cast(rank as integer) as rank, doc_id, score from ranked where rank <= {k}"""


def _collocations() -> str:
    return f"""
    with pieces as (select coalesce(lang, 'und') as lang, unnest(string_split_regex({_LOWERED}, '{ENDS}')) as piece from documents),
    spoken as (select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as words from pieces),
    places as (select lang, words, unnest(range(1, len(words) + 1)) as i from spoken),
    sized as (select lang, words, i, unnest(range(1, {LONGEST} + 1)) as size from places),
    counted as (
        select lang, size, array_to_string(words[i : i + size - 1], ' ') as phrase, cast(count(*) as bigint) as f
        from sized where i + size - 1 <= len(words) group by all having count(*) >= {LEAST}),
    totals as (select lang, cast(sum(len(words)) as bigint) as n from spoken group by lang),
    candidates as (select *, string_split(phrase, ' ') as words from counted where size > 1),
    cuts as (select lang, phrase, f as a, size, words, unnest(range(1, size)) as k from candidates),
    scored as (
        select c.lang, c.phrase, a, l.f as l, r.f as r, n, k, (1000::hugeint * a * n) // (l.f::hugeint * r.f) as score
        from cuts c join totals using (lang)
        join counted l on l.lang = c.lang and l.phrase = array_to_string(words[1 : k], ' ')
        join counted r on r.lang = c.lang and r.phrase = array_to_string(words[k + 1 : c.size], ' ')),
    lowest as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
    inside as (select lang, f, size, words, unnest(range(2, size)) as m from candidates where size > 2),
    parts as (select lang, f, size, words, m, unnest(range(1, size - m + 2)) as b from inside),
    around as (select lang, array_to_string(words[b : b + m - 1], ' ') as phrase, max(f) as f from parts group by all),
    kept as (select s.* from lowest s left join around o using (lang, phrase) where o.f is null or 100 * o.f < 100 * a),
    ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
    select lang, rank, phrase, a, l, r, n, cast(score as bigint) as score from ranked where rank <= {TOP}"""


SQL = {
    "op1_secret_scan": _secrets(),
    "op2_source_mix": _mix(),
    "op4_quality_rules": _quality(),
    "op7_repeated_strings": _repeats(),
    "op11_ranked_search": _ranked_search(),
    "op12_collocations": _collocations(),
}
