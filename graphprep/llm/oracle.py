"""DuckDB twins of the registered queries, where SQL can say them.

Packing needs the tokenizer's ids, resharding a flow solver and fingerprints Spark's hashes; those are tested against
brute force instead.
"""

SPACES = r"[ \t\n\v\f\r]+"

ORACLE: dict[str, str] = {}

#: Words of each row, with a number for the row, since doc_id need not be one.
WORDS = rf"""
d as (select row_number() over () rid, doc_id, source, lang, coalesce(text, '') t from documents),
w as (select *, list_filter(regexp_split_to_array(t, '{SPACES}'), lambda x: x <> '') ws from d)
"""

ORACLE["op1_lm_scoring"] = rf"""
with good as (select distinct doc_id from labels where quality = 1 and doc_id is not null),
{WORDS},
m as (select w.rid, w.doc_id, ws, (g.doc_id is not null)::int tgt from w left join good g on g.doc_id = w.doc_id),
tok as (select rid, tgt, i, ws[i] word from (select rid, tgt, ws, unnest(range(1, len(ws) + 1)) i from m)),
totals as (select count(*)::double n, coalesce(sum(tgt), 0)::double t from tok),
vocabulary as (select word, count(*)::double n, sum(tgt)::double t from tok group by word
  having count(*) >= 2),
counted as (select * from vocabulary union all
  select null, (select n from totals) - coalesce(sum(n), 0), (select t from totals) - coalesce(sum(t), 0) from vocabulary),
uni as (select word, n, t, (n + 0.5) / ((select n from totals) + 0.5 * (select count(*) from counted)) pb,
  (t + 0.5) / ((select t from totals) + 0.5 * (select count(*) from counted)) pt from counted),
ids as (select rid, tgt, i, v.word from tok left join vocabulary v on v.word = tok.word),
seq as (select *, lag(coalesce('+' || word, '-')) over (partition by rid order by i) before from ids),
pair as (select before, coalesce('+' || word, '-') word, count(*)::double n, sum(tgt)::double t from seq where before is not null group by all),
kept as (select * from pair where n >= 2),
named as (select coalesce('+' || word, '-') word, n, t, pb, pt from uni),
own as (select before, k.word, 0.7 * (k.n / u.n) ob, 0.7 * (case when u.t > 0 then k.t / u.t else 0 end) ot
  from kept k join named u on u.word = k.before),
follow as (select u.word before, 1 - coalesce(sum(ob), 0) fb, 1 - coalesce(sum(ot), 0) ft
  from named u left join own on own.before = u.word group by u.word),
p as (select s.rid, u.pb * coalesce(f.fb, 1) + coalesce(o.ob, 0) b, u.pt * coalesce(f.ft, 1) + coalesce(o.ot, 0) t
  from seq s join named u on u.word = coalesce('+' || s.word, '-')
  left join follow f on f.before = s.before
  left join own o on o.before = s.before and o.word = coalesce('+' || s.word, '-')),
loss as (select rid, count(*) n, -sum(ln(t)) / count(*) lt, -sum(ln(b)) / count(*) lb from p group by rid)
select doc_id, coalesce(n, 0) n_words, round(lt, 4) target_loss, round(lb, 4) background_loss, round(lt - lb, 4) difference
from m left join loss using (rid)
"""

ORACLE["op2_host_rules"] = rf"""
with {WORDS},
tri as (select rid, i, ws[i:i + 2] g from (select rid, ws, unnest(range(1, len(ws) - 1)) i from w)),
twice as (select rid, i from (select rid, i, count(*) over (partition by rid, g) c from tri) where c > 1),
covered as (select rid, count(distinct p) n from (select rid, unnest([i, i + 1, i + 2]) p from twice) group by rid),
lines as (select rid, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\v\f\r]')) l from d),
m as (select w.rid, doc_id, source, len(ws) n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::bigint word_chars,
  length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) n_symbols, len(l) n_lines,
  len(l) - len(list_distinct(l)) n_dup_lines, coalesce(c.n, 0) n_repeat_words
  from w join lines using (rid) left join covered c on c.rid = w.rid),
r as (select *, n_words < 50 short, 100 * n_repeat_words > 50 * n_words repeated,
  100 * n_symbols > 20 * n_words symbols, 100 * n_dup_lines > 50 * n_lines dup_lines from m),
rules as (select rid, source, rule, failed::int f from r unpivot (failed for rule in (short, repeated, symbols, dup_lines))),
hosts as (select source, rule, count(*)::double n, sum(f)::double f from rules group by all),
moments as (select rule, sum(n) n, sum(f) f, sum(f * f / n) s, count(*) h from hosts group by rule),
between_ as (select rule, n, f, f / n mean, s / n - (f / n) * (f / n) - (f / n) * (1 - f / n) * (h - 1) / n v from moments),
prior as (select rule, mean, case when f > 0 and f < n and v > 1e-9 then greatest(mean * (1 - mean) / v - 1, 1e-6) end k from between_),
judged as (select source, max(case when k is null then mean else (f + mean * k) / (n + k) end) worst
  from hosts join prior using (rule) group by source)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, short or repeated base_failed,
  worst > 0.5 host_rejected, not (short or repeated) and not worst > 0.5 kept
from r join judged on judged.source is not distinct from r.source
"""

ORACLE["op4_ngram_jaccard_join"] = rf"""
with recursive texts as (select coalesce(text, '') t, min(doc_id) first_id, count(*) copies from documents group by 1),
w as (select *, list_filter(regexp_split_to_array(t, '{SPACES}'), lambda x: x <> '') ws from texts),
s as (select t, first_id, copies, case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')]
  else list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) end g from w),
e as (select first_id, len(g) n, unnest(g) g from s),
pairs as (select a.first_id x, b.first_id y from e a join e b on a.g = b.g and a.first_id <> b.first_id
  group by a.first_id, b.first_id, a.n, b.n having count(*) >= 0.8 * (a.n + b.n - count(*))),
reach as (select first_id x, first_id y from s union select r.x, p.y from reach r join pairs p on p.x = r.y),
groups as (select x, min(y) least from reach group by x),
links as (select x, sum(c.copies) documents, count(*) texts from pairs join s c on c.first_id = pairs.y group by x)
select doc_id, case when len(g) = 0 then doc_id else least end class_id,
  (coalesce(documents, 0) + case when len(g) > 0 then copies - 1 else 0 end)::bigint n_links, coalesce(texts, 0) n_text_links
from documents join s on s.t = coalesce(text, '') join groups on groups.x = first_id left join links on links.x = first_id
"""

ASSIGN = """(?i:(password|passwd|secret|token|api_?key))["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
PATTERNS = {0: ASSIGN, 1: "AKIA[A-Z0-9]{12,}", 2: "[0-9a-f]{32,}", 3: "[A-Za-z0-9+/_=-]{20,}"}
MATCHES = " union all ".join(
    f"select rid, {kind} kind, string_split_regex(t, '{p}') gaps, regexp_extract_all(t, '{p}', 0) found, "
    f"regexp_extract_all(t, '{p}', {2 if kind == 0 else 0}) v from d"
    for kind, p in PATTERNS.items()
)
ORACLE["op5_secret_scan"] = rf"""
with d as (select row_number() over () rid, doc_id, source, lang, coalesce(text, '') t from documents),
raw as ({MATCHES}),
numbered as (select *, unnest(range(1, len(found) + 1)) i from raw),
spans as (select rid, kind, found[i] m, v[i] v,
  (list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0))::bigint start from numbered),
sized as (select *, start + length(m) stop from spans),
base as (select * from sized where (kind = 0 and length(v) >= 8) or kind in (1, 2)),
bare as (select * from sized s where kind = 3 and regexp_matches(m, '[0-9]') and regexp_matches(m, '[a-z]') and regexp_matches(m, '[A-Z]')
  and not exists (select 1 from base b where b.rid = s.rid and b.start < s.stop and s.start < b.stop)),
c as (select * from base union all select * from bare),
held as (select distinct v, coalesce(source, chr(1)) o, coalesce(source, chr(1)) || '/' || coalesce(lang, chr(1)) r from c join d using (rid)),
owned as (select v, count(distinct o) <= 2 and count(distinct r) <= 3 live from held group by v),
judged as (select rid, kind, start, live, ['assign', 'access', 'hex', 'bare'][kind + 1] || ':' || start || ':' || stop s
  from c join owned using (v) where kind < 3 or live),
each as (select rid, count(*) filter (kind = 0) a, count(*) filter (kind = 1) k, count(*) filter (kind = 2) h,
  string_agg(s, ',' order by start, kind) filter (kind < 3) b, string_agg(s, ',' order by start, kind) s, count(*) filter (live) n from judged group by rid)
select doc_id, coalesce(a, 0) n_assign, coalesce(k, 0) n_access, coalesce(h, 0) n_hex, sha256(coalesce(b, '')) base_sha256,
  coalesce(s, '') spans, coalesce(n, 0) n_live
from d left join each using (rid)
"""

ORACLE["op7_source_mixing"] = rf"""
with {WORDS},
sized as (select rid, doc_id, source, len(ws) size, t from w),
sources as (select source, sum(size)::double s from sized group by source),
weighed as (select source, s, [5.0, 2.0, 1.0][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::double wt from sources),
ratio as (select *, 2.0 * s ceiling, 2.0 * s / wt r, 1.5 * (select sum(s) from sources) total from weighed),
-- The level with the k sources of least ceiling per weight full; the right one is the first that leaves the next below its ceiling.
steps as (select r, (total - coalesce(sum(ceiling) over before, 0)) / sum(wt) over after level from ratio
  window before as (order by r range between unbounded preceding and current row exclude group), after as (order by r range between current row and unbounded following)),
level as (select level from steps where level <= r order by r limit 1),
targets as (select source, s, least(ceiling, coalesce((select level from level), 1e300) * wt) target from ratio),
placed as (select sized.*, s, target, case when s > 0 then target / s else 0 end rate,
  row_number() over (partition by sized.source order by size, md5('mix' || coalesce(doc_id::varchar, '')), t) - 1 place,
  ('0x' || md5('mix' || coalesce('/' || sized.source, ''))[1:12])::bigint / 16.0 ^ 12 u
  from sized join targets on targets.source is not distinct from sized.source),
taken as (select *, (floor((place + 1) * rate + u) - floor(place * rate + u))::bigint copies from placed)
select doc_id, source, size, s::bigint source_size, round(target, 6) target, copies, (copies * size)::bigint taken from taken
"""

ORACLE["op8_url_cascade"] = r"""
with u as (select page_id, html, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') host, regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) path from pages),
listed as (select distinct host || path k from u where (length(html) - length(replace(html, '***', ''))) / 3 >= 5),
rules(verdict, h, p) as (values ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fits as (select page_id, host, path, first(h || p order by length(h || p) desc, h || p) rule, first(verdict order by length(h || p) desc, h || p) verdict
  from (select distinct page_id, host, path from u) x join rules on (host = h or suffix(host, '.' || h)) and prefix(path, p) group by all)
select u.page_id, u.host, u.path, rule, coalesce(verdict, case when l.k is not null then 'block' else 'allow' end) verdict, l.k is not null listed
from u left join fits f on f.page_id is not distinct from u.page_id and f.host = u.host and f.path = u.path left join listed l on l.k = u.host || u.path
"""

ORACLE["op12_phrase_collocations"] = r"""
with d as (select coalesce(lang, 'und') lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') t from documents),
pieces as (select lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) piece from d),
w as (select lang, list_filter(string_split_regex(piece, '[ \x09]+'), lambda x: x <> '') ws from pieces),
starts as (select lang, ws, unnest(range(1, len(ws) + 1)) i from w),
grams as (select lang, k, array_to_string(ws[i:i + k - 1], ' ') phrase from starts, range(1, 6) sizes(k) where i + k - 1 <= len(ws)),
totals as (select lang, count(*) n from grams where k = 1 group by lang),
f as (select lang, phrase, any_value(k) k, count(*) a from grams group by lang, phrase having count(*) >= 100),
c as (select *, string_split(phrase, ' ') ws from f where k > 1),
cuts as (select lang, phrase, a, cut, array_to_string(ws[:cut], ' ') lhs, array_to_string(ws[cut + 1:], ' ') rhs
  from (select *, unnest(range(1, k)) cut from c)),
scored as (select cuts.lang, cuts.phrase, cuts.a, cut, x.a l, y.a r, n, ((1000::hugeint * cuts.a * n) // (x.a::hugeint * y.a))::bigint score
  from cuts join f x on x.lang = cuts.lang and x.phrase = lhs join f y on y.lang = cuts.lang and y.phrase = rhs join totals on totals.lang = cuts.lang),
weakest as (select * from scored qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
inside as (select lang, array_to_string(ws[i:i + size - 1], ' ') phrase, max(a) around
  from (select *, unnest(range(1, k - size + 2)) i from (select *, unnest(range(2, k)) size from c where k > 2)) group by all),
kept as (select weakest.* from weakest left join inside using (lang, phrase) where around is null or 100 * around < 100 * a)
select * from (select lang, row_number() over (partition by lang order by score desc, a desc, phrase) rank, phrase, a, l, r, n, score from kept) where rank <= 2000
"""
