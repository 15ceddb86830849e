"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from .licenses import COPYRIGHT_LINE, COPYRIGHT_NOTICE, KNOWN, NOTICE_WORD, PUNCTUATION, SPELLINGS


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical(text: str, left_out: str = COPYRIGHT_LINE) -> str:
    out = f"translate(chr(10) || {text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    if left_out == COPYRIGHT_NOTICE:
        out = f"replace({out}, chr(10), chr(10) || chr(10)) || chr(10) || chr(10)"
    out = f"regexp_replace({out}, {_quoted(left_out)}, chr(10), 'g')"
    out = f"regexp_replace({out}, {_quoted(PUNCTUATION)}, ' ', 'g')"
    for other, one in SPELLINGS:
        out = f"replace({out}, {_quoted(other)}, {_quoted(one)})"
    return f"trim({out})"


_KNOWN = ", ".join(f"({_quoted(i)}, {_quoted(k)}, {_quoted(t)})" for i, k, t in KNOWN)

LICENSES = f"""
with text as (select * from (values {_KNOWN}) as k(license_id, kind, body)),
known as (select if(kind = 'digest', 'text', kind) as kind, if(kind = 'digest', body, sha256({_canonical("body")})) as known, min(license_id) as license_id from text group by 1, 2),
wrapped as (select if(kind = 'digest', body, sha256({_canonical("body", COPYRIGHT_NOTICE)})) as known, min(license_id) as other from text where kind <> 'notice' group by 1),
doc as (select row_number() over () as r, doc_id, coalesce("text", '') as body from documents),
line as (select r, unnest(string_split(body, chr(10))) as l from doc),
noted as (
  select r, string_agg(distinct license_id, ',' order by license_id) as notices
  from (select r, sha256({_canonical("l")}) as d from line where contains(lower(l), '{NOTICE_WORD}')) x
  join known on kind = 'notice' and known = d group by r
)
select doc_id, sha256({_canonical("body")}) as digest, coalesce(license_id, other) as license_id, coalesce(notices, '') as notices
from doc left join known on kind = 'text' and known = sha256({_canonical("body")}) left join wrapped w on w.known = sha256({_canonical("body", COPYRIGHT_NOTICE)}) left join noted using (r)
"""

DECONTAMINATION = r"""
with doc as (
  select row_number() over () as r, doc_id,
    [x for x in string_split(regexp_replace(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' ') if x <> ''] as w
  from documents
), item as (
  select item_id,
    [x for x in string_split(regexp_replace(translate("text", 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' ') if x <> ''] as w
  from benchmark where "text" is not null and item_id is not null
), pattern as (
  select distinct item_id, least(10, len(w)) as m, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') as s
  from (select item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) as i from item where len(w) > 0)
), place as (select r, w, unnest(range(1, len(w) + 1)) as i from doc),
hit as (
  select p.r, p.i, q.m, q.item_id
  from (select r, i, m, array_to_string(w[i:i + m - 1], ' ') as s from place cross join (select distinct m from pattern) where i + m - 1 <= len(w)) p
  join pattern q on p.m = q.m and p.s = q.s
), covered as (select r, count(distinct j) as n from (select r, unnest(range(i, i + m)) as j from hit) group by r),
listed as (select r, count(*) as n, string_agg(id, ',' order by id) as ids from (select distinct r, cast(item_id as varchar) as id from hit) group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(c.n, 0) as bigint) as n_hit, cast(coalesce(l.n, 0) as bigint) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(c.n, 0) > 0 as contaminated
from doc left join covered c using (r) left join listed l using (r)
"""

_WORDS = r"[x for x in string_split(regexp_replace(coalesce({0}, ''), '[\x09-\x0D\x20]+', ' ', 'g'), ' ') if x <> '']"

SUBSTRINGS = f"""
with doc as (select row_number() over () as r, doc_id, {_WORDS.format('"text"')} as w from documents),
win as (select r, doc_id, i, array_to_string(w[i:i + 12], ' ') as s from (select r, doc_id, w, unnest(range(1, len(w) - 11)) as i from doc)),
least as (select s, min(doc_id) as m from win group by s having count(distinct doc_id) > 1),
gone as (select distinct r, unnest(range(i, i + 13)) as j from win join least using (s) where m < doc_id),
lost as (select r, list(j) as js, count(*) as n from gone group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n, 0) as bigint) as n_removed,
  sha256(array_to_string(case when n is null then w else [w[k] for k in range(1, len(w) + 1) if not list_contains(js, k)] end, ' ')) as kept_sha256
from doc left join lost using (r)
"""

JACCARD = f"""
with recursive doc as (select row_number() over () as r, doc_id, {_WORDS.format("translate(\"text\", 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} as w from documents),
gram as (select distinct r, doc_id, array_to_string(w[i:i + 3], ' ') as s from (select r, doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) as i from doc where len(w) > 0)),
size as (select r, doc_id, count(*) as n from gram group by 1, 2),
link as (
  select p.a, p.b from (select x.r as a, y.r as b, count(*) as k from gram x join gram y using (s) where x.r <> y.r group by 1, 2) p
  join size x on x.r = p.a join size y on y.r = p.b where 100 * k >= 85 * (x.n + y.n - k)
), reach as (select r, r as o from size union select reach.r, link.b from reach join link on link.a = reach.o)
select doc.doc_id, cast(coalesce(any_value(size.n), 0) as bigint) as n_shingles, coalesce(min(size_o.doc_id), doc.doc_id) as component_id
from doc left join size using (r) left join reach using (r) left join size as size_o on size_o.r = reach.o group by doc.r, doc.doc_id
"""

PHRASES = r"""
with pieces as (
  select coalesce(lang, 'und') lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) piece
  from documents where text is not null),
words as (select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') w from pieces),
n as (select lang, sum(len(w))::bigint n from words group by lang),
places as (select lang, w, unnest(range(1, len(w) + 1)) i from words),
grams as (select lang, w, i, unnest(range(1, least(5, len(w) - i + 1) + 1)) k from places),
f as (select lang, w[i:i + k - 1] p, count(*) f from grams group by all having count(*) >= 100),
cuts as (select lang, p, f a, unnest(range(1, len(p))) k from f where len(p) > 1),
scored as (
  select c.lang, c.p, c.a, c.k, l.f l, r.f r, n.n, ((1000::hugeint * c.a * n.n) // (l.f::hugeint * r.f))::bigint score
  from cuts c join n using (lang) join f l on l.lang = c.lang and l.p = c.p[1:c.k] join f r on r.lang = c.lang and r.p = c.p[c.k + 1:]),
lowest as (select lang, p, a, n, min(struct_pack(score := score, k := k, l := l, r := r)) cut from scored group by all),
spans as (select lang, p, f, unnest(range(1, len(p))) i from f where len(p) > 2),
inside as (select lang, p[i:j] q, max(f) f from (select *, unnest(range(i + 1, len(p) + 1)) j from spans) where j - i + 1 < len(p) group by all),
kept as (select o.* from lowest o left join inside s on s.lang = o.lang and s.q = o.p where s.f is null or s.f < o.a),
ranked as (select lang, array_to_string(p, ' ') phrase, a, cut.l l, cut.r r, n, cut.score score from kept)
select lang, rank, phrase, a, l, r, n, score
from (select *, row_number() over (partition by lang order by score desc, a desc, phrase) rank from ranked) where rank <= 2000
"""

SQL = {"op10_ngram_jaccard": JACCARD, "op8_substring_dedup": SUBSTRINGS, "op1_license_scan": LICENSES, "op9_decontamination": DECONTAMINATION, "op12_phrase_mining": PHRASES}
