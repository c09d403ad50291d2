"""The results of the registered queries in DuckDB SQL over the same tables.

Written from the rules, not from the Spark plans: windows stand where the library
aggregates and joins, recursion where it iterates.
"""

from __future__ import annotations

import zipfile
from pathlib import Path

import pyspark

from tekstmill.functions.minhash import rotation_step

from .queries import BROKEN_LETTERS, LANGUAGES, MD5_PLAN, NOW

# What the tables and the queries hold of these; the library's own tables are not used here.
DROPPED_ELEMENTS = ["script", "style", "noscript", "head", "nav", "header", "footer", "aside", "form"]
HTML_ENTITIES = [
    ("&#38;amp;", "\x02"), ("&rsquo;", "’"), ("&#8217;", "’"), ("&euro;", "€"), ("&iacute;", "í"), ("&#x2014;", "—"),
    ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&copy;", "©"), ("&middot;", "·"), ("&#x27;", "'"), ("&amp;", "&"),
    ("\x02", "&amp;"),
]
# Published thresholds and phrases.
TOP_NGRAM_SHARES = {2: 0.20, 3: 0.18, 4: 0.16}
DUP_NGRAM_SHARES = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
POLICY_PHRASES = ["terms of use", "privacy policy", "cookie policy", "uses cookies", "use of cookies", "use cookies"]
CURLY_QUOTES, STRAIGHT_QUOTES = "‘’‚‛“”„‟", "''''" + '""""'

WORDS = r"regexp_extract_all({}, '[\p{{L}}\p{{N}}]+')"
TOKENS = r"regexp_extract_all({}, '\p{{L}}+|\p{{N}}+|[^\s\p{{L}}\p{{N}}]+')"
SENTENCES = r"regexp_extract_all({}, '[^.!?]+[.!?]*')"
PIECES = r"regexp_extract_all({}, '^[.!?]+|[^.!?]+[.!?]*')"


def english_stop_words() -> list[str]:
    """Spark's English stop words, read from its own archive: the SQL can then be had
    without a running session."""
    for jar in sorted((Path(pyspark.__file__).parent / "jars").glob("spark-mllib_*.jar")):
        with zipfile.ZipFile(jar) as archive:
            return archive.read("org/apache/spark/ml/feature/stopwords/english.txt").decode("utf-8").split()
    from tekstmill.functions.text import stop_words

    return stop_words("en")


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def string_list(items) -> str:
    return "[" + ", ".join(quote(i) for i in items) + "]"


def replace_all(expr: str, pairs) -> str:
    for old, new in pairs:
        expr = f"replace({expr}, {quote(old)}, {quote(new)})"
    return expr


def share(part: str, whole: str) -> str:
    return f"(case when ({whole}) > 0 then ({part})::DOUBLE / ({whole})::DOUBLE else 0.0::DOUBLE end)"


def first_reason(rules) -> str:
    return "case " + " ".join(f"when {test} then {quote(name)}" for name, test in rules) + " end"


# -- extraction ---------------------------------------------------------------------

COLLAPSE = r"""select doc_id, regexp_replace(replace(text, chr(10), repeat(chr(10), 3)), '\n+', chr(10), 'g') as text
from documents"""


ADDED = "'<p>It&rsquo;s &#8217;&euro;&iacute;&#x2014; &#38;amp;</p></article>'"


def html_sql() -> str:
    page = rf"regexp_replace(replace(html, '</article>', {ADDED}), '(?s)<!--.*?-->', '', 'g')"
    for name in DROPPED_ELEMENTS:
        page = rf"regexp_replace({page}, '(?is)<{name}\b[^>]*>.*?</{name}\s*>', '', 'g')"
    page = rf"""regexp_replace({page}, '(?is)<div[^>]*class="(?:[^"]*\s)?ad(?:\s[^"]*)?"[^>]*>.*?</div\s*>', '', 'g')"""
    body = r"regexp_extract(p, '(?is)<(?:article|main)\b[^>]*>(.*)</(?:article|main)\s*>', 1)"
    blocks = (
        r"regexp_replace(b, '(?i)</?(?:p|div|br|h[1-6]|li|ul|ol|tr|table|section|article|main|blockquote|pre)\b[^>]*>',"
        r" chr(10), 'g')"
    )
    text = replace_all(rf"regexp_replace({blocks}, '<[^>]*>', '', 'g')", HTML_ENTITIES)
    text = rf"regexp_replace({text}, '[ \t\r\f]+', ' ', 'g')"
    text = rf"regexp_replace({text}, ' ?\n[ \n]*', chr(10), 'g')"
    return f"""with a as (select page_id, {page} as p from pages),
b as (select page_id, case when {body} <> '' then {body} else p end as b from a),
t as (select page_id, trim({text}, chr(10) || ' ') as text from b)
select page_id, text from t where text <> ''"""


def main_text_sql() -> str:
    page = r"regexp_replace(regexp_replace(html, '(?i)<(/?)(article|main|nav)\b', '<\1div', 'g'), '(?s)<!--.*?-->', '', 'g')"
    for name in DROPPED_ELEMENTS:
        page = rf"regexp_replace({page}, '(?is)<{name}\b[^>]*>.*?</{name}\s*>', '', 'g')"
    page = rf"""regexp_replace({page}, '(?is)<div[^>]*class="ad"[^>]*>.*?</div\s*>', '', 'g')"""
    words = r"len(regexp_extract_all(regexp_replace({x}, '<[^>]*>', '', 'g'), '[\p{{L}}\p{{N}}]+'))"
    links = r"array_to_string(regexp_extract_all(x, '(?is)<a\b[^>]*>(.*?)</a\s*>', 1), ' ')"
    score = f"{words.format(x='x')} - 2 * {words.format(x=links)} - len(regexp_extract_all(x, '<[^>]*>')) - 1"
    blocks = r"regexp_split_to_array(p, '(?i)</?(?:p|div|br|h[1-6]|li|ul|ol|tr|table|section|article|main|blockquote|pre)\b[^>]*>')"
    text = replace_all(r"array_to_string(list_transform(blocks[first:last], lambda x: regexp_replace(x, '<[^>]*>', '', 'g')), chr(10))", HTML_ENTITIES)
    text = rf"regexp_replace({text}, '[ \t\r\f]+', ' ', 'g')"
    text = rf"regexp_replace({text}, ' ?\n[ \n]*', chr(10), 'g')"
    return f"""with v as (select page_id, {page} as p from pages),
b as (select page_id, {blocks} as blocks from v),
s as (select page_id, blocks, list_transform(blocks, lambda x: {score}) as scores from b),
u as (select page_id, unnest(scores) as sc, generate_subscripts(scores, 1) as j from s),
pre as (select page_id, j, sum(sc) over (partition by page_id order by j) as prefix from u),
pz as (select page_id, 0 as j, 0 as prefix from s union all select page_id, j, prefix from pre),
pairs as (
  select e.page_id, z.j + 1 as first, e.j as last, e.prefix - z.prefix as total
  from pre e join pz z on z.page_id = e.page_id and z.j < e.j
),
best as (select * from pairs qualify row_number() over (partition by page_id order by total desc, last, first) = 1),
t as (
  select s.page_id, case when best.total > 0 then nullif(trim({text}, chr(10) || ' '), '') end as text
  from s left join best using (page_id)
)
select page_id, text from t"""


JSON_TEXT = "select event_id, json_extract_string(props, '$.k') as text from events where json_extract_string(props, '$.k') is not null"

JSON_LIST = "select conv_id, turn, unnest([text, upper(role)]) as text from conversations"

MAIL = r"""select doc_id, '' || chr(10) || '<http://docs.example.org/' || doc_id || '> '
  || regexp_replace(replace(regexp_replace(text || chr(10), '\n+', chr(10), 'g'), chr(13), ''), '\[[^\n]+?\]', '', 'g')
  || ' <http://plain.example.net/' || doc_id || '>' || chr(10) as text
from documents"""

UNWRAP = r"""with l as (select page_id, url, unnest([0, 1, 2, 3, 4]) as form from pages)
select page_id, form::BIGINT as form, case when form = 0 then url when form = 3 then url
  when form = 4 and contains(url, '?') then (
    select case when len(params) > 1 and stop is not null and starts_with(stop, 'url=') and len(string_split(stop, '=')) = 2
      then url_decode(substr(stop, 5)) end
    from (select params, list_filter(params, lambda p: len(string_split(p, '=')) <> 2 or starts_with(p, 'url='))[1] as stop
      from (select string_split(substr(url, strpos(url, '?') + 1), '&') as params)))
  end as target
from l"""

PAGE_PATH = r"('/crawl/' || page_id || '/' || regexp_replace(url, '[^A-Za-z0-9.]+', '_', 'g') || '.page v1.html')"

FILE_METADATA = rf"""with p as (select page_id, {PAGE_PATH} as path, octet_length(encode(html)) as size from pages),
n as (select *, string_split(path, '/')[-1] as name from p)
select page_id, name as filename,
  case when contains(ltrim(name, '.'), '.') then substr(ltrim(name, '.'), strpos(ltrim(name, '.'), '.')) else '' end as filetype,
  size::BIGINT as filesize, 0::INTEGER as page_count, path as file_path
from n"""

RECORDS = rf"""with p as (select html, octet_length(encode(html)) as size, {PAGE_PATH} as path from pages),
n as (select *, string_split(path, '/')[-1] as name from p)
select replace('web crawl-' || name, ' ', '-') as id, html as text, 'web crawl' as source, '{NOW}' as added,
  '2000-01-01 00:00:00, {NOW}' as created, name as filename,
  case when contains(ltrim(name, '.'), '.') then substr(ltrim(name, '.'), strpos(ltrim(name, '.'), '.')) else '' end as filetype,
  size::BIGINT as filesize, 0::INTEGER as page_count, path as file_path
from n"""

ROUTES = r"""with p as (select doc_id, ['txt', 'md', 'html', 'json', 'HTML', 'pdf'][((length(source) + n_chars) % 6 + 1)::INTEGER] as s, source from documents)
select doc_id, '/in/' || source || '/' || doc_id || '.v2.' || s as path,
  case when s in ('txt', 'md') then 'text' when s in ('html', 'json') then s else 'unsupported' end as route
from p"""

JSON_SHAPES = r"""with c as (select conv_id, turn, role, text, (conv_id + turn) % 6 as shape from conversations)
select conv_id, turn, unnest(case shape
  when 0 then [{'outcome': 'text', 'detail': null::varchar, 'position': '', 'text': text}]
  when 1 then [{'outcome': 'text', 'detail': null::varchar, 'position': '0', 'text': text},
               {'outcome': 'text', 'detail': null::varchar, 'position': '1', 'text': upper(role)}]
  when 2 then [{'outcome': 'text', 'detail': null::varchar, 'position': '0', 'text': text},
               {'outcome': 'text', 'detail': null::varchar, 'position': '1', 'text': role},
               {'outcome': 'missing', 'detail': 'text', 'position': '2', 'text': null::varchar}]
  when 3 then [{'outcome': 'missing', 'detail': 'text', 'position': '', 'text': null::varchar}]
  when 4 then [{'outcome': 'text', 'detail': null::varchar, 'position': '0,0', 'text': text},
               {'outcome': 'text', 'detail': null::varchar, 'position': '1,0,0', 'text': role},
               {'outcome': 'text', 'detail': null::varchar, 'position': '2', 'text': turn::varchar},
               {'outcome': 'text', 'detail': null::varchar, 'position': '3', 'text': 'True'},
               {'outcome': 'text', 'detail': null::varchar, 'position': '4', 'text': 'None'}]
  else [{'outcome': 'broken', 'detail': 'not JSON', 'position': '', 'text': null::varchar}] end, recursive := true)
from c"""

OUTCOMES = r"""with p as (
  select doc_id, text, lang, source,
    ['txt', 'md', 'html', 'json', 'HTML', 'pdf'][((length(source) + n_chars) % 6 + 1)::INTEGER] as s
  from documents
),
r as (select *, case when s in ('txt', 'md') then 'text' when s in ('html', 'json') then s else 'unsupported' end as rule from p),
o as (
  select doc_id, rule, 'unsupported' as outcome, '.' || s as detail from r where rule = 'unsupported'
  union all
  select doc_id, rule, case when doc_id % 11 = 0 then 'bad utf-8'
    when regexp_replace(coalesce(text, ''), '\n+', chr(10), 'g') = '' then 'empty' else 'text' end, null
  from r where rule = 'text'
  union all
  select doc_id, rule, case when doc_id % 3 = 0 or trim(coalesce(text, '')) = '' then 'empty' else 'text' end, null
  from r where rule = 'html'
  union all
  select doc_id, rule, unnest(case doc_id % 5
    when 0 then [case when text is null then 'missing' else 'text' end]
    when 1 then [case when text is null then 'missing' else 'text' end, case when source is null then 'missing' else 'text' end]
    when 2 then ['missing'] when 3 then ['broken'] else ['text', 'text'] end) as outcome, null
  from r where rule = 'json'
)
select doc_id, rule, outcome,
  case when outcome = 'missing' then 'text' when outcome = 'broken' then 'not JSON' else detail end as detail,
  count(*)::bigint as records
from o group by all"""

ABBREVIATION_CTE = r"""t as (select doc_id, coalesce(text, '') || ' Prisen er 3.5 kr. kl. 12 i dag, bl.a. det nye.' as text from documents),
s as (select list_filter(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+'), lambda x: x <> '') as ts from t),
u as (select ts[i] as t, ts[i + 1] as nxt from s, unnest(range(1, len(ts) + 1)) as g(i)),
typed as (
  select lower(case when f then substr(t, 1, length(t) - 1) else t end) as type, f as final,
    f and coalesce(regexp_matches(nxt, '^[\p{Ll}\p{N}]'), false) as lower_next
  from (select *, t like '%.' and t not like '%..' as f from u)
),
tot as (select count(*)::double as n, count(*) filter (final)::double as nf from typed),
c as (
  select type, count(*) filter (final) as with_period, count(*) as tokens, count(*) filter (lower_next) as lower_next
  from typed where regexp_matches(type, '^\p{L}[\p{L}.]*$') group by type
),
scored as (
  select c.*, length(replace(type, '.', '')) as letters, length(type) - length(replace(type, '.', '')) + 1 as inner_periods,
    least(greatest(nf / n, 1e-12), 1 - 1e-12) as p0
  from c, tot where with_period > 0
),
ab as (
  select type, with_period, tokens, lower_next,
    -2 * ((with_period * ln(p0) + (tokens - with_period) * ln(1 - p0)) - (with_period * ln(0.99) + (tokens - with_period) * ln(0.01)))
      * exp(-letters) * inner_periods * pow(letters, -(tokens - with_period)) as score, inner_periods
  from scored
),
abbrevs as (select * from ab where score >= 0.3 and (inner_periods > 1 or lower_next > 0))"""

ABBREVIATIONS = f"""with {ABBREVIATION_CTE}
select type, with_period::BIGINT as with_period, tokens::BIGINT as tokens, lower_next::BIGINT as lower_next,
  round(score, 6) as score from abbrevs"""

LEARNED_SENTENCES = f"""with {ABBREVIATION_CTE},
known as (select coalesce(list(type), []) as types from abbrevs),
p as (
  select doc_id, array_to_string(list_transform(
    regexp_extract_all(text, '[^ \\t\\n\\x0B\\f\\r]+|[ \\t\\n\\x0B\\f\\r]+'),
    lambda x: case when x like '%.' and x not like '%..' and list_contains(types, lower(substr(x, 1, length(x) - 1)))
      then substr(x, 1, length(x) - 1) || chr(57344) else x end), '') as protected
  from t, known
),
cut as (select doc_id, regexp_extract_all(protected, '(?s).+?(?:[.!?]+(?:[ \\t\\n\\x0B\\f\\r]|\\z)|\\z)') as ss from p)
select doc_id, (generate_subscripts(ss, 1) - 1)::BIGINT as pos, replace(unnest(ss), chr(57344), '.') as sentence from cut"""

LANGUAGE_ACCURACY = r"""with w as (select doc_id, lang, unnest(regexp_extract_all(lower(text), '\p{L}+')) as word from documents),
wc as (select doc_id, lang, word, count(*) as times from w group by all),
g as (select doc_id, lang, times, ' ' || word || ' ' as p, unnest(range(1, length(word) + 1)) as i from wc),
gb as (select doc_id, lang, times, ('0x' || substr(md5(substr(p, i, 3)), 1, 8))::BIGINT % 65536 as bucket from g),
train as (select lang, bucket, sum(times) as n from gb where doc_id % 2 = 0 group by all),
counts as (select lang, bucket, n from train union all select 'und', bucket, sum(n) from train group by bucket),
totals as (select lang, sum(n)::double as total from counts group by lang),
test as (select doc_id, lang, bucket, sum(times) as times from gb where doc_id % 2 = 1 group by all),
scored as (
  select t.doc_id, c.lang as cls, sum(t.times * ln((coalesce(n.n, 0) + 0.5) / (c.total + 0.5 * 65536))) as ll
  from test t cross join totals c left join counts n on n.lang = c.lang and n.bucket = t.bucket group by all
),
best as (select doc_id, arg_max(cls, ll) as language from scored group by all)
select d.lang, count(*)::BIGINT as documents, count(*) filter (b.language = d.lang)::BIGINT as correct
from documents d left join best b using (doc_id) where d.doc_id % 2 = 1 group by 1"""

# -- crawl and tables -----------------------------------------------------------------

HOSTS = "select distinct string_split(url, '/')[3] as host from pages where string_split(url, '/')[3] <> ''"

CRAWL_SELECT = """with h as (select distinct string_split(url, '/')[3] as host from pages where contains(html, '<html lang="en">'))
select page_id, string_split(url, '/')[3] as host from pages where string_split(url, '/')[3] in (select host from h)"""

WIDE = """(select *, l_extendedprice as copy, case when l_linenumber <= 3 then -1.0::DOUBLE else l_quantity end as partly,
  l_returnflag || chr(10) || l_linestatus as note from lineitem)"""

NEAR_DUP = f"""with s as (
  select 5 as left_pos, 11 as right_pos, 'l_extendedprice' as left_col, 'copy' as right_col,
    count(*) filter (l_extendedprice = copy)::DOUBLE / count(*)::DOUBLE as equal_share from {WIDE}
  union all select 4, 12, 'l_quantity', 'partly', count(*) filter (l_quantity = partly)::DOUBLE / count(*)::DOUBLE from {WIDE}
  union all select 0, 1, 'l_orderkey', 'l_partkey', count(*) filter (l_orderkey = l_partkey)::DOUBLE / count(*)::DOUBLE from {WIDE}
  union all select 6, 7, 'l_discount', 'l_tax', count(*) filter (l_discount = l_tax)::DOUBLE / count(*)::DOUBLE from {WIDE}
) select left_pos::INTEGER as left_pos, right_pos::INTEGER as right_pos, left_col, right_col, equal_share from s where equal_share >= 0.3"""

LINEITEM_COLUMNS = [
    ("l_orderkey", "n"), ("l_partkey", "n"), ("l_suppkey", "n"), ("l_linenumber", "i"), ("l_quantity", "d"),
    ("l_extendedprice", "d"), ("l_discount", "d"), ("l_tax", "d"), ("l_returnflag", "s"), ("l_linestatus", "s"), ("l_shipdate", "t"),
]


def pair_shares_sql() -> str:
    parts = []
    for i, (a, kind) in enumerate(LINEITEM_COLUMNS):
        for j, (b, other) in enumerate(LINEITEM_COLUMNS):
            if i < j and (kind == other or (kind in "nid" and other in "nid")):
                parts.append(
                    f"select {i}::INTEGER as left_pos, {j}::INTEGER as right_pos,"
                    f" count(*) filter ({a} = {b})::BIGINT as equal_rows, count(*)::BIGINT as total_rows from lineitem"
                )
    return " union all ".join(parts)


CLEAN_TABLE = """select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
  l_returnflag as note, l_linestatus, l_shipdate, {partly} l_returnflag || l_linestatus as note_1
from (select *, case when l_linenumber <= 3 then -1.0::DOUBLE else l_quantity end as partly from lineitem)"""

STRIP = "select doc_id, replace(text, chr(10), '') as text, lang from documents"

# -- filters --------------------------------------------------------------------------


def repair_expr(expr: str, entities: bool = True) -> str:
    if entities:
        expr = f"case when contains({expr}, '&') and not contains({expr}, '<') then {replace_all(expr, HTML_ENTITIES)} else {expr} end"
    return expr


def repair_steps(source: str, name: str = "repaired") -> str:
    """CTEs from ``source(doc_id, text)`` to ``name(doc_id, text)``."""
    blocks = [[(bad, good) for good, bad in BROKEN_LETTERS]]
    ctes = [f"r0 as (select doc_id, {repair_expr('text')} as text from {source})"]
    for i, block in enumerate(blocks, 1):
        ctes.append(f"r{i} as (select doc_id, {replace_all('text', block)} as text from r{i - 1})")
    controls = (
        r"regexp_replace(regexp_replace(text, '\x1B\[[0-9;]*[A-Za-z]', '', 'g'),"
        r" '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x{9F}\x{FEFF}]', '', 'g')"
    )
    ctes.append(
        f"{name} as (select doc_id, nfc_normalize(translate({controls}, {quote(CURLY_QUOTES)}, {quote(STRAIGHT_QUOTES)})) as text"
        f" from r{len(blocks)})"
    )
    return ",\n".join(ctes)


def repair_sql() -> str:
    # The decomposed letter of the query: e and a combining acute accent.
    broken = replace_all("text", BROKEN_LETTERS)
    start = f"'“Caf' || chr(101) || chr(769) || '”' || chr(7) || ' &amp; &lt;b&gt;' || chr(10) || {broken}"
    return f"with src as (select doc_id, {start} as text from documents),\n{repair_steps('src')}\nselect doc_id, text from repaired"


PROFILE_CTE = r"""pw as (select lang, unnest(regexp_extract_all(lower(text), '\p{L}+')) as w from documents),
pg as (select lang, substring(' ' || w || ' ', i::INTEGER, 3) as gram from (select lang, w, unnest(range(1, length(w) + 1)) as i from pw)),
profile as (select * from (select lang, gram, count(*) as n, row_number() over (partition by lang order by count(*) desc, gram) as rank
  from pg group by lang, gram) where rank <= 300)"""

PROFILES = f"with {PROFILE_CTE} select lang, gram, n::BIGINT as n, rank::BIGINT as rank from profile"


def language_ctes(source: str) -> str:
    """CTEs to ``scored(doc_id, language, language_score)`` for all rows of ``source``."""
    langs = ", ".join(f"({quote(lang)}, {i})" for i, lang in enumerate(LANGUAGES))
    return rf"""lw as (select doc_id, unnest(regexp_extract_all(lower(text), '\p{{L}}+')) as w from {source}),
lg as (select doc_id, substring(' ' || w || ' ', i::INTEGER, 3) as gram from (select doc_id, w, unnest(range(1, length(w) + 1)) as i from lw)),
hits as (select lg.doc_id, p.lang, count(*) as hits from lg join profile p on lg.gram = p.gram group by 1, 2),
langs(lang, turn) as (values {langs}),
ranked as (select d.doc_id, l.lang, coalesce(h.hits, 0) as hits,
    row_number() over (partition by d.doc_id order by coalesce(h.hits, 0) desc, l.turn) as place
  from (select distinct doc_id from lg) d cross join langs l left join hits h on h.doc_id = d.doc_id and h.lang = l.lang),
best as (select a.doc_id, a.lang as language, {share('a.hits', 'a.hits + b.hits')} as language_score
  from ranked a join ranked b on a.doc_id = b.doc_id and a.place = 1 and b.place = 2),
scored as (select s.doc_id, language, language_score from {source} s left join best using (doc_id))"""


def language_reason(allowed) -> str:
    return (
        f"case when not coalesce(language in ({', '.join(quote(a) for a in allowed)}) and language_score >= 0.65::DOUBLE, false)"
        " then 'other_language' end"
    )


LANGUAGE_FILTER = f"""with {PROFILE_CTE}, {language_ctes('documents')}
select doc_id, language, language_score, {language_reason(['en'])} as reason from scored"""

LANGUAGE_LABEL = f"""with {PROFILE_CTE}, {language_ctes('documents')}
select d.lang, s.language, count(*)::BIGINT as documents, 0::BIGINT as rejected
from documents d join scored s using (doc_id) group by 1, 2"""

PARTS = {
    "paragraph": r"list_filter(regexp_split_to_array(text, '\n\n+'), lambda x: x <> '')",
    "line": "list_filter(string_split(text, chr(10)), lambda x: x <> '')",
}


def line_shares() -> dict[str, str]:
    out = {}
    for name, parts in PARTS.items():
        once = f"list_distinct({parts})"
        out[f"dup_{name}_share"] = share(f"len({parts}) - len({once})", f"len({parts})")
        out[f"dup_{name}_char_share"] = share(
            f"length(array_to_string({parts}, '')) - length(array_to_string({once}, ''))", "length(text)"
        )
    return out


LINE_SHARES = ", ".join(f"{v} as {k}" for k, v in line_shares().items())
REPETITION_LINES = f"select doc_id, {LINE_SHARES} from documents"


def ngram_ctes(source: str) -> str:
    """CTEs to ``grams(doc_id, top_n_char_share, dup_n_char_share)``, by windows over words."""
    ctes = [
        f"gw as (select doc_id, unnest(ws) as w, generate_subscripts(ws, 1) as i from (select doc_id, {WORDS.format('text')} as ws from {source}))"
    ]
    sizes = [*TOP_NGRAM_SHARES, *DUP_NGRAM_SHARES]
    columns, joins = [], []
    for n in sizes:
        leads = ", ".join(["w"] + [f"lead(w, {k}) over d" for k in range(1, n)])
        last = "w" if n == 1 else f"lead(w, {n - 1}) over d"
        ctes.append(
            f"g{n} as (select doc_id, i, w, case when {last} is not null then concat_ws(' ', {leads}) end as g from gw"
            " window d as (partition by doc_id order by i))"
        )
        if n in TOP_NGRAM_SHARES:
            ctes.append(
                f"t{n} as (select doc_id, max_by(c * len, c * 10000000 + len) as chars from"
                f" (select doc_id, g, count(*) as c, length(g) as len from g{n} where g is not null group by 1, 2) group by 1)"
            )
            name = f"top_{n}"
        else:
            ctes.append(
                f"f{n} as (select doc_id, i, w, case when g is not null and count(*) over (partition by doc_id, g) > 1"
                f" then 1 else 0 end as dup from g{n})"
            )
            ctes.append(
                f"t{n} as (select doc_id, sum(length(w)) filter (covered = 1) as chars from (select doc_id, w, max(dup) over"
                f" (partition by doc_id order by i rows between {n - 1} preceding and current row) as covered from f{n}) group by 1)"
            )
            name = f"dup_{n}"
        columns.append(f"{share(f'coalesce(t{n}.chars, 0)', 'length(s.text)')} as {name}_char_share")
        joins.append(f"left join t{n} on t{n}.doc_id = s.doc_id")
    ctes.append(f"grams as (select s.doc_id, {', '.join(columns)} from {source} s {' '.join(joins)})")
    return ",\n".join(ctes)


REPETITION_NGRAMS = f"with {ngram_ctes('documents')} select * from grams"

LINE_RULES = [
    ("dup_paragraph_share", "dup_paragraph_share > 0.30::DOUBLE"),
    ("dup_paragraph_char_share", "dup_paragraph_char_share > 0.20::DOUBLE"),
    ("dup_line_share", "dup_line_share > 0.30::DOUBLE"),
    ("dup_line_char_share", "dup_line_char_share > 0.20::DOUBLE"),
]
GRAM_RULES = [
    (f"{kind}_{n}_gram", f"{kind}_{n}_char_share > {limit}::DOUBLE")
    for kind, shares in (("top", TOP_NGRAM_SHARES), ("dup", DUP_NGRAM_SHARES))
    for n, limit in shares.items()
]


def repetition_ctes(source: str) -> str:
    return (
        f"{ngram_ctes(source)}, rl as (select doc_id, {LINE_SHARES} from {source}),\n"
        f"repetition as (select doc_id, {first_reason(LINE_RULES + GRAM_RULES)} as reason from rl join grams using (doc_id))"
    )


REPETITION_FILTER = f"with {repetition_ctes('documents')} select doc_id, reason from repetition"

LINE_LIST = PARTS["line"]


def quality_ctes(source: str) -> str:
    w = WORDS.format("text")
    rules = [
        ("too_few_words", "n < 50"),
        ("too_many_words", "n > 100000"),
        ("short_words", f"{share('chars', 'n')} < 3.0::DOUBLE"),
        ("long_words", f"{share('chars', 'n')} > 10.0::DOUBLE"),
        ("too_many_hashes", f"{share('hashes', 'n')} > 0.1::DOUBLE"),
        ("too_many_ellipses", f"{share('ellipses', 'n')} > 0.1::DOUBLE"),
        ("too_many_bullets", f"{share('bullets', 'nlines')} > 0.9::DOUBLE"),
        ("too_many_ellipsis_lines", f"{share('trailing_n', 'nlines')} > 0.3::DOUBLE"),
        ("too_few_alpha_words", f"{share('alpha', 'n')} < 0.8::DOUBLE"),
        ("too_few_stop_words", "stops < 2"),
    ]
    return rf"""qa as (select doc_id, text, {w} as ws, {LINE_LIST} as ls from {source}),
qm as (select doc_id, len(ws) as n, length(array_to_string(ws, '')) as chars,
  len(list_filter(ws, lambda x: regexp_matches(x, '\p{{L}}'))) as alpha,
  len(list_distinct(list_filter(list_transform(ws, lambda x: lower(x)), lambda x: list_contains({string_list(english_stop_words())}, x)))) as stops,
  length(text) - length(replace(text, '#', '')) as hashes,
  len(regexp_extract_all(text, '\.\.\.|…')) as ellipses, len(ls) as nlines,
  len(list_filter(ls, lambda x: regexp_matches(x, '^\s*[•‣●▪*-]'))) as bullets,
  len(list_filter(ls, lambda x: ends_with(x, '...') or ends_with(x, '…'))) as trailing_n
  from qa),
quality as (select doc_id, {first_reason(rules)} as reason from qm)"""


def clean_ctes(source: str) -> str:
    policy = " and ".join(f"not contains(lower(x), {quote(p)})" for p in POLICY_PHRASES)
    keep = rf"""len(regexp_extract_all(x, '\S+')) >= 3 and not exists_long(x) and right(x, 1) in ('.', '!', '?', '"', '”')
      and not ends_with(x, '...') and not ends_with(x, '…') and not contains(lower(x), 'javascript') and {policy}"""
    keep = keep.replace(
        "not exists_long(x)", r"len(list_filter(regexp_extract_all(x, '\S+'), lambda t: length(t) > 1000)) = 0"
    )
    rules = [
        ("lorem_ipsum", "contains(lower(text), 'lorem ipsum')"),
        ("curly_bracket", "contains(text, '{')"),
        ("too_few_sentences", f"len({SENTENCES.format('cleaned')}) < 5"),
    ]
    return rf"""ca as (select doc_id, text, array_to_string(list_filter(list_transform(string_split(text, chr(10)),
    lambda y: trim(regexp_replace(y, '\[[0-9]*\]', '', 'g'))), lambda x: {keep}), chr(10)) as cleaned from {source}),
cleaned as (select doc_id, text as before, cleaned as text, {first_reason(rules)} as reason from ca)"""


def structure_ctes(source: str) -> str:
    rules = [
        ("no_lines", "len(ls) = 0"),
        (
            "few_line_ends",
            share("len(list_filter(ls, lambda x: right(x, 1) in ('.', '!', '?', '\"', '”')))", "len(ls)") + " <= 0.12::DOUBLE",
        ),
        ("short_lines", share("len(list_filter(ls, lambda x: length(x) < 30))", "len(ls)") + " >= 0.67::DOUBLE"),
        (
            "dup_line_chars",
            share("length(array_to_string(ls, '')) - length(array_to_string(list_distinct(ls), ''))", "length(text)")
            + " >= 0.10::DOUBLE",
        ),
    ]
    return f"""sa as (select doc_id, text, {LINE_LIST} as ls from {source}),
structure as (select doc_id, {first_reason(rules)} as reason from sa)"""


QUALITY_FILTER = f"with {quality_ctes('documents')} select doc_id, reason from quality"
LINE_CLEAN_FILTER = f"with {clean_ctes('documents')} select doc_id, text, reason from cleaned"
LINE_STRUCTURE_FILTER = f"with {structure_ctes('documents')} select doc_id, reason from structure"
TOKEN_COUNTS = f"select doc_id, len({TOKENS.format('text')})::BIGINT as token_count from documents"


def chain_ctes(allowed) -> str:
    """CTEs to ``result(doc_id, text, rejected_by, reason, token_count)``: each filter
    sees only what its predecessors have left."""

    def left(name: str, source: str, verdict: str) -> str:
        return f"{name} as (select s.doc_id, s.text from {source} s join {verdict} v using (doc_id) where v.reason is null)"

    def rejected(folder: str, source: str, verdict: str, text: str = "s.text") -> str:
        return (
            f"select doc_id, {text} as text, {quote(folder)} as rejected_by, v.reason, null::BIGINT as token_count"
            f" from {source} s join {verdict} v using (doc_id) where v.reason is not null"
        )

    return f"""{PROFILE_CTE}, {repair_steps('documents')}, {language_ctes('repaired')},
lang_verdict as (select doc_id, {language_reason(allowed)} as reason from scored),
{left('c1', 'repaired', 'lang_verdict')}, {repetition_ctes('c1')},
{left('c2', 'c1', 'repetition')}, {quality_ctes('c2')},
{left('c3', 'c2', 'quality')}, {clean_ctes('c3')},
c4 as (select doc_id, text from cleaned where reason is null), {structure_ctes('c4')},
{left('c5', 'c4', 'structure')},
result as (select doc_id, text, null as rejected_by, null as reason, len({TOKENS.format('text')})::BIGINT as token_count from c5
  union all {rejected('non_danish_documents', 'repaired', 'lang_verdict')}
  union all {rejected('gopher_repetition', 'c1', 'repetition')}
  union all {rejected('gopher_quality', 'c2', 'quality')}
  union all select doc_id, before, 'c4_quality', reason, null from cleaned where reason is not null
  union all {rejected('fineweb_quality', 'c4', 'structure')})"""


FILTER_CHAIN = f"with {chain_ctes(['en'])} select doc_id, text, rejected_by, reason, token_count from result"
EXCLUSIONS = f"with {chain_ctes(['en'])} select doc_id, rejected_by, reason from result where rejected_by is not null"
FILTER_STATS = f"""with {chain_ctes(LANGUAGES)}
select d.source as dataset, coalesce(rejected_by, 'kept') as outcome, count(*)::BIGINT as documents,
  sum(length(r.text))::BIGINT as chars, sum(token_count)::BIGINT as tokens
from result r join documents d using (doc_id) group by rollup (1, 2)"""

# -- deduplication ----------------------------------------------------------------------

WINDOW_CTE = rf"""parts as (select doc_id, list_transform({PIECES.format(r"lower(regexp_replace(text, '\s+', ' ', 'g'))")},
    lambda s: trim(s)) as p from documents),
pos as (select doc_id, p, unnest(range(0, len(p) - 2)) as pos from parts),
windows as (select doc_id, pos, md5(concat_ws(' ', p[pos + 1], p[pos + 2], p[pos + 3])) as h from pos)"""

SENTENCE_WINDOWS = f"""with {WINDOW_CTE} select doc_id, pos::BIGINT as pos, h,
  row_number() over (partition by doc_id, h order by pos) > 1 as again from windows"""

DUPLICATE_CTE = f"""{WINDOW_CTE},
dups as (select doc_id, pos, h from (select *, row_number() over (partition by h order by doc_id, pos) as place from windows) where place > 1)"""

SENTENCE_DUPLICATES = f"with {DUPLICATE_CTE} select doc_id, pos::BIGINT as pos, h from dups"

SENTENCE_DEDUP = f"""with {DUPLICATE_CTE},
pieces as (select doc_id, unnest(ss) as s, generate_subscripts(ss, 1) - 1 as pos from (select doc_id, {PIECES.format('text')} as ss from documents)),
covered as (select distinct doc_id, pos + unnest([0, 1, 2]) as pos from dups),
rebuilt as (select p.doc_id, coalesce(string_agg(s, '' order by p.pos) filter (c.pos is null), '') as text,
    count(c.pos) as removed, count(*) - count(c.pos) as left_over
  from pieces p left join covered c on c.doc_id = p.doc_id and c.pos = p.pos group by 1)
select d.doc_id, case when r.removed > 0 then r.text else d.text end as text, coalesce(r.removed, 0)::BIGINT as removed_sentences,
  case when coalesce(r.removed, 0) = 0 then true else len({WORDS.format('r.text')}) >= 50 and r.left_over >= 1 end as kept
from documents d left join rebuilt r using (doc_id)"""

PRIME = 2147483647


def signature_ctes(scheme: str = "permutations") -> str:
    coefficients = ", ".join(f"({k}, {a}, {b}, {c}, {d})" for k, (a, b, c, d) in enumerate(MD5_PLAN.coefficients()))
    shingles = rf"""mw as (select doc_id, {WORDS.format('lower(text)')} as ws from documents),
mi as (select doc_id, ws, unnest(range(1, len(ws) - 3)) as i from mw),
sh as (select distinct doc_id, md5(concat_ws(' ', ws[i], ws[i + 1], ws[i + 2], ws[i + 3], ws[i + 4])) as h from mi)"""
    if scheme == "one_permutation":
        size, step = MD5_PLAN.size, rotation_step(MD5_PLAN.size)
        return rf"""{shingles},
packed as (select doc_id, ('0x' || substr(h, 1, 7) || substr(h, 9, 7))::BIGINT as v from sh),
bins as (select doc_id, v % {size} as bin, min(v // {size}) as m from packed group by 1, 2),
grid as (select doc_id, k from (select distinct doc_id from bins), range({size}) r(k)),
sig as (select g.doc_id, g.k, arg_min(b.m + ((b.bin - g.k + {size}) % {size}) * {step}, (b.bin - g.k + {size}) % {size}) as value
  from grid g join bins b using (doc_id) group by 1, 2)"""
    return rf"""{shingles},
lanes as (select doc_id, ('0x' || substr(h, 1, 7))::BIGINT as one, ('0x' || substr(h, 9, 7))::BIGINT as two from sh),
coef(k, a, b, c, d) as (values {coefficients}),
sig as (select doc_id, k, min(((a::BIGINT * one + b) % {PRIME}) * 2147483648 + ((c::BIGINT * two + d) % {PRIME})) as value
  from lanes cross join coef group by 1, 2)"""


MINHASH_SIGNATURES = f"with {signature_ctes()} select doc_id, k::BIGINT as k, value::BIGINT as value from sig"

EDGE_CTE = f"""{signature_ctes()},
bands as (select doc_id, k // {MD5_PLAN.rows} as bucket, string_agg(value, ',' order by k) as band from sig group by 1, 2),
edges as (select distinct doc_id as src, dst from (select doc_id, min(doc_id) over (partition by bucket, band) as dst from bands) where doc_id > dst)"""

MINHASH_EDGES = f"with {EDGE_CTE} select src, dst from edges"

CLUSTER_CTE = f"""{EDGE_CTE},
links as (select src as a, dst as b from edges union select dst, src from edges),
reach as (select a as node, a as peer from links union select r.node, l.b from reach r join links l on l.a = r.peer),
members as (select node, min(peer) as cluster from reach group by 1)"""

CLUSTERS = f"with recursive {CLUSTER_CTE} select node, cluster from members"
CLUSTER_REPORT = f"with recursive {CLUSTER_CTE} select cluster, count(*)::BIGINT as size from members group by 1"
MINHASH_DEDUP = f"""with recursive {CLUSTER_CTE}
select d.doc_id, coalesce(m.cluster = d.doc_id, true) as kept, coalesce(m.cluster, d.doc_id) as survivor
from documents d left join members m on m.node = d.doc_id"""

OPH_SIGNATURES = f"with {signature_ctes('one_permutation')} select doc_id, k::BIGINT as k, value::BIGINT as value from sig"

OPH_CLUSTER_CTE = CLUSTER_CTE.replace(signature_ctes(), signature_ctes("one_permutation"))
MINHASH_DEDUP_OPH = f"""with recursive {OPH_CLUSTER_CTE}
select d.doc_id, coalesce(m.cluster = d.doc_id, true) as kept, coalesce(m.cluster, d.doc_id) as survivor
from documents d left join members m on m.node = d.doc_id"""

# -- whole jobs ---------------------------------------------------------------------------

JOB_METADATA = """'{"n":' || n_chars || ',"o":{"lang":"' || lang || '","s":["' || source || '"]}}'"""
JOB_SENTENCES = f"""select r.doc_id, r.text, {JOB_METADATA} as metadata, r.kept
from ({SENTENCE_DEDUP}) r join documents m using (doc_id)"""
JOB_MINHASH = f"""select r.doc_id, m.text, {JOB_METADATA} as metadata, r.kept
from ({MINHASH_DEDUP}) r join documents m using (doc_id)"""
JOB_FILTER = f"with {chain_ctes(['en'])} select doc_id, text, rejected_by from result"


def format_sql() -> str:
    page = html_sql().replace(f"replace(html, '</article>', {ADDED})", "html")
    return f"select p.page_id, md5(p.html) as as_text, h.text as as_html from pages p left join ({page}) h using (page_id)"


# -- sources and sinks --------------------------------------------------------------------

METADATA_ROUNDTRIP = """select doc_id as id, text, lang, source, n_chars::VARCHAR as n_chars, 'supplied' as origin from documents"""

SKIP_LIMIT = "select lang as text, doc_id as id from documents order by doc_id limit 50 offset 5"

NULLABLE = """select event_id, null::VARCHAR as nothing, event_type, 0::BIGINT as none_size, 'string' as nothing_type,
  'array<string>' as none_type, 'struct<event_type:string,v:string>' as s_type from events"""

JSONL = "select doc_id, text, lang from documents"

UNION = """select text, lang, null as role, 'documents' as dataset from documents
union all select text, null, null, 'benchmark' from benchmark
union all select text, null, role, 'turns' from conversations"""

ORACLES: dict[str, str] = {
    "collapse_newlines": COLLAPSE,
    "html_to_text": html_sql(),
    "main_text_blocks": main_text_sql(),
    "json_path_text": JSON_TEXT,
    "json_path_list": JSON_LIST,
    "json_mixed_shapes": JSON_SHAPES,
    "extraction_outcomes": OUTCOMES,
    "abbreviations": ABBREVIATIONS,
    "learned_sentences": LEARNED_SENTENCES,
    "clean_mail_body": MAIL,
    "unwrap_urls": UNWRAP,
    "file_metadata": FILE_METADATA,
    "document_records": RECORDS,
    "route_by_suffix": ROUTES,
    "crawl_hosts": HOSTS,
    "crawl_select": CRAWL_SELECT,
    "near_dup_columns": NEAR_DUP,
    "column_pair_shares": pair_shares_sql(),
    "clean_table": CLEAN_TABLE.format(partly="partly,"),
    "strip_newlines": STRIP,
    "repair_text": repair_sql(),
    "language_profiles": PROFILES,
    "language_filter": LANGUAGE_FILTER,
    "language_label": LANGUAGE_LABEL,
    "language_accuracy": LANGUAGE_ACCURACY,
    "repetition_lines": REPETITION_LINES,
    "repetition_ngrams": REPETITION_NGRAMS,
    "repetition_filter": REPETITION_FILTER,
    "quality_filter": QUALITY_FILTER,
    "line_clean_filter": LINE_CLEAN_FILTER,
    "line_structure_filter": LINE_STRUCTURE_FILTER,
    "token_counts": TOKEN_COUNTS,
    "filter_chain": FILTER_CHAIN,
    "filter_stats": FILTER_STATS,
    "exclusion_sink": EXCLUSIONS,
    "sentence_windows": SENTENCE_WINDOWS,
    "sentence_duplicates": SENTENCE_DUPLICATES,
    "sentence_duplicates_batches": SENTENCE_DUPLICATES,
    "sentence_dedup": SENTENCE_DEDUP,
    "minhash_signatures": MINHASH_SIGNATURES,
    "minhash_edges": MINHASH_EDGES,
    "duplicate_clusters": CLUSTERS,
    "cluster_report": CLUSTER_REPORT,
    "minhash_dedup": MINHASH_DEDUP,
    "oph_signatures": OPH_SIGNATURES,
    "minhash_dedup_oph": MINHASH_DEDUP_OPH,
    "job_filter": JOB_FILTER,
    "job_sentence_dedup": JOB_SENTENCES,
    "job_minhash_dedup": JOB_MINHASH,
    "choose_format": format_sql(),
    "metadata_roundtrip": METADATA_ROUNDTRIP,
    "read_skip_limit": SKIP_LIMIT,
    "nullable_schema": NULLABLE,
    "jsonl_roundtrip": JSONL,
    "dataset_union": UNION,
}
