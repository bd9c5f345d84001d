"""DuckDB SQL for the registered queries, over the same whole tables."""

from __future__ import annotations

# ------------------------------------------------------------- shared fragments


def tokens(column: str, bounds: str = ">= 1") -> str:
    return (
        f"list_filter(string_split_regex(lower({column}), '[^\\p{{L}}\\p{{N}}]+'), "
        f"lambda t: length(t) {bounds})"
    )


SPACES = r"[\s\x0B\x1C-\x1F\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
NOT_SPACE = SPACES.replace("[", "[^", 1)


def not_blank(column: str) -> str:
    return f"regexp_matches({column}, '{NOT_SPACE}')"


def word_hash(column: str) -> str:
    return f"('0x' || substr(md5({column}), 1, 7))::bigint"


def suffix(column: str) -> str:
    return f"lower(regexp_extract({column}, '[^/](\\.[^./]+)$', 1))"


CODE = "('.py', '.js', '.java', '.cpp', '.c', '.h', '.rs', '.go')"
MARKUP = "('.html', '.htm', '.xhtml', '.xml', '.svg')"


def content_type(column: str) -> str:
    return (
        f"case when {column} in {CODE} then 'code' when {column} in {MARKUP} then 'markup' "
        "else 'document' end"
    )


TOKENS = f"""
tok as materialized (select doc_id as chunk_id, {tokens('text')} as tokens from documents),
qtok as materialized (select item_id as query_id, text as query, {tokens('text')} as tokens from benchmark),
stats as materialized (select count(*) as n_chunks, avg(len(tokens)) as avg_len from tok),
cnt as materialized (
  select chunk_id, dl, term, count(*) as tf
  from (select chunk_id, len(tokens) as dl, unnest(tokens) as term from tok) group by all),
qcnt as materialized (
  select query_id, dl, term, count(*) as tf
  from (select query_id, len(tokens) as dl, unnest(tokens) as term from qtok) group by all),
idf as materialized (
  select term, df, ln(1 + (n_chunks - df + 0.5::double) / (df + 0.5::double)) as idf
  from (select term, count(*) as df from cnt group by term), stats)
"""

WEIGHT = "tf * 2.2::double / (tf + 1.2::double * (0.25::double + 0.75::double * dl / avg_len))"

BM25 = f"""
w as materialized (select chunk_id, term, {WEIGHT} as weight from cnt, stats),
qw as materialized (select query_id, term, {WEIGHT} as weight from qcnt, stats),
bm25_dot as materialized (
  select query_id, chunk_id, round(sum(qw.weight * idf * w.weight), 6) as score
  from qw join idf using (term) join w using (term) group by all)
"""

NEIGHBOURS = """
tokp as materialized (
  select chunk_id, unnest(tokens) as term, generate_subscripts(tokens, 1) as pos from tok),
following as materialized (
  select term, lead(term, 1) over w as t1, lead(term, 2) over w as t2,
         lead(term, 3) over w as t3, lead(term, 4) over w as t4
  from tokp window w as (partition by chunk_id order by pos)),
both_ways as materialized (
  select term as a, o as b from (select term, unnest([t1, t2, t3, t4]) as o from following)
  where o is not null and o <> term),
pairs as materialized (
  select a, b, count(*) as n from (
    select a, b from both_ways union all select b as a, a as b from both_ways) group by all),
margins as materialized (select a, sum(n) as m from pairs group by a),
total as materialized (select sum(m) as s from margins),
strengths as materialized (
  select p.a as term, p.b as neighbour,
         round(ln(n::double * s / (l.m::double * r.m)) / -ln(n::double / s), 6) as strength
  from pairs p join margins l on l.a = p.a join margins r on r.a = p.b, total),
near as materialized (
  select term, neighbour, strength from strengths where strength > 0
  qualify row_number() over (partition by term order by strength desc, neighbour) <= 3)
"""


def expanded(name: str, counts: str, key: str) -> str:
    return f"""
{name}_own as materialized (select {key}, term, ln(1 + tf::double) as weight from {counts}),
{name} as materialized (
  select {key}, term, max(weight) as weight from (
    select {key}, term, weight from {name}_own
    union all
    select {key}, neighbour as term, weight * strength * 0.5::double as weight
    from {name}_own join near using (term)) group by all)
"""


EXPANDED = expanded("wide", "cnt", "chunk_id") + "," + expanded("qwide", "qcnt", "query_id") + """,
wide_dot as materialized (
  select query_id, chunk_id, round(sum(qwide.weight * wide.weight), 6) as score
  from qwide join wide using (term) group by all)
"""


def hashed(name: str, source: str, key: str) -> str:
    """CTEs giving ``name(key, v)``: 64 floats of a table with a tokens column."""
    return f"""
{name}_sums as materialized (
  select {key}, h % 64 as b, sum(1 - 2 * ((h // 64) % 2)) as s
  from (select {key}, {word_hash('t')} as h from (select {key}, unnest(tokens) as t from {source}))
  group by all),
{name}_norm as materialized (
  select {key}, sqrt(sum(s * s)::double) as norm from {name}_sums group by all),
{name} as materialized (
  select {key}, list(coalesce(case when norm > 0 then s::double / norm end, 0::double)::float::double order by g.b) as v
  from (select distinct {key} from {source}) cross join (select unnest(range(64)) as b) g
  left join {name}_sums using ({key}, b) left join {name}_norm using ({key}) group by {key})
"""


def cosine(a: str, b: str) -> str:
    return (
        f"list_dot_product({a}, {b}) / "
        f"(sqrt(list_dot_product({a}, {a})) * sqrt(list_dot_product({b}, {b})))"
    )


def nonzero(*columns: str) -> str:
    return " and ".join(f"list_dot_product({c}, {c}) > 0" for c in columns)


def top(source: str, k: int, extra: str = "") -> str:
    """Best ``k`` rows per query of ``source(query_id, chunk_id, score)``."""
    return (
        f"select query_id, chunk_id, score, {extra}"
        "row_number() over (partition by query_id order by score desc, chunk_id) as rank "
        f"from {source} qualify rank <= {k}"
    )


TEXT_DENSE = hashed("dvec", "tok", "chunk_id") + "," + hashed("qvec", "qtok", "query_id") + f""",
text_cos as materialized (
  select query_id, chunk_id, round({cosine('q.v', 'd.v')}, 6) as score
  from qvec q cross join dvec d where {nonzero('q.v', 'd.v')})
"""


def channels(k: int, among: str = "{}") -> str:
    """Candidates of the three channels; ``among`` turns a scored table into the
    part of it that may be found."""
    return f"""
cand as materialized (
  select 'dense' as channel, query_id, chunk_id, rank from ({top(among.format('text_cos'), k)})
  union all select 'expanded', query_id, chunk_id, rank from ({top(among.format('wide_dot'), k)})
  union all select 'bm25', query_id, chunk_id, rank from ({top(among.format('bm25_dot'), k)}))
"""


FUSED = f"""
fused as materialized (
  {top("(select query_id, chunk_id, round(sum(1::double / (60 + rank)), 6) as score from cand group by all)", 50)})
"""

COVERAGE = """
qterm as materialized (
  select query_id, term, coalesce(idf, ln(1 + (n_chunks + 0.5::double) / 0.5::double)) as idf
  from (select distinct query_id, term from qcnt) left join idf using (term), stats),
qmass as materialized (select query_id, sum(idf) as mass from qterm group by 1)
"""


def coverage(hits: str) -> str:
    return f"""
covered as materialized (
  select h.query_id, h.chunk_id, h.score, h.rank as fused_rank,
         round(coalesce(sum(case when c.term is not null then idf end), 0) / any_value(mass), 6) as rerank_score
  from {hits} h join qterm using (query_id) join qmass using (query_id)
  left join cnt c on c.chunk_id = h.chunk_id and c.term = qterm.term
  group by h.query_id, h.chunk_id, h.score, h.rank),
reranked as materialized (
  select *, row_number() over (partition by query_id order by rerank_score desc, fused_rank) as rank
  from covered qualify rank <= 10)
"""


HYBRID = ",".join([TOKENS, BM25, NEIGHBOURS, EXPANDED, TEXT_DENSE])

VEC = """
corpus as materialized (select vec_id as chunk_id, embedding::double[] as v from embeddings),
cos as materialized (
  select q.chunk_id as query_id, c.chunk_id, round({cos}, 6) as score
  from corpus q cross join corpus c)
""".format(cos=cosine("q.v", "c.v"))

BOUNDS = """
bounds as materialized (
  select quantile_disc(x, 0.005) as lo, quantile_disc(x, 0.995) as hi
  from (select unnest(embedding)::double as x from embeddings))
"""

CELLS = """
unit as materialized (
  select chunk_id, list_transform(v, lambda x: x::double / sqrt(list_dot_product(v::double[], v::double[]))) as u
  from corpus where list_dot_product(v::double[], v::double[]) > 0),
centres as materialized (select chunk_id as cell, u as c from unit where chunk_id % 25 = 0),
ranked as materialized (
  select chunk_id, cell, row_number() over (partition by chunk_id
    order by round(list_dot_product(c, c) - 2 * list_dot_product(u, c), 9), cell) as place
  from unit, centres),
near as materialized (
  select query_id, cos.chunk_id, score from cos
  join ranked asked on asked.chunk_id = cos.query_id
  join ranked home on home.chunk_id = cos.chunk_id and home.cell = asked.cell
  where home.place = 1 and asked.place <= (select ceil(count(*) / 4.0) from centres))
"""

CODE_OF = "round((least(greatest(x::double, lo), hi) - lo) / (hi - lo) * 255) - 128"

QUANTIZED = f"""
deq as materialized (
  select chunk_id, list_transform(v, lambda x: lo + (({CODE_OF}) + 128) / 255 * (hi - lo)) as dv
  from corpus, bounds),
qcos as materialized (
  select q.chunk_id as query_id, c.chunk_id, round({cosine('q.v', 'c.dv')}, 6) as score
  from corpus q cross join deq c),
first_pass as materialized ({top('qcos', 30)}),
rescored as materialized (
  {top('(select query_id, chunk_id, cos.score from first_pass join cos using (query_id, chunk_id))', 10)})
"""

# The two rankings are materialized: joined inline, DuckDB 2.0 takes the second
# ranking for the first and reports every id as common.
RANKINGS = f"""
exact10 as materialized ({top('cos', 10)}),
coarse10 as materialized ({top('qcos', 10)})
"""

SIGNATURES = f"""
words as materialized (
  select doc_id as chunk_id, source, {word_hash('w')} as h
  from (select doc_id, source, unnest(list_distinct(list_filter(
      string_split_regex(text, '{SPACES}+'), lambda x: x <> ''))) as w from documents)),
perms as materialized (
  select i, {word_hash("'a' || i")} + 1 as a, {word_hash("'b' || i")} + 1 as b from range(128) r(i)),
sig as materialized (
  select chunk_id, source, i, min((h * a + b) % 2147483647) as value
  from words cross join perms group by all),
bands as materialized (
  select chunk_id, source, i // 16 as band, md5(string_agg(value::varchar, ',' order by i)) as bucket
  from sig group by all)
"""

LSH = """
groups as materialized (
  select band, bucket, count(*) as members, min(chunk_id) as first_id
  from bands group by all having count(*) > 1),
linked as materialized (
  select band, bucket, members, first_id, chunk_id from bands join groups using (band, bucket))
"""


def keep_first(scope: str) -> str:
    """CTEs giving ``decided(scope, kept)``, the kept ids by the sequential rule."""
    return f"""
scoped as materialized (select {scope} as scope, chunk_id, band, bucket from bands),
edges as materialized (
  select b.scope, b.chunk_id, list(distinct a.chunk_id) as earlier
  from scoped a join scoped b on a.scope = b.scope and a.band = b.band and a.bucket = b.bucket
    and a.chunk_id < b.chunk_id group by all),
ordered as materialized (
  select scope, chunk_id, row_number() over (partition by scope order by chunk_id) as pos,
         coalesce(earlier, []) as earlier
  from (select distinct scope, chunk_id from scoped) left join edges using (scope, chunk_id)),
walk(scope, pos, kept) as (
  select scope, 1::bigint, [chunk_id] from ordered where pos = 1
  union all
  select o.scope, o.pos,
         case when list_has_any(walk.kept, o.earlier) then walk.kept
              else list_append(walk.kept, o.chunk_id) end
  from walk join ordered o on o.scope = walk.scope and o.pos = walk.pos + 1),
decided as materialized (
  select unnest(kept) as chunk_id from walk
  where (scope, pos) in (select (scope, max(pos)) from ordered group by scope))
"""


BLOCK_TAGS = "h1|h2|h3|p|li|pre|code"
SECTIONS = "article|section|main|nav|header|footer|aside|body|html"
TAG_EVENT = rf"(?i)</?(?:{BLOCK_TAGS})(?:\s[^>]*)?>|</(?:{SECTIONS})\s*>"


def plain(column: str) -> str:
    text = "p"
    for entity, character in (
        ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&apos;", "''"),
        ("&nbsp;", "\u00a0"), ("&copy;", "©"), ("&middot;", "·"), ("&hellip;", "…"),
        ("&mdash;", "—"), ("&ndash;", "–"), ("&amp;", "&"),
    ):
        text = f"replace({text}, '{entity}', '{character}')"
    stripped = f"regexp_replace({text}, '^{SPACES}+|{SPACES}+$', '', 'g')"
    pieces = f"list_transform(string_split_regex({column}, '(?s)<[^>]*>'), lambda p: {stripped})"
    return f"array_to_string(list_filter({pieces}, lambda p: p <> ''), ' ')"


def leaf(html: str) -> str:
    return rf"""
cleaned as materialized (
  select page_id, regexp_replace({html},
    '(?is)<!--.*?-->|<script\b.*?</script[^>]*>|<style\b.*?</style[^>]*>', ' ', 'g') as h from pages),
events_of as materialized (
  select page_id, string_split_regex(h, '{TAG_EVENT}') as segs,
         list_concat([''], regexp_extract_all(h, '{TAG_EVENT}')) as tags from cleaned),
seg as materialized (
  select page_id, unnest(segs) as segment, unnest(tags) as tag, generate_subscripts(segs, 1) as pos
  from events_of),
stepped as materialized (
  select *, regexp_matches(tag, '(?i)^</(?:{SECTIONS})\s*>') as closes,
         case when tag = '' or regexp_matches(tag, '(?i)^</(?:{SECTIONS})\s*>') then 0
              when tag like '</%' then -1 else 1 end as step from seg),
sectioned as materialized (
  select *, sum(closes::int) over (partition by page_id order by pos) as section from stepped),
summed as materialized (
  select *, sum(step) over (partition by page_id, section order by pos) as total from sectioned),
lowest as materialized (
  select *, min(total) over (partition by page_id, section order by pos) as low from summed),
blocks as materialized (
  select page_id, pos, {plain('segment')} as text from lowest where total - least(0, low) > 0),
numbered as materialized (
  select page_id as doc_id, row_number() over (partition by page_id order by pos) - 1 as block_no, text
  from blocks where text <> '')
"""


SENTENCES = f"""
marked as materialized (
  select doc_id, string_split(regexp_replace(text, '([.!?][ \\t\\r\\n\\f]+)', '\\1' || chr(30), 'g'), chr(30)) as parts
  from documents where {not_blank('text')}),
pieces as materialized (
  select * from (select doc_id, unnest(parts) as sentence, generate_subscripts(parts, 1) as pos from marked)
  where sentence <> ''),
near as materialized (
  select *, string_agg(sentence, '') over (
    partition by doc_id order by pos rows between 1 preceding and 1 following) as seen from pieces),
sent as materialized (
  select doc_id, pos, sentence, doc_id::varchar || '-' || pos as sid, {tokens('seen')} as tokens from near)
"""

SEMANTIC = SENTENCES + "," + hashed("svec", "sent", "sid") + f""",
adjacent as materialized (
  select doc_id, pos, sentence, v, lag(v) over (partition by doc_id order by pos) as before
  from sent join svec using (sid)),
spaced as materialized (
  select doc_id, pos, sentence,
         case when before is not null then
           round(1 - case when {nonzero('v', 'before')} then {cosine('v', 'before')} else 0 end, 6) end as dist
  from adjacent),
cuts as materialized (
  select doc_id, round(quantile_cont(dist, 0.95), 9) as cut from spaced group by doc_id),
started as materialized (
  select doc_id, pos, sentence, coalesce((dist > cut)::int, 0) as start from spaced join cuts using (doc_id)),
placed as materialized (
  select *, sum(start) over (partition by doc_id order by pos) as block_no from started)
"""

READINGS = """
readings as materialized (
  select user_id as host, ts, event_id, least(value, 100.0::double) as cpu_percent,
         round(value / 5, 2) as mem_percent, round(24 - value / 20, 2) as mem_available_gb,
         case when event_type = 'error' then 0::double
              when event_type = 'view' then round(value / 4, 1) end as cpu_temp_c,
         case when event_type = 'click' then round(value / 5, 1) end as gpu_temp_c
  from events),
pressed as materialized (
  select *, case
    when cpu_temp_c <> 0 and cpu_temp_c > 85 then 'CPU Temp High (' || cpu_temp_c::varchar || '°C)'
    when gpu_temp_c <> 0 and gpu_temp_c > 83 then 'GPU Temp High (' || gpu_temp_c::varchar || '°C)'
    when cpu_percent > 80 then 'CPU High (' || cpu_percent::varchar || '%)'
    when mem_percent > 70 then 'Memory High (' || mem_percent::varchar || '%)'
    when mem_available_gb < 4 then
      'Memory Low (' || round(mem_available_gb, 1)::decimal(20, 1)::varchar || 'GB)'
    else '' end as reason
  from readings)
"""


def build(ctes: list[str], select: str, recursive: bool = False) -> str:
    body = ",".join(part.strip() for part in ctes)
    return f"with {'recursive ' if recursive else ''}{body}\n{select}"


SQL = {
    "classify_file": f"""
select page_id, url as source, s as file_type, {content_type('s')} as content_type,
  case s when '.py' then 'python' when '.js' then 'javascript' when '.java' then 'java'
    when '.cpp' then 'cpp' when '.c' then 'c' when '.h' then 'c' when '.rs' then 'rust'
    when '.go' then 'go' end as language,
  case when s in {CODE} then 'code' when s in ('.html', '.htm') then 'html'
    when s in {MARKUP} then 'xml' else 'document' end as splitter
from (select page_id, url, {suffix('url')} as s from pages)""",
    "sample_first": "select doc_id, source from documents order by doc_id limit 20",
    "scan_documents": """
select conv_id, string_agg(text, chr(10) || chr(10) order by turn) as text
from conversations group by conv_id""",
    "normalize_nfc": "select doc_id, nfc_normalize(text) as text from documents",
    "drop_blank": f"select doc_id, text from documents where {not_blank('text')}",
    "with_metadata": f"""
select page_id, url as source, s as file_type, {content_type('s')} as content_type
from (select page_id, url, {suffix('url')} as s from pages)""",
    "flatten_payload": f"""
select page_id, html as text, url as source, s as file_type, {content_type('s')} as content_type
from (select page_id, url, html, {suffix('url')} as s from pages)""",
    "tokenize": f"""
select term, count(*) as n from (select unnest({tokens('text')}) as term from documents) group by term""",
    "whitespace_words": f"""
select word, count(*) as n from (
  select unnest(list_distinct(list_filter(string_split_regex(text, '{SPACES}+'), lambda x: x <> ''))) as word
  from documents) group by word""",
    "project_hits": build(
        [TOKENS, BM25],
        f"select query_id, rank, chunk_id, score, source, text from ({top('bm25_dot', 10)}) "
        "join documents on doc_id = chunk_id",
    ),
    "filter_payload": "select doc_id as chunk_id, source from documents where source in ('src1', 'src7')",
    "match_text": build(
        [
            f"""lines as materialized (
  select item_id::varchar || '-' || (generate_subscripts(parts, 1) - 1) as query_id, unnest(parts) as query
  from (select item_id, string_split_regex(text, '[.,:\\n]') as parts from benchmark)),
wanted as materialized (
  select query_id, list_distinct({tokens('query', 'between 2 and 20')}) as tokens from lines),
terms as materialized (select query_id, len(tokens) as wanted, unnest(tokens) as term from wanted),
has as materialized (
  select distinct doc_id as chunk_id, term from (
    select doc_id, unnest({tokens('text')}) as term from documents))"""
        ],
        "select query_id, chunk_id from terms join has using (term) "
        "group by query_id, wanted, chunk_id having count(*) = wanted",
    ),
    "min_score": build([TOKENS, BM25], f"select * from ({top('bm25_dot', 10)}) where score >= 20"),
    "snippet": "select doc_id as chunk_id, substr(text, 1, 100) as snippet from documents",
    "html_blocks": build([leaf("html")], "select * from numbered"),
    "xml_text": f"""
select page_id as doc_id, 0 as block_no, text from (
  select page_id, {plain("regexp_replace(regexp_replace(html, '(?s)<!\\[CDATA\\[(.*?)\\]\\]>', '\\1', 'g'), '(?s)<!--.*?-->|<\\?.*?\\?>', '', 'g')")} as text
  from pages) where text <> ''""",
    "code_blocks": build(
        [
            rf"""programs as materialized (
  select conv_id as doc_id, string_agg('@turn' || chr(10) || 'def ' || role || '_' || turn || '():' ||
    chr(10) || '    ' || replace(text, chr(10), chr(10) || '    '), chr(10) || chr(10) order by turn) as text
  from conversations group by conv_id),
lines as materialized (
  select doc_id, unnest(ls) as line, generate_subscripts(ls, 1) as pos
  from (select doc_id, string_split(text, chr(10)) as ls from programs)),
flagged as materialized (
  select *, (regexp_matches(line, '^(async def|def|class)\s|^@') and not coalesce(
    starts_with(lag(line) over (partition by doc_id order by pos), '@'), false))::int as start from lines),
parts as materialized (
  select *, sum(start) over (partition by doc_id order by pos) as part from flagged),
cut as materialized (
  select *, (row_number() over (partition by doc_id, part order by pos) - 1) // 6 as cut from parts),
texts as materialized (
  select doc_id, part, cut, string_agg(line, chr(10) order by pos) as text from cut group by all)"""
        ],
        "select doc_id, row_number() over (partition by doc_id order by part, cut) - 1 as block_no, text "
        f"from texts where {not_blank('text')}",
    ),
    "semantic_chunks": build(
        [SEMANTIC],
        "select doc_id, block_no, string_agg(sentence, '' order by pos) as text from placed group by all",
    ),
    "process_markup": build(
        [leaf("nfc_normalize(html)")],
        "select '/corpus/page' || doc_id || '.htm' as source, block_no as chunk_no, text, "
        "'.htm' as file_type, 'markup' as content_type from numbered",
    ),
    "minhash_signature": build([SIGNATURES], "select chunk_id, i, value from sig"),
    "lsh_candidates": build([SIGNATURES, LSH], "select * from linked"),
    "lsh_candidates_verified": build(
        [
            SIGNATURES, LSH,
            """alike as materialized (
  select p.first_id, p.chunk_id, round(count(*) filter (a.value = b.value) / 128::double, 6) as similarity
  from (select distinct first_id, chunk_id from linked) p
  join sig a on a.chunk_id = p.chunk_id join sig b on b.chunk_id = p.first_id and a.i = b.i group by all)"""
        ],
        "select band, members, first_id, chunk_id, similarity from linked "
        "join alike using (first_id, chunk_id) where similarity >= 0.85",
    ),
    "dedup_keep_first": build(
        [SIGNATURES, keep_first("source")],
        "select doc_id as chunk_id, doc_id in (select chunk_id from decided) as kept from documents",
        recursive=True,
    ),
    "dedup_corpus": build(
        [SIGNATURES, keep_first("0")],
        "select doc_id as chunk_id, source from documents where doc_id in (select chunk_id from decided)",
        recursive=True,
    ),
    "dedup_report": build(
        [SIGNATURES, keep_first("source")],
        "select source, count(*) as chunks, count(d.chunk_id) as kept, "
        "count(*) - count(d.chunk_id) as removed "
        "from documents left join decided d on d.chunk_id = doc_id group by source",
        recursive=True,
    ),
    "embed_documents": build(
        [TOKENS, TEXT_DENSE],
        "select chunk_id, i - 1 as i, round(x, 5) as x from "
        "(select chunk_id, unnest(v) as x, generate_subscripts(v, 1) as i from dvec)",
    ),
    "embed_queries": build(
        [TOKENS, TEXT_DENSE],
        "select query_id, i - 1 as i, round(x, 5) as x from "
        "(select query_id, unnest(v) as x, generate_subscripts(v, 1) as i from qvec)",
    ),
    "bm25_weights": build([TOKENS, BM25], "select chunk_id, term, round(weight, 6) as weight from w"),
    "idf_table": build([TOKENS], "select term, df, round(idf, 6) as idf from idf"),
    "term_neighbours": build([TOKENS, NEIGHBOURS], "select * from near"),
    "expand_terms": build(
        [TOKENS, NEIGHBOURS, expanded("wide", "cnt", "chunk_id")],
        "select chunk_id, term, round(weight, 6) as weight from wide",
    ),
    "embed_sparse": build(
        [TOKENS, BM25, NEIGHBOURS, expanded("wide", "cnt", "chunk_id")],
        "select chunk_id, channel, count(*) as terms, round(sum(weight), 4) as mass from ("
        "select chunk_id, 'bm25' as channel, weight from w union all "
        "select chunk_id, 'expanded', weight from wide) group by all",
    ),
    "int8_fit": build([BOUNDS], "select round(lo, 6) as lo, round(hi, 6) as hi from bounds"),
    "int8_encode": build(
        [BOUNDS],
        f"select chunk_id, i - 1 as i, ({CODE_OF})::int as code from (select vec_id as chunk_id, "
        "unnest(embedding) as x, generate_subscripts(embedding, 1) as i from embeddings), bounds",
    ),
    "vector_cosine": build(
        [VEC],
        f"select a.chunk_id, round({cosine('a.v', 'b.v')}, 6) as cosine "
        "from corpus a join corpus b on b.chunk_id = a.chunk_id + 1",
    ),
    "sparse_dot": build(
        [TOKENS, BM25],
        "select query_id, chunk_id, round(sum(qw.weight * w.weight), 6) as score "
        "from qw join w using (term) group by all",
    ),
    "attach_vectors": """
select doc_id as chunk_id, source, length(text) as n, len(embedding) as dim
from documents join embeddings on doc_id = vec_id""",
    "intersect_topk": build(
        [VEC, BOUNDS, QUANTIZED, RANKINGS],
        "select query_id, chunk_id from exact10 join rescored using (query_id, chunk_id)",
    ),
    "union_candidates": build([HYBRID, channels(50)], "select * from cand"),
    "gather_chunks": """
select doc_id as chunk_id, text from documents
union all select page_id, html from pages""",
    "dense_topk": build([VEC], top("cos", 10)),
    "ann_topk": build([VEC, CELLS], top("near", 10)),
    "sparse_topk": build([TOKENS, NEIGHBOURS, EXPANDED], top("wide_dot", 10)),
    "bm25_search": build([TOKENS, BM25], top("bm25_dot", 10)),
    "quantized_topk": build([VEC, BOUNDS, QUANTIZED], "select * from rescored"),
    "rrf_fuse": build([HYBRID, channels(250), FUSED], "select * from fused"),
    "rerank": build(
        [TOKENS, BM25, COVERAGE, f"hits50 as materialized ({top('bm25_dot', 50)})", coverage("hits50")],
        "select query_id, chunk_id, score, rerank_score, fused_rank, rank from reranked",
    ),
    "hybrid_search": build(
        [HYBRID, channels(250), FUSED, COVERAGE, coverage("fused")],
        "select query_id, rank, chunk_id, score, rerank_score, source from reranked "
        "join documents on doc_id = chunk_id",
    ),
    "filtered_search": build(
        [
            "documents as materialized (select * from main.documents where source <> 'src7')",
            HYBRID, channels(250), FUSED, COVERAGE, coverage("fused"),
        ],
        "select query_id, rank, chunk_id, score, rerank_score, source from reranked "
        "join documents on doc_id = chunk_id",
    ),
    "matched_search": build(
        [
            HYBRID,
            """allowed as materialized (
  select query_id, chunk_id from (
    select query_id, term from qcnt where length(term) between 2 and 20
    qualify row_number() over (partition by query_id order by length(term) desc, term) = 1)
  join cnt using (term))""",
            channels(250, "(select * from {} semi join allowed using (query_id, chunk_id))"),
            FUSED, COVERAGE, coverage("fused"),
        ],
        "select query_id, rank, chunk_id, score, rerank_score, source from reranked "
        "join documents on doc_id = chunk_id",
    ),
    "exact_ground_truth": build([VEC], f"select query_id, chunk_id from ({top('cos', 10)})"),
    "recall_at_k": build(
        [VEC, BOUNDS, QUANTIZED, RANKINGS],
        "select c.chunk_id as query_id, count(b.chunk_id) / 10::double as recall from corpus c "
        "left join exact10 a on a.query_id = c.chunk_id "
        "left join coarse10 b on b.query_id = a.query_id and b.chunk_id = a.chunk_id group by 1",
    ),
    "quantization_benchmark": build(
        [VEC, BOUNDS, QUANTIZED, RANKINGS],
        "select round(avg(r), 6) as mean_recall from ("
        "select c.chunk_id, count(b.chunk_id) / 10::double as r from corpus c "
        "left join exact10 a on a.query_id = c.chunk_id "
        "left join rescored b on b.query_id = a.query_id and b.chunk_id = a.chunk_id group by 1)",
    ),
    "ingest_metrics": build(
        [
            SIGNATURES, keep_first("source"), TOKENS, NEIGHBOURS, expanded("wide", "cnt", "chunk_id"),
        ],
        "select (select count(distinct source) from documents) as files_processed, "
        "(select count(*) from documents) as initial_chunks, "
        "(select count(*) from decided) as deduped_chunks, "
        "(select count(*) from decided) as dense_embeddings, "
        "(select count(distinct chunk_id) from cnt where chunk_id in (select chunk_id from decided)) as bm25_embeddings, "
        "(select count(distinct chunk_id) from wide where chunk_id in (select chunk_id from decided)) as expanded_embeddings",
        recursive=True,
    ),
    "ingest_rates": """
select *, case when seconds > 0 then round(files_processed / seconds, 2) else 0 end as files_per_second,
  case when seconds > 0 then round(deduped_chunks / seconds, 2) else 0 end as chunks_per_second
from (select event_type, count(distinct user_id) as files_processed, count(*) as deduped_chunks,
  round(sum(value), 2) as seconds from events group by event_type)""",
    "upsert_merge": """
select doc_id as chunk_id,
  case when doc_id in (select doc_id from labels) then 'again' else source end as source, text
from documents""",
    "classify_pressure": build(
        [READINGS], "select event_id, reason <> '' as under_pressure, reason from pressed"
    ),
    "critical_alerts": build(
        [READINGS],
        "select event_id, case when cpu_temp_c > 95 then 'CPU temp critical: ' || cpu_temp_c::varchar "
        "else 'GPU temp critical: ' || gpu_temp_c::varchar end || '°C' as alert "
        "from readings where cpu_temp_c > 95 or gpu_temp_c > 90",
    ),
    "throttle_state": build(
        [
            READINGS,
            """signals as materialized (
  select *, case when reason <> '' then 1 when cpu_percent < 80 * 0.8 and mem_percent < 70 * 0.8 then 0 end as signal
  from pressed)""",
        ],
        "select event_id, host, coalesce(last_value(signal ignore nulls) over "
        "(partition by host order by ts, event_id rows unbounded preceding), 0) = 1 as throttled from signals",
    ),
}
