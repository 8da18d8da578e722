"""Results of the text operators stated in SQL, where SQL can express them."""

from __future__ import annotations

import string

from tidemark.llm.licenses import CLOSED, RULES, SENTENCES, chains_of, known_parts

ORACLE: dict[str, str] = {}


def text_of(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def listed(values: list[str]) -> str:
    return "[" + ", ".join(map(text_of, values)) + "]"


# --- licence scans: sentences, their identifiers in a line, rules found in the line

_KNOWN = known_parts(SENTENCES)
_CHAINS = chains_of(RULES, SENTENCES)


def _rule(chain: str, name: str) -> str:
    longer = [c for c, other in _CHAINS if chain in c and c != chain and other != name]
    hit = [f"contains(line, '{chain}')", *(f"not contains(line, '{c}')" for c in longer)]
    return f"case when {' and '.join(hit)} then {text_of(name)} end"


ORACLE["op2_licenses"] = f"""with cut as (
    select doc_id, list_filter(list_transform(
        string_split_regex(regexp_replace(coalesce(text, ''), '([.:;!?])[ \\t\\n\\x0b\\f\\r]+', '\\1' || chr(10), 'g'), '\\n+'),
        lambda s: trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g'))), lambda s: s <> '') parts
    from documents),
  told as (select doc_id, list_transform(parts, lambda s: coalesce(
        map({listed(list(_KNOWN))}, {listed(list(_KNOWN.values()))})[s], '0')) ids from cut),
  lined as (select *, ',' || array_to_string(ids, ',') || ',' line from told),
  named as (select *, list_sort(list_distinct(list_filter(
        [{", ".join(_rule(*c) for c in _CHAINS)}], lambda x: x is not null))) names from lined)
  select doc_id, len(ids)::bigint n_sentences,
    len(list_filter(ids, lambda x: x <> '0'))::bigint n_known,
    coalesce(array_to_string(names, ','), '') licences, len(names)::bigint n_licences,
    len(names) > 0 and not list_has_any(names, {listed(list(CLOSED))}) permissive
  from named"""

# --- decontamination: windows of items and of documents as texts

_WORDS = (
    f"regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', "
    f"'{string.ascii_lowercase}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)
ORACLE["op5_decontaminate"] = f"""with d as (select doc_id, {_WORDS} w from documents),
  b as (select item_id::varchar item, {_WORDS} w from benchmark),
  bw as (select distinct item, least(10, len(w)) k,
           array_to_string(w[i : i + least(10, len(w)) - 1], ' ') g
         from b, unnest(range(1, len(w) - least(10, len(w)) + 2)) t(i) where len(w) > 0),
  ks as (select distinct k from bw),
  dg as (select doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') g
         from d, ks, unnest(range(1, len(w) - k + 2)) t(i)),
  hit as (select doc_id, i, k, item from dg join bw using (g, k)),
  pos as (select doc_id, count(distinct p) n_hit
          from hit, unnest(range(i, i + k)) u(p) group by doc_id),
  it as (select doc_id, count(distinct item) n_items,
           string_agg(distinct item, ',' order by item) items from hit group by doc_id)
  select doc_id, len(w)::bigint n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
    sha256(coalesce(items, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
  from d left join pos using (doc_id) left join it using (doc_id)"""

# --- chat: what is read back is what went in; escapes lengthen a turn by one each

_TAIL = "(/?s>|/?INST\\])"


def _written(column: str) -> str:
    escaped = f"regexp_replace({column}, '([<\\[])(\\\\*){_TAIL}', '\\1\\\\\\2\\3', 'g')"
    return f"length(case when conflict then {escaped} else {column} end)"


_ORDER = "order by turn nulls first, r, t"
ORACLE["op10_chat"] = f"""with c as (
    select conv_id, turn, coalesce(role, '') r, coalesce(text, '') t from conversations union all
    select -1, i, ['user', 'assistant'][i + 1], '</s>[INST] ok [/INST]' from range(0, 2) x(i)),
  k as (select *, regexp_matches(r || chr(10) || t,
          '</?s>|\\[/?INST\\]|[<\\[]\\\\+{_TAIL}') conflict from c),
  g as (select conv_id, count(*) n_turns,
          string_agg(r || chr(10) || t || chr(10), '' {_ORDER}) told,
          string_agg(case when r = 'assistant' then t else '' end, '' {_ORDER}) loss,
          sum(22 + {_written("r")} + {_written("t")})::bigint formatted_chars
        from k group by conv_id)
  select conv_id, n_turns, sha256(told) turns_sha256, length(loss)::bigint loss_chars,
    sha256(loss) loss_sha256, formatted_chars from g"""

# --- WARC: digests in base 32 (five hex digits make four of its digits), the first of each payload

_BASE32 = """array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      ((('0x' || substr(sha, (5 * (i // 4) + 1)::bigint, 5))::bigint >> (5 * (3 - i % 4))::int) & 31) + 1, 1)), '')"""
ORACLE["op11_warc"] = f"""with p as (
    select page_id, coalesce(html, '') body, sha1(coalesce(html, '')) sha from pages),
  q as (select *, min(page_id) over (partition by body) least from p)
  select page_id, strlen(body)::bigint payload_bytes, {_BASE32} payload_digest,
    case when page_id = least then 'response' else 'revisit' end record_type,
    case when page_id <> least then least end refers_to from q"""

# --- ranked search: every document that shares a term with an item is scored

_TERMS = (
    f"regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', "
    f"'{string.ascii_lowercase}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
)
ORACLE["op12_ranked"] = f"""with d as (
    select row_number() over () rid, doc_id, {_TERMS} w from documents),
  b as (select distinct item_id, text from benchmark),
  bt as (select item_id, term, count(*) q
    from (select item_id, {_TERMS} w from b), unnest(w) t(term) group by item_id, term),
  dt as (select rid, term, count(*) tf from d, unnest(w) t(term) group by rid, term),
  s as (select count(*) n_docs, sum(len(w))::bigint n_words from d where len(w) > 0),
  df as (select term, count(*) df from dt group by term),
  wt as (select term, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::bigint w from df, s),
  m as (select rid, doc_id, 25 + (75 * len(w) * n_docs) // n_words m from d, s),
  scored as (select item_id, rid, doc_id, sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint score
    from bt join dt using (term) join wt using (term) join m using (rid) group by item_id, rid, doc_id),
  ranked as (select item_id, doc_id, score, row_number() over (
      partition by item_id order by score desc, doc_id nulls first)::int rank from scored where score > 0)
  select * from ranked where rank <= 10"""

# --- Merkle manifest: levels by recursion, siblings from the runs of each level, folded in order


def _leaf_sql(text: str) -> str:
    fields = ("doc_id::varchar", "source", "lang", "n_chars::varchar", text)
    told = (f"case when {f} is null then '-' else strlen({f}) || ':' || {f} end" for f in fields)
    return f"sha256({' || '.join(told)})"


# CRC-32 of the digits of an id, bit by bit (fixed values: its polynomial and its start).
_CRC32 = """xor(list_reduce(
    list_transform(range(1, length(doc_id::varchar) + 1), lambda i: ascii(substr(doc_id::varchar, i, 1))::bigint),
    lambda c, b: list_reduce(range(0, 8), lambda d, j: xor(d >> 1, 3988292384 * (d & 1)), xor(c, b)),
    4294967295::bigint), 4294967295::bigint)"""
_LEVELS = """select tree, lvl + 1, pos // 3, sha256(string_agg(digest, '' order by pos)), (n + 2) // 3
    from {nodes} where n > 1 group by tree, lvl, pos // 3, n"""
ORACLE["op13_merkle"] = f"""with recursive leaf as (
    select doc_id, coalesce('=' || source, '') tree, {_leaf_sql("text")} leaf,
      case when {_CRC32} % 2 = 0 then {_leaf_sql("replace(text, chr(10), '')")}
        else {_leaf_sql("text")} end suspect from documents),
  placed as (select *, count(*) over (partition by tree) n,
      row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 pos from leaf),
  low(tree, lvl, pos, digest, n) as (
    select tree, 0, pos, leaf, n from placed union all {_LEVELS.format(nodes="low")}),
  subroots as (select tree, digest subroot, row_number() over (order by tree) - 1 place,
      count(*) over () n from low where n = 1),
  high(tree, lvl, pos, digest, n) as (
    select '', 0, place, subroot, n from subroots union all {_LEVELS.format(nodes="high")}),
  runs as (select 0 part, tree, lvl, pos // 3 up, list(digest order by pos) run
      from low where n > 1 group by tree, lvl, pos // 3 union all
    select 1, tree, lvl, pos // 3, list(digest order by pos)
      from high where n > 1 group by tree, lvl, pos // 3),
  steps as (select p.tree, p.pos, r.part, r.lvl, r.run,
      (case r.part when 0 then p.pos else s.place end) // (3 ** r.lvl)::bigint spot
    from placed p join subroots s using (tree) join runs r
      on r.tree = case r.part when 0 then p.tree else '' end
      and r.up = (case r.part when 0 then p.pos else s.place end) // (3 ** (r.lvl + 1))::bigint),
  paths as (select tree, pos, list({{'a': array_to_string(run[: spot % 3], ''),
      'b': array_to_string(run[spot % 3 + 2 :], '')}} order by part, lvl) path
    from steps group by tree, pos),
  told as (select doc_id, leaf, subroot, digest root,
      sha256(coalesce(array_to_string(list_transform(path, lambda x: x.a || x.b), ''), '')) proof_sha256,
      coalesce(list_reduce(path, lambda s, x: {{'a': sha256(x.a || s.a || x.b), 'b': ''}},
        {{'a': suspect, 'b': ''}}).a, suspect) folded_root
    from placed join subroots using (tree) left join paths using (tree, pos), (select digest from high where n = 1))
  select *, folded_root = root verified from told"""
