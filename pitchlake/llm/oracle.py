"""DuckDB SQL for the queries that SQL can express: plain forms without any of
the operators' methods. Tokens, edit distance, random draws and the learned
model have none; tests hold them against brute force."""

from __future__ import annotations

from .license_scan import TEMPLATES, Scan
from .queries import URL_RULES

WORD = r"[^\x20\x09-\x0D]+"


def _license_scan() -> str:
    scan = Scan()
    values = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in sorted(TEMPLATES.items()))

    def words(text: str) -> str:
        upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
        plain = f"regexp_replace(translate(coalesce({text}, ''), '{upper}', '{upper.lower()}'), '[^a-z0-9]+', ' ', 'g')"
        return f"string_split(trim({plain}), ' ')"

    n = scan.shingle

    def shingles(source: str, key: str) -> str:
        return f"""
          select {key}, i as p, array_to_string(w[i + 1:i + {n}], ' ') as s
          from (select {key}, w, unnest(range(0, len(w) - {n - 1})) as i from {source})"""

    return f"""
    with t as (select license, {words("text")} as w from (values {values}) v(license, text)),
    ts as (select distinct license, s from ({shingles("t", "license")})),
    tn as (select license, count(*) as m from ts group by license),
    d as (select doc_id, {words("text")} as w from documents),
    ds as ({shingles("d", "doc_id")}),
    hit as (
      select doc_id, license, p, ds.s, m, greatest(1, m // 4) as step, m + greatest(1, m // 4) - 1 as width
      from ds join ts on ds.s = ts.s join tn using (license)),
    win as (
      select doc_id, license, s, m, step,
             unnest(range(greatest(0, cast(ceil((p - width + 1) / step) as bigint)), p // step + 1)) as k
      from hit),
    held as (
      select doc_id, license, k * step as start, count(distinct s) / m as containment
      from win group by doc_id, license, k, step, m)
    select doc_id, license, max(containment) as containment, cast(min(start) as integer) as first_word,
           count(*) as windows
    from held where containment >= {scan.containment} group by doc_id, license"""


WARC = """
  with p as (
    select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes,
           sha256(coalesce(html, '')) as payload_digest
    from pages),
  f as (
    select *, case when payload_bytes >= 100 then min(page_id) over (partition by payload_digest) end as first
    from p)
  select page_id, payload_bytes, payload_digest,
         case when first is not null and first <> page_id then 'revisit' else 'response' end as record_type,
         case when first <> page_id then first end as refers_to
  from f"""

SUBSTRINGS = rf"""
  with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') as w from documents),
  win as (
    select doc_id, i, array_to_string(w[i + 1:i + 20], ' ') as s
    from (select doc_id, w, unnest(range(0, len(w) - 19)) as i from d)),
  again as (
    select doc_id, i from (
      select doc_id, i, row_number() over (partition by s order by doc_id, i) as n from win) where n > 1),
  gone as (select distinct doc_id, unnest(range(i, i + 20)) as j from again),
  word as (select doc_id, w[j + 1] as word, j from (select doc_id, w, unnest(range(0, len(w))) as j from d)),
  kept as (
    select word.doc_id, count(gone.j) as n_removed,
           string_agg(word, ' ' order by word.j) filter (where gone.j is null) as kept
    from word left join gone on word.doc_id = gone.doc_id and word.j = gone.j group by word.doc_id)
  select d.doc_id, len(w) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
  from d left join kept on d.doc_id = kept.doc_id"""


def _components(ids: str, links: str) -> str:
    """Rest of a statement: ids (id) and links (a, b, both ways) to components."""
    return f"""
  reach as (
    select id, id as other from {ids}
    union
    select r.id, l.b from reach r join {links} l on r.other = l.a),
  comp as (select id, min(other) as component_id from reach group by id)"""


EMBEDDINGS = f"""
  with recursive v as (
    select vec_id as id, cast(embedding as double[]) as e from embeddings
    where embedding is not null and len(embedding) > 0
      and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
      and list_inner_product(cast(embedding as double[]), cast(embedding as double[])) > 0),
  link as (
    select x.id as a, y.id as b from v x join v y on x.id <> y.id and len(x.e) = len(y.e)
    where list_inner_product(x.e, y.e)
          / (sqrt(list_inner_product(x.e, x.e)) * sqrt(list_inner_product(y.e, y.e))) >= 0.9),
  node as (select vec_id as id from embeddings),
  {_components("node", "link")}
  select n.id as vec_id, coalesce(c.n, 0) as n_links, component_id, n.id = component_id as kept
  from node n join comp using (id) left join (select a, count(*) as n from link group by a) c on n.id = c.a"""

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
NEAR = rf"""
  with recursive d as (
    select doc_id as id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{WORD}') as w
    from documents),
  sh as (
    select distinct id, s from (
      select id, unnest(case when len(w) < 2 then [array_to_string(w, ' ')]
        else list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) end) as s from d where len(w) > 0)),
  n as (select id, count(*) as n from sh group by id),
  common as (select x.id as a, y.id as b, count(*) as c from sh x join sh y on x.s = y.s and x.id <> y.id group by all),
  link as (
    select a, b from common join n p on a = p.id join n q on b = q.id where 100 * c >= 80 * (p.n + q.n - c)),
  {_components("d", "link")}
  select d.id as doc_id, coalesce(n, 0) as n_shingles, component_id, d.id = component_id as kept
  from d join comp using (id) left join n on d.id = n.id"""


def _urls() -> str:
    values = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
    return rf"""
    with rule as (select * from (values {values}) r(r_host, r_path, r_verdict)),
    rest as (
      select page_id,
             case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest
      from pages),
    cut as (select page_id, regexp_extract(rest, '^([^?#]*)', 1) as before from rest),
    page as (
      select page_id, translate(regexp_extract(before, '^([^/]*)', 1), '{UPPER}', '{UPPER.lower()}') as host,
             substr(before, length(regexp_extract(before, '^([^/]*)', 1)) + 1) as path
      from cut),
    fit as (
      select page_id, r_host || r_path as rule, r_verdict,
             row_number() over (partition by page_id order by length(r_host || r_path) desc) as n
      from page join rule
        on (host = r_host or ends_with(host, '.' || r_host)) and starts_with(path, r_path))
    select page.page_id, host, path, rule, coalesce(r_verdict, 'allow') as verdict
    from page left join fit on page.page_id = fit.page_id and n = 1"""


LINES = rf"""
  with line as (
    select doc_id, unnest(w) as line, unnest(range(len(w))) as i
    from (select doc_id, string_split(coalesce(text, ''), chr(10)) as w from documents)),
  keyed as (
    select *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                        '{UPPER}', '{UPPER.lower()}') as k from line),
  repeated as (
    select k, max(doc_id) as last from keyed where length(k) >= 20 group by k having count(distinct doc_id) >= 3),
  judged as (
    select doc_id, i, line, last is not null and last <> doc_id as gone from keyed left join repeated using (k))
  select doc_id, count(*) as n_lines, cast(count(*) filter (where gone) as bigint) as n_dropped,
         sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not gone), '')) as kept_sha256
  from judged group by doc_id"""


def _codes(rounds: int = 6) -> str:
    """One pair of steps for each round: nearest entries, then floored means."""

    def nearest(k: int) -> str:
        return f"""
  near{k} as materialized (
    select row, part, min(gap * 16 + entry) % 16 as entry, min(gap * 16 + entry) // 16 as gap
    from (select row, v.part, entry, sum((v.x - b.x) * (v.x - b.x)) as gap
          from v join book{k} b on v.part = b.part and v.pos = b.pos group by row, v.part, entry)
    group by row, part)"""

    def replaced(k: int) -> str:
        return f"""
  mean{k} as (
    select near{k}.part, entry, pos, sum(x) as s, count(*) as n
    from near{k} join v using (row, part) group by near{k}.part, entry, pos),
  book{k + 1} as materialized (
    select b.part, b.entry, b.pos,
           cast(case when n is null then b.x else (s - (((s % n) + n) % n)) // n end as bigint) as x
    from book{k} b left join mean{k} m on b.part = m.part and b.entry = m.entry and b.pos = m.pos)"""

    steps = ",".join(f"{nearest(k)},{replaced(k)}" for k in range(rounds))
    return f"""
  with e as (
    select vec_id, label, embedding, row_number() over (order by vec_id) as row from embeddings
    where embedding is not null and len(embedding) > 0
      and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
  flat as (
    select row, unnest(embedding) as x, unnest(range(len(embedding))) as p, len(embedding) // 8 as width from e),
  v as materialized (
    select row, p // width as part, p % width as pos, cast(floor(4096.0 * cast(x as double)) as bigint) as x from flat),
  book0 as materialized (select part, row - 1 as entry, pos, x from v where row <= 16),{steps},{nearest(rounds)},
  digest as (
    select sha256(string_agg(cast(x as varchar), ',' order by part, entry, pos)) as codebooks_sha256 from book{rounds}),
  coded as (
    select row, string_agg(printf('%02x', cast(entry as integer)), '' order by part) as code,
           cast(sum(gap) as bigint) as error
    from near{rounds} group by row)
  select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256
  from coded join e using (row), digest"""


def _crc32(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes, one step of the reversed polynomial per byte."""
    table = []
    for byte in range(256):
        for _ in range(8):
            byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)
        table.append(byte)
    return f"""xor(4294967295::bigint, list_reduce(
      list_prepend(4294967295::bigint, list_transform(range(1, octet_length(encode({text})) + 1),
        lambda i: cast('0x' || substr(hex(encode({text})), 2 * i - 1, 2) as bigint))),
      lambda c, b: xor(list_extract(cast({table} as bigint[]), cast((xor(c, b) & 255) + 1 as integer)), c >> 8)))"""


def _resampling() -> str:
    words = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

    def features(table: str, key: str) -> str:
        return f"""
    select {key} as id, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as f
    from (select {key}, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{words}') as w
          from {table})"""

    return f"""
  with d as materialized (select id, f, count(*) as n from ({features("documents", "doc_id")}) group by id, f),
  b as materialized (select f, count(*) as n from ({features("benchmark", "item_id")}) group by f),
  bucket as materialized (
    select f, {_crc32("f")} % 10000 as k from (select f from d union select f from b)),
  s as (select k, sum(n) as s from d join bucket using (f) group by k),
  t as (select k, sum(n) as t from b join bucket using (f) group by k),
  gain as (
    select k, cast(floor(1000.0 * ln(
      ((coalesce(t, 0) + 1.0)::double * ((select coalesce(sum(n), 0) from d) + 10000.0)::double)
      / ((coalesce(s, 0) + 1.0)::double * ((select coalesce(sum(n), 0) from b) + 10000.0)::double))) as bigint) as g
    from (select unnest(range(10000)) as k) left join s using (k) left join t using (k)),
  weighed as (
    select id, cast(sum(n) as bigint) as n, cast(sum(n * g) as bigint) as g from d join bucket using (f) join gain using (k) group by id),
  scored as (
    select doc_id, coalesce(n, 0) as n_features, coalesce((g - (((g % n) + n) % n)) // n, 0) as weight,
           cast('0x' || substr(sha256('7:' || doc_id), 1, 8) as bigint) as h
    from documents left join weighed on doc_id = id),
  final as (
    select doc_id, n_features, weight,
           weight + cast(floor(-1000.0 * ln(-ln((h + 0.5)::double / 4294967296.0::double))) as bigint) as score
    from scored),
  ranked as (
    select doc_id, row_number() over (order by score desc, doc_id) as r, count(*) over () as n
    from final where n_features >= 39)
  select final.doc_id, n_features, weight, score, case when r <= 25 * n // 100 then r end as rank
  from final left join ranked on final.doc_id = ranked.doc_id"""


def statements() -> dict[str, str]:
    return {
        "op1_license_scan": _license_scan(),
        "op3_warc": WARC,
        "op5_substring_dedup": SUBSTRINGS,
        "op6_embedding_dedup": EMBEDDINGS,
        "op7_minhash_dedup": NEAR,
        "op10_url_filter": _urls(),
        "op11_line_dedup": LINES,
        "op12_vector_codes": _codes(),
        "op13_importance_resampling": _resampling(),
    }
