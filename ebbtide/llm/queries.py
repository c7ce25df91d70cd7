"""Registered queries of the numbered operators: each applies its operator to the whole table; SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import jaccard, language, lattice, manifest, mixing, packing, pages, repeats, resample, secret_scan, sharding, topk, toxicity
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_toxicity(spark: SparkSession, d: str) -> DataFrame:
    return toxicity.classify(table(spark, d, "documents"), table(spark, d, "labels"))


def op2_mixing(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_sources(table(spark, d, "documents"))


def op3_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(table(spark, d, "documents"))


def op4_jaccard(spark: SparkSession, d: str) -> DataFrame:
    return jaccard.join_documents(table(spark, d, "documents"))


def op5_sharding(spark: SparkSession, d: str) -> DataFrame:
    return sharding.shard_documents(table(spark, d, "documents"))


def op6_topk(spark: SparkSession, d: str) -> DataFrame:
    return topk.exact_top_k(table(spark, d, "embeddings"))


def op7_language(spark: SparkSession, d: str) -> DataFrame:
    return language.identify(table(spark, d, "documents"))


def op8_secrets(spark: SparkSession, d: str) -> DataFrame:
    return secret_scan.find_secrets(table(spark, d, "documents"))


def op9_pages(spark: SparkSession, d: str) -> DataFrame:
    return pages.extract(table(spark, d, "pages"))


def op10_lattice(spark: SparkSession, d: str) -> DataFrame:
    return lattice.near_duplicates(table(spark, d, "embeddings"))


def op11_repeats(spark: SparkSession, d: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, d, "documents")).drop("spans")


def op12_manifest(spark: SparkSession, d: str) -> DataFrame:
    return manifest.verify(table(spark, d, "documents")).drop("n_siblings", "pos")


def op13_resample(spark: SparkSession, d: str) -> DataFrame:
    return resample.resample(table(spark, d, "documents"), table(spark, d, "benchmark"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_toxicity, op2_mixing, op3_packing, op4_jaccard, op5_sharding, op6_topk, op7_language, op8_secrets, op9_pages, op10_lattice,
    op11_repeats, op12_manifest, op13_resample)}


def _case(column: str, weights: dict[str, int]) -> str:
    return "CAST(CASE " + " ".join(f"WHEN {column} = '{k}' THEN {w}" for k, w in weights.items()) + " ELSE 10 END AS BIGINT)"


def _share_sql(name: str, rows: str, parent: str, child: str) -> str:
    order = f"PARTITION BY {parent} ORDER BY cap::DOUBLE / weight, {child}"
    return f"""
{name}_a AS (SELECT *, budget - coalesce(sum(cap) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_,
  sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_ FROM ({rows})),
{name}_b AS (SELECT *, min(CASE WHEN cap * open_ <= left_ * weight THEN 1 ELSE 0 END)
  OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS full_ FROM {name}_a),
{name} AS (SELECT *, CAST(CASE WHEN full_ = 1 THEN cap ELSE (weight * (budget - coalesce(sum(CASE WHEN full_ = 1 THEN cap END)
  OVER (PARTITION BY {parent}), 0))) // sum(CASE WHEN full_ = 0 THEN weight END) OVER (PARTITION BY {parent}) END AS BIGINT) AS given FROM {name}_b)"""


# CRC-32 of a blob of the row, by the eight shifts of each byte's remainder.
_SHIFTS = "list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)"


def _crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of `text`; the FROM clause must hold `crc_table`."""
    code = f"hex(encode({text}))"
    return (f"xor(4294967295, list_reduce(list_concat([4294967295], [CAST('0x' || {code}[2 * i + 1:2 * i + 2] AS BIGINT) for i in range(len({code}) // 2)]),"
            " lambda c, b: xor(c >> 8, crc_table.t[CAST(xor(c & 255, b) + 1 AS BIGINT)])))")


_CRC_TABLE = f"crc_table AS (SELECT [{_SHIFTS} for x in range(256)] AS t)"


def _tree_sql(name: str, leaves: str, levels: int) -> str:
    """Runs of 8 nodes of each level of the trees of `leaves` (grp, pos, h): `<name>r0` ... (grp, run, hs, n)."""
    out = []
    for k in range(levels):
        rows = leaves if k == 0 else f"""(SELECT grp, run AS pos, CASE WHEN n > 1 THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h FROM {name}r{k - 1})"""
        out.append(f"""
{name}r{k} AS (SELECT grp, pos // 8 AS run, list(h ORDER BY pos) AS hs, any_value(n) AS n
  FROM (SELECT *, count(*) OVER (PARTITION BY grp) AS n FROM {rows}) GROUP BY grp, pos // 8)""")
    return ",".join(out)


def _sides_sql(name: str, tree: str, rows: str, grp: str, pos: str, levels: int) -> str:
    """`rows` with the siblings `l`, `r` (lists by level, null where a level has one node) added to those it has."""
    out = []
    for k in range(levels):
        slot = f"(({pos} // {8 ** k}) % 8)"
        out.append(f"""
{name}{k} AS (SELECT d.* EXCLUDE (l, r), list_append(l, CASE WHEN t.n > 1 THEN array_to_string(hs[1:{slot}], '') END) AS l,
  list_append(r, CASE WHEN t.n > 1 THEN array_to_string(hs[{slot} + 2:], '') END) AS r
  FROM {rows if k == 0 else f"{name}{k - 1}"} d JOIN {tree}r{k} t ON t.grp = d.{grp} AND t.run = d.{pos} // {8 ** (k + 1)})""")
    return ",".join(out)


_LANG_LEVELS, _TOP_LEVELS = 7, 3  # enough for 2 million documents a language and 512 languages


def _field_sql(column: str) -> str:
    return f"coalesce(octet_length(encode(CAST({column} AS VARCHAR))) || ':' || {column}, '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_field_sql(c) for c in ("doc_id", "source", "lang", "n_chars")) + f" || {_field_sql(text)})"


# The smallest id that `links` (a, b) reach from every node of `nodes` (id).
_REACH = """
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT id, id AS other FROM nodes UNION SELECT r.id, l.b FROM reach r JOIN both_ways l ON l.a = r.other),
comp AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)"""

ORACLES: dict[str, str] = {
    "op2_mixing": r"""WITH d AS (SELECT doc_id, coalesce(lang, '?') AS lang, coalesce(source, '?') AS source,
  CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS tokens FROM documents),
s AS (SELECT *, 'd' || (coalesce(TRY_CAST(regexp_extract(source, '([0-9]{1,9})$', 1) AS BIGINT), 0) % 4) AS domain FROM d WHERE tokens > 0),
lf AS (SELECT domain, lang, source, CAST(sum(tokens) AS BIGINT) AS tokens, CAST(sum(tokens) * 3 AS BIGINT) AS cap FROM s GROUP BY ALL),
goal AS (SELECT CAST(floor(sum(tokens) * 0.5) AS BIGINT) AS target FROM s),"""
    + _share_sql("dom", f"SELECT *, {_case('domain', mixing.DOMAIN_WEIGHTS)} AS weight, 0 AS all_, least(sum(cap) OVER (), (SELECT target FROM goal)) AS budget"
                 " FROM (SELECT domain, CAST(sum(cap) AS BIGINT) AS cap FROM lf GROUP BY domain)", "all_", "domain") + ","
    + _share_sql("lng", f"SELECT l.*, {_case('lang', mixing.LANG_WEIGHTS)} AS weight, dom.given AS budget"
                 " FROM (SELECT domain, lang, CAST(sum(cap) AS BIGINT) AS cap FROM lf GROUP BY domain, lang) l JOIN dom USING (domain)", "domain", "lang") + ","
    + _share_sql("leaf", "SELECT lf.*, CAST(1 AS BIGINT) AS weight, lng.given AS budget FROM lf JOIN lng USING (domain, lang)", "domain, lang", "source")
    + r""",
pl AS (SELECT domain, lang, source, CAST(given // tokens AS INTEGER) AS epochs, given % tokens AS rest FROM leaf),
h AS (SELECT s.*, pl.epochs, pl.rest, CAST('0x' || substr(md5(concat_ws('|', '7', CAST(pl.epochs AS VARCHAR), CAST(s.doc_id AS VARCHAR))), 1, 15) AS BIGINT) AS h
  FROM s JOIN pl USING (domain, lang, source)),
t AS (SELECT *, epochs + CASE WHEN sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY h
  RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) <= rest THEN 1 ELSE 0 END AS times FROM h)
SELECT doc_id, domain, lang, source, tokens, CAST(unnest(range(times)) AS INTEGER) AS epoch FROM t""",
    "op4_jaccard": r"""WITH RECURSIVE w AS (SELECT doc_id AS id, regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
  ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)]) END AS s FROM w),
nodes AS (SELECT id, CAST(len(s) AS BIGINT) AS n FROM s),
u AS (SELECT id, unnest(s) AS g FROM s),
p AS (SELECT x.id AS a, y.id AS b, count(*) AS k FROM u x JOIN u y ON x.g = y.g AND x.id < y.id GROUP BY x.id, y.id),
links AS (SELECT p.a, p.b FROM p JOIN nodes x ON x.id = p.a JOIN nodes y ON y.id = p.b WHERE 100 * k >= 90 * (x.n + y.n - k)),"""
    + _REACH + " SELECT nodes.id AS doc_id, nodes.n AS n_shingles, comp.component_id FROM nodes JOIN comp USING (id)",
    "op6_topk": """WITH v AS (SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS e FROM embeddings WHERE embedding IS NOT NULL),
s AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.e, v.e) AS BIGINT) AS score
  FROM v q JOIN v ON q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op11_repeats": r"""WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM w, unnest(range(1, len(w) - 48)) t(i)),
held AS (SELECT h, min(doc_id) AS lo FROM win GROUP BY h),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS pos FROM win JOIN held USING (h) WHERE lo < doc_id),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id),
x AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM w),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS kept FROM x ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n.n, 0) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)""",
    "op12_manifest": f"""WITH {_CRC_TABLE},
d AS (SELECT doc_id, coalesce('=' || lang, '') AS grp, {_leaf_sql('text')} AS h, CASE WHEN {_crc32_sql('CAST(doc_id AS VARCHAR)')} % 3 = 0
  THEN {_leaf_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS fake FROM documents, crc_table),
leaves AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id) - 1 AS pos FROM d),"""
    + _tree_sql("a", "leaves", _LANG_LEVELS) + f""",
subroots AS (SELECT grp AS lang, '' AS grp, hs[1] AS h, row_number() OVER (ORDER BY grp) - 1 AS pos FROM ar{_LANG_LEVELS - 1}),"""
    + _tree_sql("b", "subroots", _TOP_LEVELS) + """,
s AS (SELECT l.*, u.h AS subroot, u.pos AS place, u.grp AS top, [] AS l, [] AS r FROM leaves l JOIN subroots u ON u.lang = l.grp),"""
    + _sides_sql("c", "a", "s", "grp", "pos", _LANG_LEVELS) + "," + _sides_sql("e", "b", f"c{_LANG_LEVELS - 1}", "top", "place", _TOP_LEVELS) + f""",
f AS (SELECT e.doc_id, e.h AS leaf, e.subroot, b.hs[1] AS root, sha256(array_to_string([l[i] || r[i] for i in range(1, len(l) + 1) if l[i] IS NOT NULL], '')) AS proof_sha256,
  list_reduce(list_concat([{{'l': coalesce(fake, e.h), 'r': ''}}], [{{'l': l[i], 'r': r[i]}} for i in range(1, len(l) + 1) if l[i] IS NOT NULL]),
    lambda z, y: {{'l': sha256(y.l || z.l || y.r), 'r': ''}}).l AS folded_root FROM e{_TOP_LEVELS - 1} e, br{_TOP_LEVELS - 1} b)
SELECT *, folded_root = root AS verified FROM f""",
    "op13_resample": rf"""WITH {_CRC_TABLE},
w AS (SELECT 1 AS side, doc_id, text FROM documents UNION ALL SELECT 2, item_id, text FROM benchmark),
u AS (SELECT side, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM w),
c AS (SELECT side, doc_id, word, count(*) AS n FROM u GROUP BY ALL),
k AS (SELECT word, {_crc32_sql('word')} % 10000 AS bucket FROM (SELECT DISTINCT word FROM c), crc_table),
h AS (SELECT bucket, coalesce(sum(n) FILTER (side = 1), 0) AS s, coalesce(sum(n) FILTER (side = 2), 0) AS t FROM c JOIN k USING (word) GROUP BY bucket),
g AS (SELECT bucket, CAST(floor(1000 * ln((t + 1.0::DOUBLE) * ((SELECT sum(s) FROM h) + 10000) / ((s + 1.0::DOUBLE) * ((SELECT sum(t) FROM h) + 10000)))) AS BIGINT) AS gain FROM h),
f AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS weight FROM c JOIN k USING (word) JOIN g USING (bucket) WHERE side = 1 GROUP BY doc_id),
z AS (SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM documents LEFT JOIN f USING (doc_id)),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM z WHERE n_features >= 20)
SELECT z.*, CASE WHEN r.rank <= 10 * r.n // 100 THEN r.rank END AS rank FROM z LEFT JOIN r USING (doc_id)""",
    "op10_lattice": """WITH RECURSIVE nodes AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
links AS (SELECT x.id AS a, y.id AS b FROM nodes x JOIN nodes y ON x.id < y.id WHERE list_cosine_similarity(x.e, y.e) >= 0.9),"""
    + _REACH + """,
n AS (SELECT a AS id, count(*) AS n FROM both_ways GROUP BY a)
SELECT nodes.id AS vec_id, coalesce(n.n, 0) AS n_links, comp.component_id, nodes.id = comp.component_id AS kept
FROM nodes JOIN comp USING (id) LEFT JOIN n USING (id)""",
}
