"""The registered queries of the training-data operators and their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import (
    decontaminate, exact_dedup, html_text, merkle, mixing, near_dedup, nearest, quality, ranked_search, secret_scan, sharding, substring_dedup, url_filter,
)
from ledgerlens.llm.common import ascii_lower, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


_BLANK_WORDS = r"list_filter(string_split_regex({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
#: A-Z only, as DuckDB's lower() also changes other letters
_LOWER = "translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op3_near_dedup", f"""
WITH RECURSIVE w AS (SELECT doc_id, {_BLANK_WORDS.format(text=_LOWER.format(text="coalesce(text, '')"))} AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
        ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2])) END AS sh FROM w),
c AS (SELECT sh, len(sh) AS n, min(doc_id) AS rep FROM s WHERE len(sh) > 0 GROUP BY sh),
x AS (SELECT rep, n, unnest(sh) AS g FROM c),
links AS (SELECT a.rep AS u, b.rep AS v FROM x a JOIN x b ON a.g = b.g AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
          GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
both_ways AS (SELECT u, v FROM links UNION SELECT v, u FROM links),
reach(node, seen) AS (SELECT rep, rep FROM c UNION SELECT r.node, e.v FROM reach r JOIN both_ways e ON r.seen = e.u),
least_ AS (SELECT node, min(seen) AS component FROM reach GROUP BY node)
SELECT s.doc_id, CAST(len(s.sh) AS BIGINT) AS n_shingles, coalesce(l.component, s.doc_id) AS component_id,
  s.doc_id = coalesce(l.component, s.doc_id) AS kept
FROM s LEFT JOIN c ON c.sh = s.sh LEFT JOIN least_ l ON l.node = c.rep""")
def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents table, three words, similarity 0.85."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


@query("op4_substring_dedup", f"""
WITH w AS (SELECT doc_id, {_BLANK_WORDS.format(text="coalesce(text, '')")} AS ws FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(ws) - 48)) AS i, ws FROM w WHERE len(ws) >= 50),
g AS (SELECT doc_id, i, md5(array_to_string(ws[i:i+49], ' ')) AS h FROM p),
f AS (SELECT h, min(doc_id) AS first FROM g GROUP BY h),
c AS (SELECT DISTINCT g.doc_id, g.i + k AS at FROM g JOIN f USING (h), range(0, 50) r(k) WHERE f.first < g.doc_id),
o AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS at FROM w),
k AS (SELECT o.doc_id, string_agg(o.word, ' ' ORDER BY o.at) AS kept, count(*) AS n FROM o ANTI JOIN c ON o.doc_id = c.doc_id AND o.at = c.at GROUP BY o.doc_id)
SELECT w.doc_id, CAST(len(w.ws) AS BIGINT) AS n_words, CAST(len(w.ws) - coalesce(k.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM w LEFT JOIN k ON k.doc_id = w.doc_id""")
def repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents table, windows of 50 words."""
    return substring_dedup.repeated_passages(table(spark, sf_dir, "documents"), window=50)


#: (host, path, verdict)
URL_RULES = (
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"),
)
_RULES = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in URL_RULES)


@query("op6_url_filter", f"""
WITH r(rhost, rpath, verdict) AS (VALUES {_RULES}),
p AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, {_LOWER.format(text="regexp_extract(rest, '^[^/?#]*', 0)")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
m AS (SELECT h.*, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(verdict, length(rhost || rpath)) AS verdict
      FROM h LEFT JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id, host, path)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m""")
def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole pages table, five rules."""
    rules = spark.sql(f"SELECT * FROM VALUES {_RULES} AS rules(host, path, verdict)")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


@query("op7_mixing")
def mixed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents table, weights 1, 2, 3 in turn, at most three repeats."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op9_sharding")
def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents table, 40 shards of near equal bytes."""
    return sharding.shard(table(spark, sf_dir, "documents"), shards=40)


@query("op1_decontaminate", rf"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex({_LOWER.format(text="coalesce(text, '')")}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(string_split_regex({_LOWER.format(text="coalesce(text, '')")}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
v AS (SELECT item_id, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i, w FROM b WHERE len(w) > 0),
q AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i+n-1], ' ') AS s FROM v),
p AS (SELECT d.doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM d, (SELECT DISTINCT n FROM q) WHERE len(w) >= n),
o AS (SELECT p.doc_id, p.i, p.n, q.item_id FROM p JOIN q ON q.n = p.n AND q.s = array_to_string(p.w[p.i:p.i+p.n-1], ' ')),
h AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM o, range(0, 10) r(k) WHERE k < n GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM o) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(t.n_items, 0) AS n_items,
  sha256(coalesce(t.ids, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)""")
def contaminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents table against the whole benchmark, windows of ten words."""
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)


@query("op5_secret_scan")
def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents table; the models are learnt from its sample."""
    return secret_scan.scan(table(spark, sf_dir, "documents"))


@query("op8_quality")
def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents table, learnt from the labels that are not held out."""
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_nearest")
def neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every twentieth vector against all vectors, twenty nearest."""
    return nearest.nearest(table(spark, sf_dir, "embeddings"), k=20, every=20)


@query("op2_html_text")
def main_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole pages table."""
    return html_text.main_text(table(spark, sf_dir, "pages"))


_TERMS = r"list_filter(string_split_regex({text}, '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')".format(text=_LOWER.format(text="coalesce(text, '')"))


@query("op11_ranked_search", f"""
WITH d AS (SELECT doc_id, {_TERMS} AS ws FROM documents), e AS (SELECT doc_id, len(ws) AS n, unnest(ws) AS t FROM d),
tf AS (SELECT doc_id, any_value(n) AS n, t, count(*) AS tf FROM e GROUP BY doc_id, t), df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
s AS (SELECT count(*) AS docs, sum(len(ws)) AS words FROM d WHERE len(ws) > 0),
w AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w FROM df, s),
b AS (SELECT item_id, t, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS t FROM benchmark) GROUP BY item_id, t),
r AS (SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // words)))) AS BIGINT) AS score
      FROM b JOIN w USING (t) JOIN tf USING (t), s GROUP BY item_id, doc_id),
o AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM r WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 10""")
def ranked_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item against the whole documents table, ten best."""
    return ranked_search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def _leaf_sql(text: str) -> str:
    values = [f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(values)})"


def _tree_sql(name: str, leaves: str, tree: str) -> str:
    """Nodes of all trees and what stands left and right of each in its run; ``leaves`` gives tree, pos, d and n, the tree's number of leaves."""
    run = f"PARTITION BY {tree}, level, pos // 8 ORDER BY pos ROWS BETWEEN"
    return f"""{name}({tree}, level, pos, d, n) AS ({leaves} UNION ALL
  SELECT {tree}, level + 1, pos // 8, sha256(string_agg(d, '' ORDER BY pos)), (any_value(n) + 7) // 8 FROM {name} WHERE n > 1 GROUP BY {tree}, level, pos // 8),
{name}_sides AS (SELECT *, coalesce(string_agg(d, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(d, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name} WHERE n > 1)"""


@query("op12_merkle_manifest", f"""
WITH RECURSIVE crc(t) AS (SELECT list(list_reduce([i] || range(8), lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) FROM range(256) q(i)),
leaves AS (SELECT doc_id, lang, {_leaf_sql("text")} AS leaf, {_leaf_sql(_LOWER.format(text="text"))} AS lower_leaf,
  xor(list_reduce([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)), lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) AS c,
  row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM documents, crc),
{_tree_sql("nodes", "SELECT lang, 0, pos, leaf, n FROM leaves", "lang")},
subroots AS (SELECT lang, d AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n, 0 AS one FROM nodes WHERE n = 1),
{_tree_sql("tops", "SELECT one, 0, pos, subroot, n FROM subroots", "one")},
f(doc_id, lang, level, pos, acc, proof) AS (SELECT doc_id, lang, 0, pos, CASE WHEN c % 3 = 0 THEN lower_leaf ELSE leaf END, '' FROM leaves UNION ALL
  SELECT doc_id, f.lang, f.level + 1, f.pos // 8, sha256(l || acc || r), proof || l || r FROM f JOIN nodes_sides s ON s.lang IS NOT DISTINCT FROM f.lang AND s.level = f.level AND s.pos = f.pos),
u AS (SELECT doc_id, lang, max_by(acc, level) AS acc, max_by(proof, level) AS proof FROM f GROUP BY doc_id, lang),
g(doc_id, level, pos, acc, proof) AS (SELECT doc_id, 0, s.pos, acc, proof FROM u JOIN subroots s ON s.lang IS NOT DISTINCT FROM u.lang UNION ALL
  SELECT doc_id, g.level + 1, g.pos // 8, sha256(l || acc || r), proof || l || r FROM g JOIN tops_sides s ON s.level = g.level AND s.pos = g.pos),
h AS (SELECT doc_id, max_by(acc, level) AS folded_root, max_by(proof, level) AS proof FROM g GROUP BY doc_id),
t AS (SELECT d AS root FROM tops WHERE n = 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves JOIN h USING (doc_id) JOIN subroots s ON s.lang IS NOT DISTINCT FROM leaves.lang, t""")
def witnesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents table, a tree per language; every third row's text is lower-cased to show that its witness then fails."""
    docs = table(spark, sf_dir, "documents")
    fields = [F.col(f) if f != "text" else ascii_lower(F.col("text")) for f in merkle.FIELDS]
    changed = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, merkle.leaf(fields))
    rows = merkle.manifest(docs, carry={"changed": changed})
    return rows.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("witness")), 256).alias("proof_sha256"),
        merkle.folded(F.coalesce("changed", "leaf"), F.col("witness")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


@query("op13_exact_dedup", f"""
WITH n AS (SELECT doc_id, {_LOWER.format(text="coalesce(text, '')")} AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM n WINDOW w AS (PARTITION BY norm)""")
def exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents table, streamed from its files."""
    return exact_dedup.duplicates(spark, f"{sf_dir}/documents.parquet").select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
