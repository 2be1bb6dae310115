"""Ranked search, Merkle manifest and exact duplicates against plain Python on hand-made tables."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import exact_dedup, merkle, ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _texts(count, seed=5):
    """Texts over a small vocabulary, with frequent words, long texts, copies and odd characters."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["Éa", "ß", "THE", "x1"]
    out = []
    for i in range(count):
        n = rng.choice([0, 1, 3, 20, 60, 60, 200, 4000 if i % 97 == 0 else 40])
        out.append(" ".join(rng.choice(words[: rng.choice([5, 40, 304])]) for _ in range(n)) + rng.choice(["", ".", "\n\x7f[w1]"]))
    return [*out, *out[:30], *([out[4]] * 40)]


# --- ranked search ------------------------------------------------------------------------------


def _ranked(docs, items, k=10):
    terms = {i: Counter(TERM.findall((t or "").translate(UPPER))) for i, (_, t) in enumerate(docs)}
    terms = {i: c for i, c in terms.items() if c}
    total, words = len(terms), sum(sum(c.values()) for c in terms.values())
    df = Counter(t for c in terms.values() for t in c)
    found = []
    for item, text in items:
        wanted, scores = Counter(TERM.findall((text or "").translate(UPPER))), []
        for i, c in terms.items():
            m = 25 + (75 * sum(c.values()) * total) // words
            score = sum(
                n * math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t, n in wanted.items() if t in c
            )
            if score > 0:
                scores.append((-score, docs[i][0]))
        found += [(item, rank, doc, -score) for rank, (score, doc) in enumerate(sorted(scores)[:k], 1)]
    return sorted(found)


def test_ranked_search_equals_a_full_scan(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "PASS_ITEMS", 3)
    docs = list(enumerate(_texts(400)))
    items = [(1, "w3 w3 w250 THE"), (2, "w1 w2 w3 w4"), (3, "Éa ß x1 nowhere"), (4, None), (5, "..."), (6, "w299"), (7, docs[97][1]), (8, "nowhere")]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = ranked_search.ranked(table, spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, got.collect())) == _ranked(docs, items)


def test_bounds_hold_for_every_document():
    texts = _texts(150)
    held = []
    hashes = ranked_search.WordHashes()
    for i, text in enumerate(texts):
        counts = Counter(ranked_search.terms_of(text))
        if counts:
            held.append((i, i, sum(counts.values()), hashes.of(list(counts)), np.array(list(counts.values()))))
    terms = sorted({t for text in texts for t in ranked_search.terms_of(text)})
    first, items = np.arange(len(terms) + 1), np.arange(len(terms))
    q = ranked_search.Queries(list(items), terms, np.full(len(terms), 7), first, items, np.ones(len(terms), np.int64), len(held), sum(h[2] for h in held))
    slack = 0
    for frame in ranked_search._blocks(held):
        row = next(frame.itertuples(index=False))
        assert sum(map(len, row.slices)) <= 3 * ranked_search.BLOCK_BYTES
        bound = ranked_search.bounds(q, hashes.of(terms), row.n, row.top, row.widths, row.slices)
        for at, doc in enumerate(row.doc_ids):
            counts = Counter(ranked_search.terms_of(texts[doc]))
            often = np.array([counts[t] for t in terms])
            exact = 7 * ranked_search._part(often, q.rounding(np.int64(row.n[at])))
            assert (bound[:, at] >= exact).all()
            slack += int(((bound[:, at] > 0) & (often == 0)).sum())
    assert slack < 0.01 * len(terms) * len(held)


def test_ranked_search_odd_rows(spark, odd, none):
    items = spark.createDataFrame([("a", "alpha WORD"), (None, "beta"), ("a", "alpha WORD"), ("b", "")], "item_id string, text string")
    got = [tuple(r) for r in ranked_search.ranked(odd, items).orderBy("item_id", "rank").collect()]
    # rows that repeat a doc_id rank each by itself; those without come last
    assert [(r[0], r[1], r[2]) for r in got] == [(None, 1, 1), (None, 2, 1), (None, 3, None), ("a", 1, 5), ("a", 2, 6), ("a", 3, 1), ("a", 4, 1), ("a", 5, None)]
    assert ranked_search.ranked(none, items).count() == 0
    assert ranked_search.ranked(odd, items.limit(0)).count() == 0
    assert ranked_search.ranked(odd, items).columns == ["item_id", "rank", "doc_id", "score"]


# --- manifest -----------------------------------------------------------------------------------


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _tree(leaves):
    """The root, and the siblings of each leaf from its level upwards."""
    siblings, nodes, below = [[] for _ in leaves], list(leaves), [[i] for i in range(len(leaves))]
    while len(nodes) > 1:
        runs = [range(i, min(i + 8, len(nodes))) for i in range(0, len(nodes), 8)]
        for run in runs:
            for at in run:
                for leaf in below[at]:
                    siblings[leaf].append(([nodes[x] for x in run if x < at], [nodes[x] for x in run if x > at]))
        nodes, below = [_h(*[nodes[x] for x in run]) for run in runs], [[leaf for x in run for leaf in below[x]] for run in runs]
    return (nodes[0] if nodes else None), siblings


def _field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def _manifest(rows):
    trees = defaultdict(list)
    for doc, text, lang, source, n in rows:
        trees[lang].append((doc is not None, doc or 0, _h(*map(_field, (doc, source, lang, n, text)))))
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {x: _tree([leaf for *_, leaf in sorted(trees[x])]) for x in langs}
    root, above = _tree([built[x][0] for x in langs])
    out = []
    for at, lang in enumerate(langs):
        for (known, doc, leaf), own in zip(sorted(trees[lang]), built[lang][1]):
            out.append((doc if known else None, lang, leaf, "".join("".join(a + b) for a, b in own + above[at]), built[lang][0], root))
    return sorted(out, key=repr)


def _rows_of(table):
    columns = ("doc_id", "lang", "leaf", merkle.siblings(F.col("witness")), "subroot", "root")
    return sorted((tuple(r) for r in table.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("levels", [1, 2, 4])
def test_manifest_equals_whole_trees(spark, monkeypatch, levels):
    """Blocks of any height, so that block roots are appended in several rounds, give the same witnesses."""
    monkeypatch.setattr(merkle, "LEVELS", levels)
    sizes = {None: 3, "de": 1, "en": 700, "fr": 64, "Zz": 65, "é": 9, "": 8}
    rows, doc = [], 0
    for lang, count in sizes.items():
        for _ in range(count):
            doc += 7
            rows.append((doc % 1009, f"Text {doc} É" if doc % 5 else None, lang, "s", doc))
    table = merkle.manifest(spark.createDataFrame(rows, DOCS).repartition(5))
    assert _rows_of(table) == _manifest(rows)
    assert table.where(merkle.folded(F.col("leaf"), F.col("witness")) != F.col("root")).count() == 0
    assert table.where(merkle.folded(F.sha2("leaf", 256), F.col("witness")) == F.col("root")).count() == 0


def test_manifest_odd_rows(spark, odd, none):
    table = merkle.manifest(odd, carry={"size": F.lit(1)})
    assert table.columns == ["doc_id", "lang", "position", "leaf", "witness", "subroot", "root", "size"]
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in odd.collect()]
    assert sorted((r[0], r[2], r[4], r[5]) for r in _rows_of(table) if r[0]) == sorted((r[0], r[2], r[4], r[5]) for r in _manifest(rows) if r[0])
    assert table.where(merkle.folded(F.col("leaf"), F.col("witness")) != F.col("root")).count() == 0
    assert table.count() == len(rows)
    assert merkle.manifest(none).count() == 0
    alone = merkle.manifest(odd.limit(1)).first()
    assert alone["witness"] == [] and alone["leaf"] == alone["subroot"] == alone["root"]


def test_witnesses_grow_by_appending():
    """A partial witness is a prefix of every later one."""
    tree, before = merkle.Appender(3), []
    for i in range(100):
        tree.append(_h(str(i)))
        assert all(now[: len(then)] == then for now, then in zip(tree.witnesses, before))
        before = [list(w) for w in tree.witnesses]
    assert [len(w) for w in before] == [2] * 64 + [1] * 32 + [0] * 4
    root, siblings = _tree([_h(str(i)) for i in range(100)])
    assert tree.close() == root
    assert tree.witnesses == [[("".join(a), "".join(b)) for a, b in own] for own in siblings]


# --- exact duplicates ---------------------------------------------------------------------------


def _exact(rows):
    groups = defaultdict(list)
    for doc, text in rows:
        groups[(text or "").translate(UPPER)].append(doc)
    out = []
    for text, docs in groups.items():
        keep = max((d for d in docs if d is not None), default=None)
        stays = [True] + [False] * (len(docs) - 1)
        docs = sorted(docs, key=lambda d: (d is not None, d or 0), reverse=True)
        out += [(d, keep, len(docs), s, hashlib.sha256(text.encode()).hexdigest()) for d, s in zip(docs, stays)]
    return sorted(out, key=repr)


def _plain(table):
    return sorted((tuple(r) for r in table.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


@pytest.fixture(scope="module")
def copies(spark, tmp_path_factory):
    rows = [(i, t if i % 3 else t.upper()) for i, t in enumerate(_texts(200)) if "É" not in t] + [(9000 + i, "Éa" if i % 2 else "éa") for i in range(6)]
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(6).write.parquet(path)
    return path, rows


@pytest.mark.parametrize("files", [1, 100])
def test_copies_across_batches(spark, copies, tmp_path, files):
    path, rows = copies
    root = str(tmp_path / "stream")
    assert _plain(exact_dedup.duplicates(spark, path, root, batch_files=files)) == _exact(rows)
    batches = spark.read.parquet(f"{root}/state").select("batch").distinct().count()
    assert batches > 1 if files == 1 else batches == 1


def test_texts_that_share_a_digest_are_told_apart(spark, copies):
    path, rows = copies
    assert _plain(exact_dedup.duplicates(spark, path, digest=lambda text: F.substring(exact_dedup.sha256(text), 1, 1))) == _exact(rows)


def test_a_stream_goes_on_with_its_state(spark, tmp_path):
    path, root = str(tmp_path / "documents.parquet"), str(tmp_path / "stream")
    first, later = [(1, "A b"), (2, "c")], [(3, "a B"), (4, "C"), (None, "c"), (4, "C")]
    spark.createDataFrame(first, "doc_id long, text string").write.parquet(path)
    assert _plain(exact_dedup.duplicates(spark, path, root)) == _exact(first)
    spark.createDataFrame(later, "doc_id long, text string").write.mode("append").parquet(path)
    assert _plain(exact_dedup.duplicates(spark, path, root)) == _exact(first + later)


def test_exact_duplicates_odd_rows(spark, odd, none, tmp_path):
    odd.write.parquet(str(tmp_path / "odd.parquet"))
    got = exact_dedup.duplicates(spark, str(tmp_path / "odd.parquet"))
    assert _plain(got) == _exact([(r["doc_id"], r["text"]) for r in odd.collect()])
    none.write.parquet(str(tmp_path / "none.parquet"))
    assert exact_dedup.duplicates(spark, str(tmp_path / "none.parquet")).count() == 0
