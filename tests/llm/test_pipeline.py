"""The stages against plain versions of what they decide, each on its own input."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import mixing, quality
from ledgerlens.llm.common import saved


def words(text, pattern=None):
    import re

    return [w.encode() for w in re.findall(pattern, text)] if pattern else text.encode().lower().split()


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs, seen = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = saved(stage(spark, docs, sf_dir), "stage")
        seen[name], docs = (docs, out), out
    return seen


def test_names_and_columns(stages):
    assert list(stages) == ["quality classifier", "near duplicates", "decontamination", "mixing", "sharding"]
    for name, (before, after) in stages.items():
        assert name == "sharding" or after.columns == before.columns


def test_classifier(spark, sf_dir, stages):
    before, after = stages["quality classifier"]
    scored = quality.score(before, spark.read.parquet(f"{sf_dir}/labels.parquet")).where("predicted = 1")
    assert {r["doc_id"] for r in scored.collect()} == {r["doc_id"] for r in after.collect()}


def test_near_duplicates(stages):
    before, after = stages["near duplicates"]
    sets = {r["doc_id"]: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := words(r["text"] or "")) else None for r in before.collect()}
    label = {i: i for i in sets}
    ids = sorted(i for i in sets if sets[i])
    for a in ids:
        for b in ids:
            if b < a and label[a] != label[b] and 5 * min(len(sets[a]), len(sets[b])) >= 4 * max(len(sets[a]), len(sets[b])):
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    x, y = sorted((label[a], label[b]))
                    label = {i: x if v == y else v for i, v in label.items()}
    assert {r["doc_id"] for r in after.collect()} == {i for i in label if label[i] == i}


def test_decontamination(spark, sf_dir, stages):
    before, after = stages["decontamination"]
    import re

    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = {c: c + 32 for c in range(65, 91)}
    windows = set()
    for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect():
        w = word.findall(r["text"].translate(lower))
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
    assert all(len(w) == 10 for w in windows)
    clean = set()
    for r in before.collect():
        w = word.findall((r["text"] or "").translate(lower))
        if not any(tuple(w[i : i + 10]) in windows for i in range(len(w) - 9)):
            clean.add(r["doc_id"])
    assert {r["doc_id"] for r in after.collect()} == clean


def test_mixing(stages):
    before, after = stages["mixing"]
    size = {r["doc_id"]: r["size"] for r in before.select("doc_id", mixing.word_count(F.col("text")).alias("size")).collect()}
    target = {r["source"]: r["target"] for r in mixing.mix(before).collect()}
    got, copies = {}, {}
    for r in after.collect():
        got[r["source"]] = got.get(r["source"], 0) + size[r["doc_id"]]
        copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + 1
    assert max(copies.values()) <= 3
    longest = {r["source"]: r["m"] for r in before.groupBy("source").agg(F.max(mixing.word_count(F.col("text"))).alias("m")).collect()}
    assert all(abs(got.get(s, 0) - t) <= 2 * longest[s] for s, t in target.items())


def test_run_is_the_last_stage(spark, sf_dir, stages):
    _, after = stages["sharding"]
    cols = ["doc_id", "size", "text_crc32", "shard", "slot"]
    assert sorted(corpus_pipeline.run(spark, sf_dir).select(cols).collect()) == sorted(after.select(cols).collect())


def test_odd_documents(spark, sf_dir, odd, none):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for docs in (odd.select(columns), none):
        for name, stage in corpus_pipeline.STAGES:
            docs = saved(stage(spark, docs, sf_dir), "odd")
        assert docs.count() >= 0


def test_rows_are_judged_by_doc_id_and_text(spark, tmp_path):
    passage = "one two three four five six seven eight nine ten eleven"
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(1, f"so {passage} it goes"), (1, "a clean text"), (1, "a clean text"), (None, passage), (None, "clean without a name"), (None, None), (2, None), (3, passage)]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.decontaminated(spark, docs, str(tmp_path))
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str) == sorted([rows[1], rows[2], rows[4], rows[5], rows[6]], key=str) and got.columns == docs.columns


@pytest.mark.parametrize("repeated", [True, False])
def test_one_row_of_each_group_stays(spark, repeated):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, a), (1, a), (2, f"{a} more"), (4, c), (4, c), (None, a), (None, a), (None, None), (7, None), (7, None), (8, "")]
    kept = [(1, a), (4, c), (None, a), (None, None), (7, None), (8, "")]
    if repeated:
        rows += [(2, b), (5, b), (4, f"{b} more")]
        kept += [(2, b)]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.fold_near_duplicates(spark, docs, "")
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str) == sorted(kept, key=str) and got.columns == docs.columns
