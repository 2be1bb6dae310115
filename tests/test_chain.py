"""Chains: building, every failure reason, anchors, segments and incremental verification."""

import gzip
import hashlib
import hmac as py_hmac
import json
import os

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import mac
from ledgerlens.operators import chain
from ledgerlens.sources import folders, segments, tail, verdicts
from ledgerlens.streaming import jobs

KEY = b"test key"
RECORD = ["action", "note", "user_id"]
ROWS = 30


@pytest.fixture(scope="module")
def built(spark):
    rows = spark.range(ROWS * 2).selectExpr(
        "concat('log', id % 2) AS log", "id AS n", "CAST(floor(id / 7) AS BIGINT) AS part",
        "CASE WHEN id % 3 = 0 THEN 'query' ELSE 'cancel' END AS action", "CASE WHEN id % 4 = 0 THEN 'né' END AS note", "concat('u', id) AS user_id",
    )
    df = chain.build_chain(rows, KEY, "log", "part", ["n"], RECORD, link_records=None)
    return spark.createDataFrame(df.collect(), df.schema)


def expected_mac(row):
    record = {k: row[k] for k in [*RECORD, "chain_id", "seq", "prev_hash"] if row[k] is not None}
    text = json.dumps(record, sort_keys=True, separators=(",", ":"), ensure_ascii=False) + row["prev_hash"]
    return py_hmac.new(KEY, text.encode(), hashlib.sha256).hexdigest()


def test_build_links_every_record(built):
    for name in ("log0", "log1"):
        last = "0" * 64
        rows = built.where(F.col("chain_id") == name).orderBy("n").collect()
        assert [r.seq for r in rows] == list(range(1, ROWS + 1))
        for row in rows:
            assert row.prev_hash == last and row.mac == expected_mac(row) and row.hash == row.mac
            last = row.mac


def test_links_cut_a_chain_in_pieces(spark, built):
    rows = built.select("log", "n", "part", *RECORD)
    df = chain.build_chain(rows, KEY, "log", "part", ["n"], RECORD, link_records=8)
    got = df.groupBy("chain_id").agg(F.min("seq").alias("a"), F.max("seq").alias("b")).orderBy("chain_id").collect()
    assert [(r.chain_id, r.a, r.b) for r in got][:4] == [("log0/000000", 1, 8), ("log0/000001", 1, 8), ("log0/000002", 1, 8), ("log0/000003", 1, 6)]
    assert chain.verify_chain(df, KEY, RECORD).where("NOT intact").count() == 0


def verify(built, change=None, drop=None, anchors=None, block="part", **kw):
    """Verify log0 in file order after one change."""
    df = built.where("log = 'log0'").withColumn("pos", F.col("n"))
    if change:
        df = change(df)
    if drop is not None:
        df = df.where(~drop)
    (row,) = chain.verify_chain(df, KEY, RECORD, ["log"], block, ["pos"], anchors, **kw).collect()
    return row


def at(seq, column, value):
    return lambda df: df.withColumn(column, F.when(F.col("pos") == (seq - 1) * 2, F.lit(value)).otherwise(F.col(column)))


def both(*changes):
    def apply(df):
        for change in changes:
            df = change(df)
        return df

    return apply


def test_intact(built):
    row = verify(built)
    assert row.intact and row.reason is None and row.events == ROWS and row.observed_seq == ROWS


FAULTS = [
    (at(5, "note", "edited"), "mac_mismatch", 4),
    (at(5, "prev_hash", "short"), "malformed", 4),
    (at(5, "seq", None), "malformed", 4),
    (at(5, "seq", 0), "malformed", 4),
    (at(5, "chain_id", ""), "malformed", 4),
    (at(5, "chain_id", "other"), "chain_id_mismatch", 4),
    (at(5, "seq", 9), "seq_gap", 4),
    (at(5, "seq", 4), "seq_duplicate", 4),
    (at(5, "seq", 2), "seq_regression", 4),
    (at(5, "prev_hash", "a" * 64), "prev_hash_mismatch", 4),
    (at(5, "mac", "none"), "malformed", 4),
    (at(5, "hash", "b" * 64), "malformed", 4),
    (both(at(5, "mac", "c" * 64), at(5, "hash", "c" * 64)), "mac_mismatch", 4),
    (at(1, "seq", 3), "seq_gap", 0),
    (at(1, "prev_hash", "a" * 64), "prev_hash_mismatch", 0),
    (at(1, "note", "edited"), "mac_mismatch", 0),
    (both(at(20, "note", "x"), at(9, "seq", 8)), "seq_duplicate", 8),
]


@pytest.mark.parametrize(("change", "reason", "place"), FAULTS)
def test_first_failure_decides(built, change, reason, place):
    row = verify(built, change)
    assert (row.intact, row.reason, row.broken_at, row.events) == (False, reason, place, place + 1)


def test_lost_and_swapped_records(built):
    assert verify(built, drop=F.col("seq") == 6).reason == "seq_gap"
    assert verify(built, drop=F.col("seq") == 1).reason == "seq_gap"
    swapped = verify(built, lambda df: df.withColumn("pos", F.when(F.col("pos") == 10, 13).otherwise(F.col("pos"))))
    assert (swapped.reason, swapped.broken_at) == ("seq_gap", 5)


def test_malformed_line(built):
    row = verify(built, lambda df: df.withColumn("malformed", F.col("seq") == 3))
    assert (row.reason, row.broken_at) == ("malformed", 2)


def test_block_size_does_not_change_the_verdict(built):
    for change, reason, place in FAULTS[:13]:
        for size in (1, 4, 1000):
            df = built.where("log = 'log0'").withColumn("pos", F.col("n"))
            df = change(df).withColumn("b", F.floor(F.col("pos") / size))
            row = chain.verify_chain(df, KEY, RECORD, ["log"], "b", ["pos"]).first()
            assert (row.reason, row.broken_at) == (reason, place), size


def test_join_form_agrees_in_sequence_order(built):
    for seq, column in ((5, "note"), (1, "note"), (9, "user_id")):
        df = at(seq, column, "edited")(built.withColumn("pos", F.col("n")))
        for damaged in (df, df.where("seq <> 7")):
            windows = chain.verify_chain(damaged, KEY, RECORD).select("chain_id", "intact", "reason", "broken_seq")
            joined = chain.verify_by_join(damaged, KEY, RECORD)
            assert sorted(map(tuple, windows.collect())) == sorted(map(tuple, joined.collect()))


def test_join_form_knows_repeated_numbers_and_malformed_records(built):
    """One row a chain, however often a number repeats."""
    again = built.where("seq = 6")
    broken = F.when(F.col("seq") == 4, "none")
    for damaged in (
        built.unionByName(again), built.unionByName(again).unionByName(again).unionByName(again),
        built.withColumn("mac", F.coalesce(broken, "mac")), built.withColumn("prev_hash", F.coalesce(broken, "prev_hash")),
        built.withColumn("malformed", F.col("seq") == 8), built.unionByName(again.withColumn("malformed", F.lit(True)), allowMissingColumns=True),
    ):
        windows = chain.verify_chain(damaged.fillna(False, ["malformed"]) if "malformed" in damaged.columns else damaged, KEY, RECORD)
        joined = chain.verify_by_join(damaged.fillna(False, ["malformed"]) if "malformed" in damaged.columns else damaged, KEY, RECORD)
        got = sorted(map(tuple, joined.collect()))
        assert len(got) == len({r[0] for r in got}) and not any(r[1] for r in got)
        if damaged.count() == built.count():
            assert got == sorted(map(tuple, windows.select("chain_id", "intact", "reason", "broken_seq").collect()))
        else:
            assert {(r[2], r[3]) for r in got} <= {("seq_duplicate", 6), ("malformed", 6)}


def anchors(spark, **values):
    base = {"log": "log0", "anchor_chain_id": "log0", "anchor_seq": None, "anchor_hash": None, "retained_from_seq": None, "conflict": False, "expected_prev_hash": None}
    schema = "log string, anchor_chain_id string, anchor_seq long, anchor_hash string, retained_from_seq long, conflict boolean, expected_prev_hash string"
    return spark.createDataFrame([tuple((base | values).values())], schema)


def test_anchor_comparison(spark, built):
    head = built.where("log = 'log0'").orderBy(F.desc("seq")).first()
    assert verify(built, anchors=anchors(spark, anchor_seq=ROWS, anchor_hash=head.mac)).intact
    assert verify(built, anchors=anchors(spark, anchor_seq=ROWS + 1, anchor_hash=head.mac)).reason == "seq_regression"
    assert verify(built, anchors=anchors(spark, anchor_seq=ROWS - 1, anchor_hash=head.mac)).reason == "head_mismatch"
    assert verify(built, anchors=anchors(spark, anchor_seq=ROWS, anchor_hash="x")).reason == "head_mismatch"
    assert verify(built, anchors=anchors(spark, anchor_seq=ROWS, anchor_hash=head.mac, anchor_chain_id="log9")).reason == "chain_id_mismatch"
    conflict = verify(built, anchors=anchors(spark, anchor_seq=ROWS, anchor_hash=head.mac, conflict=True))
    assert (conflict.reason, conflict.events) == ("head_mismatch", 0)


def test_missing_logs(spark, built):
    none = built.where("false").withColumn("pos", F.col("n"))
    assert chain.verify_chain(none, KEY, RECORD, ["log"], "part", ["pos"], anchors(spark, anchor_seq=3)).first().reason == "log_missing"
    assert chain.verify_chain(none, KEY, RECORD, ["log"], "part", ["pos"], anchors(spark, anchor_seq=0)).first().reason == "empty"


def test_retained_window_adopts_its_first_link(spark, built):
    kept = verify(built, drop=F.col("seq") < 11, anchors=anchors(spark, retained_from_seq=11))
    assert kept.intact and kept.events == ROWS - 10
    assert verify(built, drop=F.col("seq") < 12, anchors=anchors(spark, retained_from_seq=11)).reason == "seq_gap"
    assert verify(built, drop=F.col("seq") < 10, anchors=anchors(spark, retained_from_seq=11)).reason == "seq_regression"


def test_incremental_equals_full(spark, built):
    """Resuming after a verified prefix gives the full verdict, for a clean and a damaged rest."""
    tenth = built.where("log = 'log0' AND seq = 10").first()
    resume = anchors(spark, retained_from_seq=11, expected_prev_hash=tenth.mac)
    rest = F.col("seq") <= 10
    assert verify(built, drop=rest, anchors=resume).intact
    for change in (at(15, "note", "x"), at(11, "prev_hash", "a" * 64), at(30, "mac", "z")):
        full, part = verify(built, change), verify(built, change, drop=rest, anchors=resume)
        assert (full.reason, full.broken_seq, full.broken_at) == (part.reason, part.broken_seq, part.broken_at + 10)


def test_segment_wise_equals_full(spark, built):
    """Trusted segments are skipped; any damage in what is read, or a broken join, still shows."""
    clean = built.where("log = 'log0'").withColumns({"pos": F.col("n"), "line_no": F.col("n"), "file_ord": F.floor((F.col("seq") - 1) / 8)})
    ends = clean.groupBy("file_ord").agg(
        F.max("seq").alias("seq"), F.max_by("mac", "seq").alias("last_hash"), F.max_by("chain_id", "seq").alias("chain_id")
    )
    def reasons(df, trusted=None, first=None):
        cached = ends.where(F.col("file_ord").isin(trusted)) if trusted else None
        got = chain.verify_segments(df, KEY, RECORD, cached=cached, first=first).collect()
        return {r.file_ord: r.reason for r in got}
    assert reasons(clean) == {0: None, 1: None, 2: None, 3: None}
    assert reasons(clean, [0, 2]) == {1: None, 3: None}
    for change in (at(12, "note", "x"), at(17, "prev_hash", "a" * 64), at(9, "seq", 7), at(16, "mac", "c" * 64)):
        damaged = change(clean)
        full = chain.verify_chain(damaged.withColumn("b", F.lit(0)), KEY, RECORD, ["log"], "b", ["pos"]).first()
        split = {k: v for k, v in reasons(damaged, [0]).items() if v}
        assert full.reason == split[min(split)]
    kept = clean.where("file_ord > 0")
    floor = spark.createDataFrame([(1, 9)], "file_ord long, retained_from_seq long")
    assert reasons(kept, first=floor) == {1: None, 2: None, 3: None}
    assert reasons(kept)[1] == "seq_gap"
    assert reasons(clean.where("file_ord <> 2"))[3] == "seq_gap"


def test_resolve_anchor(spark):
    schema = "log_id string, ord int, chain_id string, seq long, last_hash string, retained_from_seq long"
    rows = [
        ("a", 1, "c", 5, "h5", None), ("a", 2, "c", 7, "h7", 3), ("a", 3, "c", 6, "h6", 2),
        ("b", 1, "c", 5, "h5", None), ("b", 2, "c", 5, "h5", 4), ("c", 1, "c", 5, "h5", None), ("c", 2, "c", 5, "hx", None),
    ]
    got = {r.log_id: (r.anchor_seq, r.anchor_hash, r.retained_from_seq, r.conflict) for r in chain.resolve_anchor(spark.createDataFrame(rows, schema)).collect()}
    assert got["a"] == (7, "h7", 3, False)
    assert got["b"] == (5, "h5", 4, False)
    assert got["c"][3] is True


# --- segments -----------------------------------------------------------------------------------


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "audit-2.jsonl").write_text('﻿{"id":"a","seq":1}\n\n{"id":"b","seq":2}\n', encoding="utf-8")
    (tmp_path / "audit-10.jsonl").write_text('{"id":"old","seq":0}\r\n', encoding="utf-8")
    (tmp_path / "audit-1.jsonl").write_text('{"id":"c"\n["array"]\n{"id":"d","seq":3} tail\n{"a":1},{"b":2}\n"text"\n{"id":"e","new":[1]}', encoding="utf-8")
    (tmp_path / "audit.jsonl").write_text('  \n{"id":"f","seq":"x"}\n', encoding="utf-8")
    (tmp_path / "notes.jsonl").write_text('{"id":"never"}\n')
    return str(tmp_path)


def test_read_segments_in_log_order(spark, folder):
    rows = segments.read_segments(spark, folder).orderBy("file_ord", "line_no").collect()
    assert [(r.file_ord, r.id, r.malformed) for r in rows] == [
        (-10, "old", False), (-2, "a", False), (-2, "b", False),
        (-1, None, True), (-1, None, True), (-1, None, True), (-1, None, True), (-1, None, True), (-1, "e", False), (0, "f", False),
    ]
    assert [r.line_no for r in rows if r.file_ord == -2] == [0, 2]


def test_split_reading_equals_whole_reading(spark, tmp_path):
    lines = [json.dumps({"id": f"r{i}", "note": "x" * (i % 50)}) for i in range(5000)]
    (tmp_path / "audit.jsonl").write_text("\n".join(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        split = segments.read_segments(spark, str(tmp_path)).select("line_no", "id").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r.line_no, r.id) for r in split) == sorted((i, f"r{i}") for i in range(5000))


def test_write_verify_and_retain(spark, built, tmp_path):
    path = str(tmp_path / "log")
    one = built.where("log = 'log0'")
    floor = segments.write_segments(one, path, [*RECORD, *chain.LINK, "mac", "hash"], max_rows=7, keep=3).first()
    assert (floor.segments, floor.first_segment, floor.retained_from_seq) == (3, 2, 15)
    schema = "action string, note string, user_id string, chain_id string, seq long, prev_hash string, mac string, hash string"
    read = segments.read_segments(spark, path, spark.createDataFrame([], schema).schema).withColumn("log", F.lit("log0"))
    assert read.count() == ROWS - 14
    for raw in (None, "raw"):
        row = chain.verify_chain(read, KEY, RECORD, ["log"], "file_ord", ["file_ord", "line_no"], anchors(spark, retained_from_seq=15), raw=raw).first()
        assert row.intact and row.events == ROWS - 14


def test_all_segments_are_written_unless_told(spark, tmp_path):
    rows = spark.createDataFrame([(i, "x") for i in range(1, 41)] + [(None, "y")], "seq long, note string")
    floor = segments.write_segments(rows, str(tmp_path / "all"), ["seq", "note"], max_rows=2).first()
    assert (floor.segments, floor.retained_from_seq) == (20, 1)
    assert spark.read.text(str(tmp_path / "all")).count() == 41


def test_nested_keys_named_like_the_mac_are_covered(spark):
    lines = [json.dumps({"seq": 1, "mac": "m", "x": {"mac": v, "hash": "h"}}) for v in ("a", "b")]
    got = spark.createDataFrame([(x,) for x in lines], "raw string").selectExpr(f"{mac.canonical_line('raw')} AS c").distinct()
    assert {r.c for r in got.collect()} == {'{"seq":1,"x":{"hash":"h","mac":"%s"}}' % v for v in "ab"}


def test_raw_verification_covers_unknown_fields(spark):
    record = {"chain_id": "c", "seq": 1, "prev_hash": "0" * 64, "extra": {"b": 1, "a": [1.5, None]}, "t": "é"}
    text = json.dumps(record, sort_keys=True, separators=(",", ":"), ensure_ascii=False) + record["prev_hash"]
    seal = py_hmac.new(KEY, text.encode(), hashlib.sha256).hexdigest()
    line = json.dumps(record | {"mac": seal, "hash": seal}, ensure_ascii=False)
    schema = "chain_id string, seq long, prev_hash string, mac string, hash string"
    for raw, reason in ((line, None), (line.replace("1.5", "1.6"), "mac_mismatch")):
        df = segments.parse_lines(spark.createDataFrame([(raw,)], "raw string"), spark.createDataFrame([], schema).schema)
        assert chain.verify_chain(df, KEY, [], raw="raw").first().reason == reason


def test_manifest_of_files(spark, folder):
    paths = {r.path.rsplit("/", 1)[1]: r.length for r in segments.manifest(spark, folder, "k").collect()}
    assert set(paths) == {"audit-10.jsonl", "audit-2.jsonl", "audit-1.jsonl", "audit.jsonl"}
    assert paths["audit-10.jsonl"] == 22


def test_only_changed_segments_are_verified_again(spark, built, tmp_path):
    path = tmp_path / "log"
    one = built.where("log = 'log0'")
    segments.write_segments(one, str(tmp_path / "written"), [*RECORD, *chain.LINK, "mac", "hash"], max_rows=7)
    files = {}
    for written in (tmp_path / "written").glob("segment=*/*.txt"):  # copied without the checksum files, to be altered below
        n = int(written.parent.name.split("=")[1])
        files[n] = path / f"segment={n}" / "part.txt"
        files[n].parent.mkdir(parents=True)
        files[n].write_bytes(written.read_bytes())
    for n, file in files.items():
        os.utime(file, ns=(10**18 + n * 10**9 + 5 * 10**6,) * 2)
    before = segments.manifest(spark, str(path), "k").withColumn("records", F.lit(7))
    before = spark.createDataFrame(before.collect(), before.schema)
    assert sorted(r.first_seq for r in before.collect()) == [1 + 7 * n for n in sorted(files)]
    assert segments.changed_segments(segments.manifest(spark, str(path), "k"), before).count() == 0
    assert segments.changed_segments(segments.manifest(spark, str(path), "other"), before).count() == len(files)

    # a record of segment 1 is altered: only that file is read again, and its verdict is that of the whole log
    lines = files[1].read_text().splitlines(keepends=True)
    files[1].write_text("".join([lines[0].replace('"seq":8', '"seq":8,"note":"forged"', 1), *lines[1:]]))
    os.utime(files[1], ns=(10**18 + 77 * 10**9 + 5 * 10**6,) * 2)
    changed = segments.changed_segments(segments.manifest(spark, str(path), "k"), before).collect()
    assert [r.path.rsplit("/", 2)[1] for r in changed] == ["segment=1"]
    schema = "action string, note string, user_id string, chain_id string, seq long, prev_hash string, mac string, hash string"
    read = segments.read_segments(spark, str(path), spark.createDataFrame([], schema).schema)
    ends = read.groupBy("file_ord").agg(F.max_by(F.struct("chain_id", "seq", F.col("mac").alias("last_hash")), "line_no").alias("e"))
    cached = ends.where("file_ord <> 1").select("file_ord", "e.*")
    got = chain.verify_segments(read, KEY, RECORD, cached=cached, raw="raw").collect()
    assert [(r.file_ord, r.reason) for r in got] == [(1, "mac_mismatch")]
    whole = chain.verify_chain(read.withColumn("log", F.lit("l")), KEY, RECORD, ["log"], "file_ord", ["file_ord", "line_no"], raw="raw").first()
    assert (whole.reason, whole.broken_seq) == (got[0].reason, got[0].broken_seq)


def test_a_repeated_or_failed_write_leaves_one_copy(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = spark.createDataFrame([(i, "x") for i in range(1, 41)], "seq long, note string")
    for _ in range(2):
        segments.write_segments(rows, path, ["seq", "note"], max_rows=10)
    assert spark.read.text(path).count() == 40
    broken = rows.withColumn("note", F.when(F.col("seq") == 35, F.raise_error(F.lit("broken"))).otherwise("y"))
    with pytest.raises(Exception, match="broken"):
        segments.write_segments(broken, path, ["seq", "note"], max_rows=10)
    assert spark.read.text(path).where("value like '%x%'").count() == 40
    # whole segments go on and replace; retention removes what is older
    more = spark.createDataFrame([(i, "z") for i in range(31, 61)], "seq long, note string")
    floor = segments.write_segments(more, path, ["seq", "note"], max_rows=10, keep=3).first()
    assert tuple(floor) == (3, 3, 31)
    assert sorted(p.name for p in (tmp_path / "log").glob("segment=*")) == ["segment=3", "segment=4", "segment=5"]
    assert spark.read.text(path).where("value like '%z%'").count() == spark.read.text(path).count() == 30


def test_bytes_between_offsets():
    before = {"a": [10, "A"], "b": [20, "B"], "c": [30, "C"], "d": [5, "D"], "e": [7, "D"]}
    now = {"a": [15, "A"], "b": [8, "B"], "c": [4, "X"], "c.1": [33, "C"], "f": [9, "D"], "new": [3, "N"]}
    assert tail.added(before, now) == [("a", 10, 15), ("b", 0, 8), ("c", 0, 4), ("c.1", 30, 33), ("f", 0, 9), ("new", 0, 3)]
    assert tail.added(now, now) == []


def test_short_ranges_are_packed_into_few_tasks():
    """The number of tasks does not grow with a log of short ranges, and a task has no more bytes than one long range."""
    reader = tail.GrowingLinesReader({"path": "/nowhere", "rangebytes": "4096", "tasks": "24"})
    for size in (10 * 4096, 24 * 4096 * 1000 + 5):
        packed = reader.partitions({"files": {}}, {"files": {"a": [size, "A"], "b": [100, "B"]}})
        ranges = [r for p in packed for r in p.ranges]
        assert len(packed) <= 24 and sum(r.stop - r.first for r in ranges) == size + 100
        assert [r.whole for r in ranges].count(True) == 2
    large = reader.partitions({"files": {}}, {"files": {"a": [100 * tail.RANGE_BYTES, "A"]}})
    assert len(large) == 100 and max(sum(r.stop - r.first for r in p.ranges) for p in large) == tail.RANGE_BYTES


@pytest.mark.parametrize("range_bytes", [7, 1000])
def test_a_growing_file_is_followed(spark, tmp_path, range_bytes):
    folder, root = tmp_path / "log", str(tmp_path / "stream")
    folder.mkdir()
    active = folder / "audit.jsonl"

    def seen():
        stream = segments.follow_segments(spark, str(folder), range_bytes=range_bytes).select("id")
        return sorted(r.id for r in jobs.run_to_table(stream, "tail", root=root).collect())

    active.write_text('﻿{"id":"é1"}\r\n{"id":"2"}\n{"id":"3"', encoding="utf-8")
    (folder / "notes.txt").write_text('{"id":"never"}\n')
    assert seen() == ["2", "é1"]
    with active.open("a") as file:  # the open line ends, another is broken, a last one is not ended
        file.write('}\nnot json\n\n{"id":"4"}\n{"id"')
    assert seen() == ["2", "3", "4", "é1"]
    active.rename(folder / "audit-1.jsonl")  # rotated, and the archive still grows
    with (folder / "audit-1.jsonl").open("a") as file:
        file.write(':"5"}\n')
    active.write_text('{"id":"6"}\n')
    assert seen() == ["2", "3", "4", "5", "6", "é1"]
    active.write_text('{"id":"7"}\n{"id":"8"}\n')  # replaced
    assert seen() == ["2", "3", "4", "5", "6", "7", "8", "é1"]
    active.write_text('{"id":"7"}\n')  # cut short: from its start again
    assert seen() == ["2", "3", "4", "5", "6", "7", "7", "8", "é1"]


def test_following_may_begin_at_the_end(spark, tmp_path):
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "audit.jsonl").write_text('{"id":"1"}\n')
    def seen():
        return [r.id for r in jobs.run_to_table(segments.follow_segments(spark, str(tmp_path / "log"), begin="end").select("id"), "tail", root=str(tmp_path / "s")).collect()]
    assert seen() == []
    with (tmp_path / "log" / "audit.jsonl").open("a") as file:
        file.write('{"id":"2"}\n')
    assert seen() == ["2"]


def test_incremental_verification_equals_the_full_one(spark, built, tmp_path):
    """After every change the kept verdicts are those of a verification from scratch, and only what was touched is read."""
    path, store = str(tmp_path / "log"), str(tmp_path / "store")
    schema = spark.createDataFrame([], "action string, note string, user_id string, chain_id string, seq long, prev_hash string, mac string, hash string").schema
    one = built.where("log = 'log0'")
    columns = [*RECORD, *chain.LINK, "mac", "hash"]

    def write(rows):
        segments.write_segments(rows, path, columns, max_rows=7)
        for n, file in enumerate(sorted((tmp_path / "log").glob("segment=*/*.txt"))):  # never a whole second
            stat = os.stat(file)
            if stat.st_mtime_ns % 10**9 < 10**6:
                os.utime(file, ns=(stat.st_mtime_ns + 5 * 10**6,) * 2)

    def verify():
        found = {r.file_ord: (r.reason, r.broken_seq, r.read) for r in verdicts.verify_incrementally(spark, path, store, KEY, RECORD, schema=schema).collect()}
        whole = verdicts.verify_incrementally(spark, path, str(tmp_path / f"fresh{len(list(tmp_path.iterdir()))}"), KEY, RECORD, schema=schema).collect()
        assert {r.file_ord: (r.reason, r.broken_seq) for r in whole} == {n: f[:2] for n, f in found.items()}
        return {n: f[0] for n, f in found.items()}, {n for n, f in found.items() if f[2]}

    write(one.where("seq <= 20"))
    assert verify() == ({0: None, 1: None, 2: None}, {0, 1, 2})
    assert verify() == ({0: None, 1: None, 2: None}, set())
    write(one.where("seq > 14"))  # grows
    assert verify() == ({n: None for n in range(5)}, {2, 3, 4})
    write(one.where("seq between 8 and 14").withColumn("note", F.when(F.col("seq") == 9, "forged").otherwise(F.col("note"))))
    assert verify() == ({0: None, 1: "mac_mismatch", 2: None, 3: None, 4: None}, {1})
    assert verify()[1] == {1}  # what has failed is never trusted
    write(one.where("seq between 8 and 14"))
    write(one.where("seq between 15 and 20"))  # a lost record: the next segment, itself unchanged, no longer follows
    assert verify() == ({0: None, 1: None, 2: None, 3: "seq_gap", 4: None}, {1, 2, 3})
    assert verdicts.latest_version(store) == 6
    for file in (tmp_path / "log" / "segment=0").iterdir():
        file.unlink()
    assert verify()[0] == {1: "seq_gap", 2: None, 3: "seq_gap", 4: None}


def test_listings_of_segments_stay_off_the_driver(spark, tmp_path):
    """No job has a task a segment, which each send names and states to the driver; hidden, empty and oddly named files are treated as by Spark's readers."""
    log = tmp_path / "my log"
    for n in range(60):
        folder = log / f"segment={n}"
        folder.mkdir(parents=True)
        (folder / "part 1.txt").write_text("" if n == 7 else f'\ufeff\r\n \t\n{{"id":"{n}","seq":{n + 1},"chain_id":"c","prev_hash":"h"}}\r\n{{"id":"last"}}', encoding="utf-8")
        (folder / "_SUCCESS").write_text("x")
        (folder / ".part 1.txt.crc").write_text("x")
    group = "listings"
    spark.sparkContext.setJobGroup(group, group)
    try:
        files = segments.manifest(spark, str(log), "k")
        found = {r.path: (r.length, r.mtime_ns, r.first_seq, r.first_prev_hash, r.chain_id) for r in files.collect()}
        some = files.where("first_seq > 50 or length = 0")
        lines = [segments.read_segments(spark, str(log), files=kept).select("id", "file", "file_ord", "line_no", "malformed").collect() for kept in (None, some, files.where("false"))]
        tracker = spark.sparkContext.statusTracker()
        stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert stages and max(s.numTasks for s in stages if s) < 60
    for n in range(60):
        file = log / f"segment={n}" / "part 1.txt"
        state = file.stat()
        first = (None, None, None) if n == 7 else (n + 1, "h", "c")
        assert found.pop(f"file:{file}") == (state.st_size, state.st_mtime_ns // 10**6 * 10**6, *first)
    assert not found

    def expected(kept):
        return sorted((i, f"segment={n}/part%201.txt", n, at, False) for n in kept if n != 7 for i, at in ((str(n), 2), ("last", 3)))

    assert [sorted(map(tuple, x)) for x in lines] == [expected(range(60)), expected(range(50, 60)), []]


@pytest.mark.parametrize("most", [1, 7, 64, 10**6])
def test_ranges_of_bytes_have_each_line_once(spark, tmp_path, most, monkeypatch):
    """Whatever the ranges and reads, the lines are those of Spark's reader."""
    monkeypatch.setattr(folders, "READ_BYTES", 5)
    texts = ["", "\n", "a", "a\n", "\n\nb", "x" * 40 + "\n" + "é" * 9 + "\r\n\n", "one\ntwo\nthree"]
    for n, text in enumerate(texts):
        (tmp_path / f"audit-{n + 1}.jsonl").write_bytes(text.encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(most))
    try:
        found = sorted((r.file_ord, r.line_no, r.raw) for r in segments.read_segments(spark, str(tmp_path)).select("file_ord", "line_no", "raw").collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    by_spark = {-n - 1: [r.value for r in spark.read.option("lineSep", "\n").text(str(tmp_path / f"audit-{n + 1}.jsonl")).collect()] for n in range(len(texts))}
    assert found == sorted((n, at, line.rstrip("\r")) for n, lines in by_spark.items() for at, line in enumerate(lines) if line.strip())


def test_packed_segments_and_patterns_of_names_are_read_by_spark(spark, tmp_path):
    for n in range(2):
        folder = tmp_path / "log" / f"segment={n}"
        folder.mkdir(parents=True)
        (folder / ("part.txt.gz" if n else "part.txt")).write_bytes(gzip.compress(b'{"id":"1","seq":5}\n') if n else b'{"id":"0"}\n')
    for path, ids in ((tmp_path / "log", ["0", "1"]), (tmp_path / "log" / "segment=*", ["0", "1"]), (tmp_path / "log" / "segment=1", ["1"])):
        assert sorted(r.id for r in segments.read_segments(spark, str(path)).collect()) == ids
        files = segments.manifest(spark, str(path), "k")
        assert sorted(r.first_seq or 0 for r in files.collect()) == [5 * int(i) for i in ids]
        assert sorted(r.id for r in segments.read_segments(spark, str(path), files=files).collect()) == ids
