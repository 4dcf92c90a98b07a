"""JSON scans, samples, types that drift, and loading only new files."""

import hashlib
import json
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.samples import stable_sample
from tidemark.operators.targets import Target, TooManyRejects
from tidemark.plans.jobs import load_files
from tidemark.sources.drift import json_drift
from tidemark.sources.files import preview, preview_pandas, read_json, read_json_or_reject
from tidemark.sources.manifest import ChangedFiles
from tidemark.streaming.files import load_new_files


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    for place, numbers in (("one.json", [1, 2]), ("a/two.json", [3]), ("a/b/three.json", [4, 5])):
        (tmp_path / place).write_text("".join(json.dumps({"n": n, "who": {"name": f"x{n}"}}) + "\n" for n in numbers))
    return tmp_path


def test_recursive_json(spark, folder):
    frame = read_json(spark, str(folder))
    assert frame.schema.simpleString() == "struct<n:bigint,who:struct<name:string>>"
    assert sorted(row.n for row in frame.collect()) == [1, 2, 3, 4, 5]
    assert sorted(row.n for row in read_json(spark, str(folder / "a"), "n int", recursive=False).collect()) == [3]
    assert read_json(spark, [str(folder / "one.json"), str(folder / "a")], "n int").count() == 5
    assert read_json(spark, str(folder), sampling_ratio=0.9).count() == 5


def test_samples_are_bounded(spark, folder):
    frame = read_json(spark, str(folder))
    assert preview(frame, 2).count() == 2
    assert len(preview_pandas(frame)) == 5
    assert len(preview_pandas(frame, 3)) == 3


def test_only_new_files_are_loaded(spark, folder, database, tmp_path_factory):
    seen, table = str(tmp_path_factory.mktemp("seen")), f"`{database}`.`feed`"
    for _ in range(2):
        load_new_files(spark, str(folder), "n int", table, seen, files_per_batch=2)
        assert spark.table(table).count() == 5
    (folder / "a" / "four.json").write_text('{"n": 6}\n')
    load_new_files(spark, str(folder), "n int", table, seen)
    assert sorted(row.n for row in spark.table(table).collect()) == [1, 2, 3, 4, 5, 6]


def test_a_broken_line_is_no_row(spark, folder, database, tmp_path_factory):
    (folder / "broken.json").write_text('{"n": 7}\n{"n": 8\n\n{"n": "x"}\n')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_json(spark, str(folder), "n int").collect()
    good, bad = read_json_or_reject(spark, str(folder), T.StructType.fromDDL("n int"))
    assert sorted(r.n for r in good.collect()) == [1, 2, 3, 4, 5, 7]
    assert sorted(r.record for r in bad.collect()) == ['{"n": "x"}', '{"n": 8']
    table = f"`{database}`.`feed`"
    with pytest.raises(Exception, match="(?i)malformed|failfast|stream"):
        load_new_files(spark, str(folder), "n int", table, str(tmp_path_factory.mktemp("seen")))
    assert spark.table(table).where("n IS NULL").count() == 0


# -- loads of files --------------------------------------------------------------------------------------


@pytest.fixture
def target(spark, database):
    return Target(spark, database, "feed")


def numbers(target):
    return sorted(row.n for row in target.read().collect())


def test_new_files_are_published_with_their_rows(spark, folder, target):
    report = load_files(target, str(folder), "n int", "n").collect()
    assert [(r.table_name, r.status, r.n_rows, r.n_rejects, r.high_key, r.n_files) for r in report] == [("feed", "ok", 5, 0, 5, 3)]
    segments = target.state().segments
    assert load_files(target, str(folder), "n int", "n").first().n_files == 0
    assert target.state().segments == segments and numbers(target) == [1, 2, 3, 4, 5]
    (folder / "odd [1]{2}*?.json").write_text('{"n": 6}\n')
    (folder / "empty.json").write_text("")
    # a file without content is not listed, so that it is new when it gets some
    assert load_files(target, str(folder), "n int", "n").first().n_files == 1
    (folder / "empty.json").write_text('{"n": 7}\n')
    assert load_files(target, str(folder), "n int", "n").first().n_files == 1
    assert numbers(target) == [1, 2, 3, 4, 5, 6, 7] and target.files().count() == 5
    os.remove(folder / "one.json")  # what was loaded stays
    assert load_files(target, str(folder), "n int", "n").first().n_rows == 0
    assert numbers(target) == [1, 2, 3, 4, 5, 6, 7]


def test_files_in_several_steps(spark, folder, database):
    target = Target(spark, database, "feed", max_segments=3)
    for i in range(5):
        (folder / f"more{i}.json").write_text(json.dumps({"n": 10 + i}) + "\n")
    report = load_files(target, str(folder), "n int", "n", files_at_a_time=1).collect()
    assert [r.n_files for r in report] == [1] * 8
    assert numbers(target) == [1, 2, 3, 4, 5, 10, 11, 12, 13, 14]
    # neither segments nor lists of files pile up, and none is forgotten
    assert len(target.state().segments) <= 3 and len(target.state().files) <= 3
    assert target.files().count() == 8 and load_files(target, str(folder), "n int", "n").first().n_files == 0


def test_a_lost_run_is_repeated_without_double_rows(spark, folder, target, monkeypatch):
    load_files(target, str(folder / "a"), "n int", "n")
    tables = set(target._segment_tables())
    with monkeypatch.context() as lost:
        lost.setattr(Target, "_publish", lambda self, state: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            load_files(target, str(folder), "n int", "n")
    assert numbers(target) == [3, 4, 5] and target.files().count() == 2
    left = set(target._segment_tables()) - tables
    assert len(left) == 2  # a segment and its list of files
    for _ in range(2):
        load_files(target, str(folder), "n int", "n")
    assert numbers(target) == [1, 2, 3, 4, 5] and target.files().count() == 3
    assert not left & set(target._segment_tables())


def test_changed_files_are_refused_by_name(spark, folder, target):
    load_files(target, str(folder), "n int", "n")
    with (folder / "a" / "two.json").open("a") as file:
        file.write('{"n": 9}\n')
    (folder / "new.json").write_text('{"n": 10}\n')
    with pytest.raises(ChangedFiles, match="two.json") as refused:
        load_files(target, str(folder), "n int", "n")
    assert len(refused.value.paths) == 1 and numbers(target) == [1, 2, 3, 4, 5]
    os.utime(folder / "one.json", (1, 1))
    with pytest.raises(ChangedFiles, match="one.json.*two.json|two.json.*one.json"):
        load_files(target, str(folder), "n int", "n")


def test_a_file_that_grows_while_it_is_read(spark, folder, target, monkeypatch):
    prepare = Target.prepare_append

    def slow(self, *args, **options):
        pending = prepare(self, *args, **options)
        with (folder / "one.json").open("a") as file:
            file.write('{"n": 9}\n')
        return pending

    monkeypatch.setattr(Target, "prepare_append", slow)
    with pytest.raises(ChangedFiles, match="one.json"):
        load_files(target, str(folder), "n int", "n")
    assert not target.exists() and target._segment_tables() == []


def test_broken_lines_and_misfits_are_rejects(spark, folder, target):
    (folder / "broken.json").write_text('{"n": 7, "s": "300"}\n{"n": 8\n\n{"n": "x"}\n{"n": 9, "s": "y"}\n')
    columns = [("n", T.LongType()), ("s", T.ShortType())]
    with pytest.raises(TooManyRejects, match="3 rows do not fit"):
        load_files(target, str(folder), "n int, s string", "n", columns, max_errors=3)
    assert not target.exists()
    report = load_files(target, str(folder), "n int, s string", "n", columns, max_errors=4).first()
    assert (report.n_rows, report.n_rejects, report.n_files) == (6, 3, 4)
    reasons = {r.record: [tuple(x) for x in r.reasons] for r in target.rejects().collect()}
    assert reasons == {
        '{"n": 8': [("_corrupt_record", None, "record")],
        '{"n": "x"}': [("_corrupt_record", None, "record")],
        '{"n":9,"s":"y"}': [("s", "y", "smallint")],
    }
    assert [(r.n, r.s) for r in target.read().where("n >= 7").collect()] == [(7, 300)]


def test_other_formats(spark, tmp_path, target):
    (tmp_path / "a.csv").write_text("1;x\n2;y\nz;w\n")
    assert load_files(target, str(tmp_path), "n int, t string", "n", file_format="csv", options={"sep": ";"}, max_errors=2).first().n_rejects == 1
    assert [tuple(r) for r in target.read().orderBy("n").collect()] == [(1, "x"), (2, "y")]
    assert target.rejects().first().record == "z;w"
    spark.range(5, 8).selectExpr("int(id) n", "'p' t").write.parquet(str(tmp_path / "more"))
    report = load_files(target, str(tmp_path / "more"), "n int, t string", file_format="parquet", pattern="*.parquet")
    assert report.first().n_rows == 3 and target.read().count() == 5


# -- drift -----------------------------------------------------------------------------------------------

KINDS = {bool: "BOOLEAN", int: "BIGINT", float: "DECIMAL", str: "STRING", type(None): "VOID", list: "ARRAY", dict: "OBJECT"}


def seen(value, path="$"):
    found = {(path, KINDS[type(value)])}
    for name, item in value.items() if isinstance(value, dict) else ():
        found |= seen(item, f"{path}.{name}")
    for item in value if isinstance(value, list) else ():
        found |= seen(item, f"{path}[]")
    return found


def test_drift_counts_each_record_once(spark, tmp_path):
    records = [
        {"a": 1, "b c": {"x": True, "it's": None}, "list": [{"k": 1}, {"k": 2}, {"m": "x"}]},
        {"a": "one", "b c": {"x": False}, "list": []},
        {"a": 1.5, "list": [{"k": 3}], "deep": {"deeper": {"OBJECT<z": [[1, 2], []]}}},
        {"a": {"now": {"nested": 1}}},
        {"a": {"now": "text"}, "b c": None},
        {},
        [1, 2],
        7,
    ]
    lines = [json.dumps(r) for r in records]
    (tmp_path / "r.json").write_text("\n".join([*lines, '{"a": ', "", "  ", "nonsense"]) + "\n")
    expected = Counter(pair for r in records for pair in seen(r))
    # items of mixed kinds at the top level are counted by their outermost type
    found = {(r.path, r.type): r.n_records for r in json_drift(spark, str(tmp_path)).collect()}
    assert found.pop(("$", "BROKEN")) == 2
    inside = {pair: n for pair, n in expected.items() if not pair[0].startswith("$[]")}
    assert {pair: n for pair, n in found.items() if not pair[0].startswith("$[]")} == inside
    (tmp_path / "r.json").write_text("\n")
    assert json_drift(spark, str(tmp_path)).collect() == []


# -- samples ---------------------------------------------------------------------------------------------


def test_samples_are_stable_and_merge(spark):
    data = spark.range(2000).select("id", (F.col("id") % 3).alias("g"))
    order = sorted(range(2000), key=lambda i: hashlib.md5(f"seed|{i}".encode()).hexdigest())
    for frame in (data, data.repartition(7).orderBy(F.rand(1))):
        assert {r.id for r in stable_sample(frame, 50, ["id"], seed="seed").collect()} == set(order[:50])
        by = Counter((r.g, r.id) for r in stable_sample(frame, 20, ["id"], by=["g"], seed="seed").collect())
        assert by == Counter((g, i) for g in range(3) for i in [i for i in order if i % 3 == g][:20])
    parts = [stable_sample(data.where(f"id % 4 = {i}"), 50, ["id"], seed="seed") for i in range(4)]
    union = parts[0].union(parts[1]).union(parts[2]).union(parts[3])
    assert {r.id for r in stable_sample(union, 50, ["id"], seed="seed").collect()} == set(order[:50])
    assert stable_sample(data.limit(0), 5, ["id"], by=["g"]).collect() == []
    plan = stable_sample(data, 5, ["id"], by=["g"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
