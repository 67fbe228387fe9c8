"""The lake's commit log: several writers, crashes, files that a merge rewrites, checkpoints, sweeps."""

import threading
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from branchlake.defs import TableDef
from branchlake.functions.keys import with_merge_hash
from branchlake.plans import load
from branchlake.sources.lake import CommitConflict, Lake, expire_to_latest
from branchlake.sources.scratch import fresh

NOW = datetime(2026, 7, 19, 1, 2, 3)


def _t(spark, rows):
    return spark.createDataFrame(rows, "id bigint, name string, branch_id bigint")


def _rows(lake, table="t"):
    return sorted(map(tuple, lake.read(table).select("id", "name", "branch_id").collect()), key=repr)


def _hashed(spark, ids, name="a", branches=2):
    return with_merge_hash(_t(spark, [(i, name, i % branches) for i in ids]), ["id", "branch_id"])


def test_three_tables_recorded_at_the_same_time(spark):
    lake = Lake(spark, fresh(spark, "lake"))
    src = lambda n: {b: spark.createDataFrame([(n * 10 + b, b + n)], "ID bigint, CDC bigint") for b in (1, 2)}
    tdefs = [TableDef(f"T{n}", ("ID",), "transactions", cdc_column="CDC") for n in range(3)]
    with ThreadPoolExecutor(3) as pool:
        done = list(pool.map(lambda n: load.run_table(lake, tdefs[n], src(n), "INITIAL", NOW, 2, "r1"), range(3)))
    assert [(d.status, d.rows, d.error) for d in done] == [("SUCCESS", 2, None)] * 3
    assert {(r["table_name"], r["branch_id"]): r["last_cdc_value"] for r in lake.read("etl_control").collect()} == {(f"t{n}", b): str(b + n) for n in range(3) for b in (1, 2)}
    assert lake.read("etl_run_log").count() == 6
    assert lake.snapshots("etl_control").count() <= 2 and lake.snapshots("etl_run_log").count() <= 2  # one run's commits are squashed


def test_a_recording_that_fails_is_a_failed_load(spark, monkeypatch):
    lake, tdef = Lake(spark, fresh(spark, "lake")), TableDef("T", ("ID",), "transactions", cdc_column="CDC")
    src = {1: spark.createDataFrame([(1, 1)], "ID bigint, CDC bigint")}
    with monkeypatch.context() as m:
        m.setattr(load, "log_rows", lambda _: 1 / 0)
        done = load.run_table(lake, tdef, src, "INITIAL", NOW, 1, "r1")
    assert done.status == "FAILED" and "not recorded" in done.error and lake.read("t").count() == 1
    again = load.run_table(lake, tdef, src, "INCREMENTAL", NOW, 1, "r2")
    assert again.status == "SUCCESS" and lake.read("t").count() == 1


@pytest.mark.parametrize("other", [1, 2])
def test_a_merge_that_is_overtaken(spark, monkeypatch, other):
    """Another merge comes in between reading and committing: of another branch, or of the same one, whose rows must not be lost either."""
    lake = Lake(spark, fresh(spark, "lake"))
    lake.replace("t", _t(spark, [(1, "a", 1), (2, "a", 2)]), "r1", NOW)
    put, overtaken = Lake._put, []

    def late(self, path, text):
        if not overtaken and path.endswith("2.json"):
            overtaken.append(path)
            Lake(spark, lake.root).merge("t", _t(spark, [(7, "other", other)]), ["id", "branch_id"], "r2", NOW)
        return put(self, path, text)

    monkeypatch.setattr(Lake, "_put", late)
    assert lake.merge("t", _t(spark, [(1, "mine", 1), (8, "mine", 1)]), ["id", "branch_id"], "r3", NOW) == 3
    assert _rows(lake) == sorted([(1, "mine", 1), (2, "a", 2), (7, "other", other), (8, "mine", 1)], key=repr)
    total = lake.snapshots("t").first()
    assert (total["added_records"], total["total_records"]) == (2, 4)
    assert lake.sweep("t", dry_run=True, older_than=timedelta(0)).files == 0  # what the attempt that was overtaken had written is gone


def test_many_writers(spark):
    """Eight threads, two branches, appends and merges: every commit has a number of its own and nothing is lost."""
    lake = Lake(spark, fresh(spark, "lake"), checkpoint_every=3)
    lake.replace("t", _t(spark, [(0, "seed", 0)]), "r0", NOW)

    def one(n):
        own = Lake(spark, lake.root, checkpoint_every=3)
        return (own.append if n % 2 else lambda *a: own.merge(a[0], a[1], ["id", "branch_id"], *a[2:]))("t", _t(spark, [(n, f"w{n}", n % 2)]), f"r{n}", NOW)

    with ThreadPoolExecutor(8) as pool:
        numbers = list(pool.map(one, range(1, 9)))
    assert sorted(numbers) == list(range(2, 10))
    assert _rows(lake) == sorted([(0, "seed", 0), *((n, f"w{n}", n % 2) for n in range(1, 9))], key=repr)
    assert lake.snapshots("t").count() == 9 and lake._pointer("t")["n"] > 0
    for v in range(1, 10):  # every snapshot can still be read
        assert lake.read("t", v).count() == v


def test_a_commit_during_a_checkpoint(spark, monkeypatch):
    """One that comes after the checkpoint's number stays an entry after it."""
    lake, other = Lake(spark, fresh(spark, "lake")), []
    lake.append("t", _t(spark, [(1, "a", 0)]), "r1", NOW)
    for method in ("actions", "_state", "_switch"):
        real = getattr(Lake, method)

        def late(self, *args, real=real):
            if self is lake and len(other) < 2 and not any(m == real for m in other):
                other.append(real)
                Lake(spark, lake.root).append("t", _t(spark, [(len(other) + 10, "late", 0)]), "r2", NOW)
            return real(self, *args)

        with monkeypatch.context() as m:
            m.setattr(Lake, method, late)
            lake._gather("t", None)
        other.clear()
    assert lake.snapshots("t").count() == 4 and lake.read("t").count() == 4


def test_a_writer_that_never_gets_through(spark, monkeypatch):
    lake = Lake(spark, fresh(spark, "lake"), tries=2)
    lake.replace("t", _t(spark, [(1, "a", 1)]), "r1", NOW)
    monkeypatch.setattr(Lake, "_put", lambda *_: False)
    seen = iter(range(100))
    monkeypatch.setattr("branchlake.sources.lake._seen", lambda *_: next(seen))
    with pytest.raises(CommitConflict):
        lake.merge("t", _t(spark, [(1, "b", 1)]), ["id", "branch_id"])


def test_only_one_of_two_puts(spark):
    lake, won = Lake(spark, fresh(spark, "lake")), []
    go = threading.Barrier(6)

    def one(n):
        go.wait()
        if lake._put(f"{lake.root}/t/_log/{5:020d}.json", str(n)):
            won.append(n)

    lake._fs(f"{lake.root}/t/_log")[0].mkdirs(lake._fs(f"{lake.root}/t/_log")[1])
    threads = [threading.Thread(target=one, args=(n,)) for n in range(6)]
    [t.start() for t in threads], [t.join() for t in threads]
    assert len(won) == 1 and lake._text(f"{lake.root}/t/_log/{5:020d}.json") == str(won[0])
    assert lake._names(f"{lake.root}/t/_log") == [f"{5:020d}.json"]


def test_a_merge_rewrites_matched_files_only(spark):
    lake = Lake(spark, fresh(spark, "lake"), file_rows=100)
    lake.replace("t", _hashed(spark, range(4000)), "r1", NOW)
    before = {r["path"]: r for r in lake.files("t").collect()}
    assert len(before) >= 40 and all(r["low"] <= r["high"] for r in before.values()) and sum(r["records"] for r in before.values()) == 4000
    for b in (0, 1):  # ranges of a branch's files don't overlap
        ranges = sorted((r["low"], r["high"]) for r in before.values() if r["branch_id"] == b)
        assert all(x[1] < y[0] for x, y in zip(ranges, ranges[1:], strict=False))
    delta = _hashed(spark, [4, 5, 8, 9000], "b")
    told = lake.impact("t", delta, ["id", "branch_id"]).first()
    lake.merge("t", delta, ["id", "branch_id"], "r2", NOW)
    after = {r["path"]: r for r in lake.files("t").collect()}
    gone = before.keys() - after.keys()
    assert 1 <= len(gone) <= 3 and (told["files_rewritten"], told["bytes_rewritten"]) == (len(gone), sum(before[p]["bytes"] for p in gone))
    assert (told["matched"], told["changed"], told["inserts"], told["files"]) == (3, 3, 1, len(before))
    assert lake.read("t").count() == 4001 and sorted(r["id"] for r in lake.read("t").where("name = 'b'").collect()) == [4, 5, 8, 9000]
    assert lake.read("t", 1).where("name = 'b'").count() == 0


def test_ranges_are_pruned_before_keys_are_read(spark, monkeypatch):
    lake = Lake(spark, fresh(spark, "lake"), file_rows=100)
    lake.replace("t", _hashed(spark, range(2000)), "r1", NOW)
    frame, opened = Lake._frame, []

    def counted(self, table, state, chosen, located=False):
        opened.append(len(chosen)) if located else None
        return frame(self, table, state, chosen, located)

    monkeypatch.setattr(Lake, "_frame", counted)
    lake.merge("t", _hashed(spark, [7], "b"), ["id", "branch_id"], "r2", NOW)
    assert opened == [1]


def test_many_small_files_stay_out_of_the_driver(spark, monkeypatch):
    """An entry crosses to Python and back in slices and tells its schema once; new files are looked through by branches; impact opens files in range alone, a read takes whole folders."""
    monkeypatch.setattr("branchlake.sources.files.SLICE", 100)
    monkeypatch.setattr("branchlake.sources.lake.LISTED", 10)
    lake = Lake(spark, fresh(spark, "lake"), file_rows=20)
    frame, listed, opened, read = Lake._frame, Lake._read_paths, [], []

    def framed(self, table, state, chosen, located=False):
        opened.append(len(chosen)) if located else None
        return frame(self, table, state, chosen, located)

    def paths(self, table, some, *args):
        read.append(some)
        return listed(self, table, some, *args)

    monkeypatch.setattr(Lake, "_frame", framed)
    monkeypatch.setattr(Lake, "_read_paths", paths)
    lake.replace("t", _hashed(spark, range(800), branches=3), "r1", NOW)
    assert [len(p) for p in read] == [1, 1, 1]
    entry = (lake._text(f"{lake.root}/t/_log/{1:020d}.json")).splitlines()
    assert len(entry) > 40 and sum('"schema"' in line for line in entry) == 1
    files, delta = lake.files("t").collect(), _hashed(spark, [6], "b", 3)
    assert sum(r["records"] for r in files) == 800
    told = lake.impact("t", delta, ["id", "branch_id"]).first()
    none = lake.impact("t", delta.where("false"), ["id", "branch_id"]).first()
    assert opened == [3, 0]  # one file a branch covers the hash
    assert (told["files"], told["bytes"]) == (none["files"], none["bytes"]) == (len(files), sum(r["bytes"] for r in files))
    assert (told["matched"], told["changed"], told["inserts"], told["files_rewritten"]) == (1, 1, 0, 1) and (none["matched"], none["files_rewritten"], none["bytes_rewritten"]) == (0, 0, 0)
    read.clear()
    assert lake.read("t").count() == 800 and len(read[0]) == 3
    lake.merge("t", delta, ["id", "branch_id"], "r2", NOW)
    read.clear()
    rows = {r["id"]: r["name"] for r in lake.read("t").collect()}
    assert rows == {i: "b" if i == 6 else "a" for i in range(800)}
    # two folders and the merge's, and of branch 0 the files that are left
    assert len(read[0]) == 3 + sum(r["branch_id"] == 0 for r in files) - 1
    assert lake.read("t", 1).where("name = 'b'").count() == 0


def test_null_branches_match(spark):
    lake = Lake(spark, fresh(spark, "lake"))
    lake.replace("t", _t(spark, [(1, "a", None), (2, "a", 1)]), "r1", NOW)
    lake.merge("t", _t(spark, [(1, "b", None), (None, "n", 1)]), ["id", "branch_id"], "r2", NOW)
    lake.merge("t", _t(spark, [(None, "m", 1)]), ["id", "branch_id"], "r3", NOW)
    assert _rows(lake) == sorted([(1, "b", None), (2, "a", 1), (None, "m", 1)], key=repr)


def test_odd_columns_are_stored(spark):
    lake = Lake(spark, fresh(spark, "lake"))
    df = spark.sql("SELECT named_struct('a-b', 1, 'c d', array(2)) AS s, map('k', 1) AS m, NULL AS v, 1L AS branch_id")
    lake.replace("t", df, "r1", NOW)
    lake.append("t", df, "r2", NOW)
    assert lake.read("t").where("s.`a-b` = 1 AND m['k'] = 1 AND v IS NULL").count() == 2


STEPS = ["_checkpoint", "_switch", "_tidy"]


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("after", [False, True])
def test_a_crash_at_any_step_of_expiring_loses_nothing(spark, monkeypatch, step, after):
    lake = Lake(spark, fresh(spark, "lake"))
    for n in range(4):
        lake.merge("t", _t(spark, [(n, "a", n % 2)]), ["id", "branch_id"], f"r{n}", NOW)
    want, real = _rows(lake), getattr(Lake, step)

    def crash(self, *args):
        if after:
            real(self, *args)
        raise OSError("gone")

    with monkeypatch.context() as m:
        m.setattr(Lake, step, crash)
        with pytest.raises(OSError):
            lake.keep_snapshots("t", expire_to_latest(lake.snapshots("t")))
    assert _rows(lake) == want
    switched = step == "_tidy" or step == "_switch" and after
    assert lake.snapshots("t").count() == (1 if switched else 4)
    lake.merge("t", _t(spark, [(9, "z", 1)]), ["id", "branch_id"], "r9", NOW)
    assert lake.keep_snapshots("t", expire_to_latest(lake.snapshots("t"))) == (1 if switched else 4)
    assert _rows(lake) == sorted([*want, (9, "z", 1)], key=repr) and all(lake.seen("t", f"r{n}") for n in (0, 1, 2, 3, 9)) and not lake.seen("t", "r5")
    lake.sweep("t", older_than=timedelta(0))
    assert _rows(lake) == sorted([*want, (9, "z", 1)], key=repr)


def test_expired_snapshots_and_a_writer_that_was_away(spark):
    """Whoever commits under a number that a checkpoint covers starts again."""
    lake = Lake(spark, fresh(spark, "lake"))
    for n in range(5):
        lake.append("t", _t(spark, [(n, "a", 0)]), f"r{n}", NOW)
    stale = lake._state("t", 2)
    for _ in range(2):
        lake.keep_snapshots("t", expire_to_latest(lake.snapshots("t")))
    assert lake._entries("t") == []  # two pointers later no entry is left
    real, first = Lake._state, [stale]
    lake._state = lambda table, snapshot=None: first.pop() if first else real(lake, table, snapshot)
    assert lake.append("t", _t(spark, [(9, "late", 0)]), "r9", NOW) == 6
    assert Lake(spark, lake.root).read("t").count() == 6


def test_time_travel_over_checkpoints(spark):
    lake = Lake(spark, fresh(spark, "lake"))
    for n in range(6):
        lake.merge("t", _t(spark, [(0, f"v{n}", 0), (n, "a", 1)]), ["id", "branch_id"], f"r{n}", NOW)
    kept = lake.snapshots("t").where("commit_id IN (2, 4)")
    assert lake.keep_snapshots("t", kept) == 3
    assert [r["commit_id"] for r in lake.snapshots("t").collect()] == [6, 4, 2]
    for v in (2, 4, 6):
        assert lake.read("t", v).where("branch_id = 0").first()["name"] == f"v{v - 1}" and lake.read("t", v).where("branch_id = 1").count() == v
    lake.sweep("t", older_than=timedelta(0))
    assert lake.read("t", 2).count() == 3 and lake.read("t").count() == 7
    with pytest.raises(ValueError, match="no snapshot"):
        lake.read("t", 3)


def test_sweep_spares_open_commits_and_tells_of_failures(spark, monkeypatch):
    lake = Lake(spark, fresh(spark, "lake"))
    lake.replace("t", _t(spark, [(1, "a", 1)]), "r1", NOW)
    adds, _ = lake._write("t", _t(spark, [(2, "open", 1), (3, "open", 2)]))  # written, not yet in the log
    assert lake.sweep("t") == (0, 0, [])
    real = Lake.delete
    monkeypatch.setattr(Lake, "delete", lambda self, path: (_ for _ in ()).throw(OSError("denied")) if "branch_id=1" in path else real(self, path))
    swept = lake.sweep("t", older_than=timedelta(0))
    assert swept.files == 1 and swept.bytes > 0 and [(p, e) for p, e in swept.failed] == [(next(f["path"] for f in adds if f["branch_id"] == 1), "denied")]
    assert _rows(lake) == [(1, "a", 1)]


def test_staged_rows_are_deleted_after_the_load(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(load, "fresh", lambda _, name: f"file://{tmp_path}/{name}")
    lake, tdef = Lake(spark, f"file://{tmp_path}/lake"), TableDef("T", ("ID",), "transactions", cdc_column="CDC")
    done = load.run_table(lake, tdef, {1: spark.createDataFrame([(1, 4)], "ID bigint, CDC bigint")}, "INITIAL", NOW, 1, "r1")
    bad = load.run_table(lake, tdef, {1: spark.createDataFrame([(2, 9), (2, 9)], "ID bigint, CDC bigint")}, "INCREMENTAL", NOW, 1, "r2")
    assert (done.status, bad.status) == ("SUCCESS", "FAILED") and done.marks.first()["cdc_value"] == "4"
    assert sorted(p.name for p in tmp_path.iterdir()) == ["lake"]
    assert not any((tmp_path / "lake" / t / "_staged").exists() and list((tmp_path / "lake" / t / "_staged").iterdir()) for t in lake.tables())


def test_a_run_s_own_snapshots_are_squashed(spark):
    """Of a run's commits the last stays, of older runs what is young enough."""
    lake = Lake(spark, fresh(spark, "lake"))
    for day, run in ((1, "a"), (15, "b"), (18, "c"), (19, "d"), (19, "d"), (19, "d")):
        lake.append("t", _t(spark, [(1, "x", 1)]), run, datetime(2026, 7, day))
    assert load.expire(lake, "t", "d", datetime(2026, 7, 19), load.Retention(days=3, min_keep=1)) == 4
    assert [(r["commit_id"], r["run_id"]) for r in lake.snapshots("t").collect()] == [(6, "d"), (3, "c")]
    assert lake.read("t").count() == 6 and load.expire(lake, "t", "d", datetime(2026, 7, 19), load.Retention(days=3)) == 0


def test_changed_files_of_two_branches(spark):
    """A diff after a merge into two branches reads files of those two."""
    lake = Lake(spark, fresh(spark, "lake"))
    lake.replace("t", _t(spark, [(i, "a", i % 5) for i in range(50)]), "r1", NOW)
    lake.merge("t", _t(spark, [(1, "b", 1), (52, "n", 2)]), ["id", "branch_id"], "r2", NOW)
    old, new = lake.changed_files("t", 1)
    assert {r["branch_id"] for r in old.union(new).select("branch_id").distinct().collect()} == {1, 2}
    scans = old.withColumn("f", F.input_file_name()).select("f").distinct().count()
    assert scans == 1  # branch 2 gained a row in a file of its own
