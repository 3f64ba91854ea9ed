from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from storefront_analytics.plans.summaries import HISTORY_SCHEMA, append_summaries
from storefront_analytics.sources import pointers as P
from storefront_analytics.sources.history_versions import HistoryVersions, VersionTaken
from storefront_analytics.sources.scratch import store
from tests.conftest import rows
from tests.test_governance import DECISIONS, history_row

AT = datetime(2024, 6, 1)


@pytest.fixture
def versions(spark, tmp_path):
    found = HistoryVersions(spark, f"file://{tmp_path}/history")
    assert found.current() is None and found.read().count() == 0
    data = [history_row("s1"), history_row("s2"), history_row("s3", "APPROVED", datetime(2024, 3, 1))]
    found.publish(spark.createDataFrame(data, HISTORY_SCHEMA), 0)
    return found


def _decisions(spark):
    def row(n, sid, decision, seen="PENDING_REVIEW"):
        return (n, sid, decision, " Ann ", "ok", True, seen, None, datetime(2024, 5, 1, 0, n))

    return spark.createDataFrame(
        [row(1, "s1", "APPROVED"), row(2, "s2", "REJECTED"), row(3, "s3", "APPROVED"), row(4, "s1", "REJECTED")],
        DECISIONS,
    )


def test_a_batch_gives_a_new_version(spark, versions):
    old = versions.read()
    number, conflicts = versions.review(_decisions(spark), AT)
    assert (number, conflicts) == (2, 2)
    status = {r["summary_id"]: r["review_status"] for r in rows(versions.read())}
    assert status == {"s1": "APPROVED", "s2": "REJECTED", "s3": "APPROVED"}
    assert {r["review_status"] for r in rows(old.filter("summary_id <> 's3'"))} == {"PENDING_REVIEW"}  # still there
    # The same batch again: nobody's view is current any more.
    assert versions.review(_decisions(spark), AT) == (3, 4)


def test_a_failure_leaves_the_old_version(spark, versions):
    broken = versions.read().withColumn("review_status", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        versions.publish(broken, 1)
    assert versions.current()[0] == 1 and versions.read().count() == 3


def test_the_second_writer_fails(versions):
    history = versions.read()
    assert versions.publish(history, 1) == 2
    with pytest.raises(VersionTaken):
        versions.publish(history, 1)
    assert versions.current()[0] == 2


def _folder(tmp_path, name):
    return tmp_path / "history" / name


def test_an_empty_or_torn_pointer_is_passed_over(versions, tmp_path):
    (_folder(tmp_path, "pointers") / "2").touch()
    (_folder(tmp_path, "pointers") / "3").write_text("versions/3-abc")  # its end is missing
    assert versions.current()[0] == 1 and versions.read().count() == 3
    assert versions.publish(versions.read().limit(1), 1) == 4
    assert versions.current()[0] == 4 and versions.read().count() == 1


@pytest.mark.parametrize("step", ["create", "name"])
def test_a_crash_while_pointing_leaves_the_old_version(versions, monkeypatch, step):
    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        if step == "name":
            patch.setattr(P.Pointers, "_name", lost)
        else:
            patch.setattr(P, "bytearray", lost, raising=False)  # the file was made, nothing is in it
        with pytest.raises(RuntimeError, match="lost"):
            versions.publish(versions.read(), 1)
    assert versions.current()[0] == 1
    assert versions.publish(versions.read(), 1) == 2


def test_a_stale_view_is_refused(versions):
    assert versions.publish(versions.read(), 1) == 2
    with pytest.raises(VersionTaken):
        versions.publish(versions.read(), 1)  # 3 would be free


def test_one_of_many_gets_a_number(spark, tmp_path):
    pointers = P.Pointers(spark, f"file://{tmp_path}/p")
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda i: pointers.claim(1, [f"w{i}"]), range(16)))
    assert sum(got) == 1 and pointers.found() == {1: [f"w{got.index(True)}"]}
    assert [p.name for p in (tmp_path / "p" / "_aside").iterdir()] == []


def test_rename_without_replacement(spark, tmp_path, monkeypatch):
    # The step taken on hdfs, here on the local file system.
    monkeypatch.setattr(P.Pointers, "_name", lambda self, a, b: _renamed(self, a, b))
    pointers = P.Pointers(spark, f"file://{tmp_path}/p")
    assert pointers.claim(1, ["a"]) and not pointers.claim(1, ["b"])
    assert pointers.found() == {1: ["a"]}


def _renamed(pointers, aside, place):
    try:
        pointers._rename_new(aside, place)
    except Exception:
        return False
    return True


def test_stores_without_exclusive_names_are_refused(spark, tmp_path):
    pointers = P.Pointers(spark, f"file://{tmp_path}/p")

    class Elsewhere:
        def __getattr__(self, name):
            return getattr(pointers._jvm.org.apache.hadoop.fs.FileSystem.getLocal(pointers._conf), name)

        def getUri(self):
            return pointers._jvm.java.net.URI("s3a://bucket")

    pointers._files = Elsewhere()
    with pytest.raises(P.NoExclusiveName, match="s3a"):
        pointers.claim(1, ["a"])


@pytest.fixture
def candidates(spark):
    rows = [history_row("s1"), history_row("s2", n=1)]
    frame = spark.createDataFrame(rows, HISTORY_SCHEMA).withColumn("input_hash", F.col("summary_id"))
    return store(frame, "candidates")


def test_appends_side_by_side_leave_one_summary(spark, candidates, tmp_path):
    path = f"file://{tmp_path}/history"
    with ThreadPoolExecutor(3) as pool:
        added = list(pool.map(lambda _: append_summaries(candidates, path), range(3)))
    assert sorted(added) == [0, 0, 2]
    assert sorted(r["summary_id"] for r in spark.read.parquet(path).collect()) == ["s1", "s2"]


def test_an_append_from_a_stale_view_is_given_up(spark, candidates, tmp_path):
    path = f"file://{tmp_path}/history"
    log = P.AppendLog(spark, path)
    seen = log.settled()
    assert append_summaries(candidates, path) == 2
    assert not log.append(candidates.frame, seen)
    assert spark.read.parquet(path).count() == 2 and append_summaries(candidates, path) == 0


def test_an_append_that_was_lost_before_its_files_moved(spark, candidates, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/history"
    with monkeypatch.context() as patch:
        patch.setattr(P.AppendLog, "_move", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            append_summaries(candidates, path)
    assert append_summaries(candidates, path) == 0  # moved them, and found them
    assert spark.read.parquet(path).count() == 2
