import os
import shutil

import pytest
from pyspark.sql import functions as F

from usagelens.schemas import DECODED
from usagelens.sources import store
from usagelens.streaming import incremental

DAY = "2026-01-01"


class Stop(Exception):
    pass


class Breaking:
    """A file system that stops before or after its n-th change."""

    def __init__(self, fs, state):
        self.fs, self.state = fs, state

    def __getattr__(self, name):
        call = getattr(self.fs, name)
        if name not in ("delete", "rename", "create"):
            return call

        def change(*args):
            self.state["left"] -= 1
            if self.state["left"] == 0 and self.state["before"]:
                raise Stop
            out = call(*args)
            if self.state["left"] == 0:
                raise Stop
            return out

        return change


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("store"))
    wide = spark.createDataFrame([(None,) * len(DECODED.fields)], DECODED).withColumn("kind", F.lit("user_prompt"))
    for i in range(3):
        rows = wide.withColumn("event_id", F.lit(f"e{i}")).withColumn("timestamp", F.lit(f"{DAY} 01:00:00").cast("timestamp_ntz"))
        store.write_facts(rows, root, f"load{i}")
    return root


def events(spark, root):
    return sorted(r.event_id for r in store.read_facts(spark, root, "user_prompts").collect())


@pytest.mark.parametrize("before", [True, False])
def test_a_stop_at_any_change_loses_and_doubles_nothing(spark, loaded, tmp_path, monkeypatch, before):
    real = store._folder
    stops = 0
    for n in range(1, 40):
        root = f"{tmp_path}/{n}"
        shutil.copytree(loaded, root)
        state = {"left": n, "before": before}

        def breaking(spark, path):
            fs, p = real(spark, path)
            return Breaking(fs, state), p

        monkeypatch.setattr(store, "_folder", breaking)
        try:
            store.compact(spark, root, "user_prompts", DAY)
            stopped = False
        except Stop:
            stopped = True
        monkeypatch.setattr(store, "_folder", real)
        assert events(spark, root) == ["e0", "e1", "e2"], (n, before)
        counts = {r.fact_table: r.rows for r in store.stored_counts(spark, root).collect()}
        assert counts == {"user_prompts": 3} and store.stored_days(spark, root, "user_prompts") == [DAY]
        assert store.compact(spark, root, "user_prompts", DAY) in (1, 3)
        assert events(spark, root) == ["e0", "e1", "e2"]
        folders = [f for f in os.listdir(f"{root}/facts/table=user_prompts/event_date={DAY}") if f.startswith("load_id=")]
        assert len(folders) == 1
        if not stopped:
            break
        stops += 1
    assert not stopped and stops >= 6


def test_settling_twice_and_elsewhere_is_harmless(spark, loaded, tmp_path):
    root = f"{tmp_path}/s"
    shutil.copytree(loaded, root)
    assert store.settle(spark, root) == 0
    assert store.compact(spark, root, "user_prompts", DAY) == 3 and store.settle(spark, root) == 0
    assert store.compact(spark, root, "user_prompts", "2026-02-01") == 0
    assert events(spark, root) == ["e0", "e1", "e2"]


def test_an_unfinished_owner_note_does_not_lock_a_stream_out(spark, tmp_path):
    root = f"{tmp_path}/r"
    os.makedirs(f"{incremental.stream_folder(root, 'telemetry')}/source")
    incremental._own(spark, root, "telemetry", "/a")
    incremental._own(spark, root, "telemetry", "/a/")
    with pytest.raises(ValueError):
        incremental._own(spark, root, "telemetry", "/b")
