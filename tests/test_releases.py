"""Targets that appear together, whatever cuts the writing off."""

import datetime as dt
import os

import pytest

from frames import rows
from kohorta.sources import releases, tables as io

DAY = dt.date(2025, 7, 14)


def targets(folder):
    return [("csv", f"{folder}/a"), ("parquet", f"{folder}/b"), ("parquet", f"{folder}/c")]


def held(spark, folder):
    """The values that each target holds; None where there is none."""
    out = []
    for kind, base in targets(folder):
        path = f"{base}_2025-07-14.{kind}"
        if not os.path.exists(path):
            out.append(None)
            continue
        df = io.read_csv(spark, path, "v string") if kind == "csv" else spark.read.parquet(path)
        out.append([r[0] for r in rows(df)])
    return out


def frame(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v string")


def write(spark, folder, *values):
    return io.write_all(frame(spark, *values), targets(folder), DAY)


def test_all_appear(spark, tmp_path):
    assert write(spark, tmp_path, "x", "y") == [f"{tmp_path}/{n}_2025-07-14.{k}" for n, k in (("a", "csv"), ("b", "parquet"), ("c", "parquet"))]
    assert held(spark, tmp_path) == [["x", "y"]] * 3
    write(spark, tmp_path, "z")
    assert held(spark, tmp_path) == [["z"]] * 3
    assert sorted(n for n in os.listdir(tmp_path) if n.startswith("_")) == []


@pytest.mark.parametrize("before", [(), ("old",)])
def test_a_write_cut_off_between_targets_changes_nothing(spark, tmp_path, monkeypatch, before):
    if before:
        write(spark, tmp_path, *before)
    put, calls = io._put, []

    def cut(df, kind, path):
        calls.append(path)
        if len(calls) == 2:
            raise RuntimeError("cut off")
        put(df, kind, path)

    monkeypatch.setattr(io, "_put", cut)
    with pytest.raises(RuntimeError):
        write(spark, tmp_path, "new")
    assert held(spark, tmp_path) == [[*before] if before else None] * 3
    assert not [n for n in os.listdir(tmp_path) if n.startswith("_staged")]


@pytest.mark.parametrize("done", [0, 1, 2])
def test_moves_cut_off_are_finished(spark, tmp_path, monkeypatch, done):
    write(spark, tmp_path, "old")
    move, moved = releases.Files.move, []

    def cut(self, source, target):
        if "_staged" in source:
            if len(moved) == done:
                raise KeyboardInterrupt
            moved.append(target)
        move(self, source, target)

    monkeypatch.setattr(releases.Files, "move", cut)
    with pytest.raises(KeyboardInterrupt):
        write(spark, tmp_path, "new")
    monkeypatch.setattr(releases.Files, "move", move)
    paths = [f"{b}_2025-07-14.{k}" for k, b in targets(tmp_path)]
    releases.Release(spark, paths).finish()
    assert held(spark, tmp_path) == [["new"]] * 3
    assert sorted(n for n in os.listdir(tmp_path) if n.startswith("_")) == []
