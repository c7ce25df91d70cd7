"""The version log under many writers, its snapshots, and what it refuses to read."""

import hashlib
import threading

import pytest

from ebbtide.operators import runs, versions


def test_writers_at_once_never_share_a_version(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(versions, "FOLD", 4)
    path, got, errors = str(tmp_path / "log"), [], []

    def write(name):
        try:
            for i in range(5):
                got.append(versions.register_and_promote(spark, path, "m", f"{name}-{i}"))
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    writers = [threading.Thread(target=write, args=(f"w{k}",)) for k in range(3)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert not errors and sorted(got) == list(range(1, 16))
    names = [p.name for p in (tmp_path / "log").iterdir() if not p.name.startswith(".")]
    assert sum(n.startswith("snapshot") for n in names) >= 2 and len([n for n in names if n[0].isdigit()]) == 15
    now = runs.current_versions(versions.read_events(spark, path)).collect()
    assert sorted((r.version, r.stage) for r in now) == [(v, "archived") for v in range(1, 15)] + [(15, "production")]
    assert len({r.run_id for r in now}) == 15


def test_a_snapshot_says_what_the_commits_say(spark, tmp_path, monkeypatch):
    stages = [("a", 1, ("registered",)), ("a", 1, ("staging", "production")), ("a", 2, versions.STAGES), ("b", 1, versions.STAGES),
              ("a", 2, ("archived",)), ("b", 2, ("registered", "staging")), ("a", 3, ("registered",))]
    seen = []
    for fold in (100, 3, 1):
        monkeypatch.setattr(versions, "FOLD", fold)
        path = str(tmp_path / str(fold))
        for model, version, names in stages:
            assert versions.append_events(spark, path, model, version, names, f"{model}{version}") == version
        seen.append(sorted((r.model, r.version, r.stage, r.run_id) for r in runs.current_versions(versions.read_events(spark, path)).collect()))
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) == 5


def test_a_taken_number_is_refused_and_gaps_are_errors(spark, tmp_path):
    folder = versions.Folder(spark, str(tmp_path / "log"))
    assert folder.create("00000000000000000001.json", "") and not folder.create("00000000000000000001.json", "x")
    assert versions.read_events(spark, str(tmp_path / "log")).count() == 0
    assert folder.create("00000000000000000003.json", "")
    with pytest.raises(ValueError, match="without its commit 2"):
        versions.read_events(spark, str(tmp_path / "log"))
    with pytest.raises(ValueError):
        versions.append_events(spark, str(tmp_path / "other"), "m", 1, ())


def test_files_are_hashed_in_chunks(spark, tmp_path):
    contents = {"a": b"x" * 100_000, "c": b"y" * 7, "d": bytes(range(256)) * 300}
    for name, data in contents.items():
        (tmp_path / name).write_bytes(data)
    want = {name: hashlib.sha256(data).hexdigest()[:16] for name, data in contents.items()}
    for whole in (1 << 20, 50, 0):
        got = runs.file_checksums(spark, str(tmp_path), whole, 64).collect()
        assert {r.path.rsplit("/", 1)[1]: r.checksum for r in got} == want and sum(r.length for r in got) == sum(map(len, contents.values()))
