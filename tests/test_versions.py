"""Committed versions: one number for one writer, no mixed reads, nothing lost."""

import threading

import pytest

from tallyline.sources import paths, versions
from tallyline.sources.versions import Change


@pytest.fixture
def store(tmp_path):
    return str(tmp_path / "store")


def write(spark, store, name, text):
    folder = versions.new_data(store, name)
    paths.write_text(spark, paths.join(store, folder, "part"), text)
    return folder


def read(spark, version, name):
    return paths.read_text(spark, paths.join(version.path(name), "part"))


def put(spark, store, **texts):
    change = Change(put={n: write(spark, store, n, t) for n, t in texts.items()})
    return versions.commit(spark, store, lambda base: change)


def test_versions_keep_what_they_do_not_replace(spark, store):
    assert versions.current(spark, store) == versions.Version(store)
    first = put(spark, store, a="1", b="1")
    second = put(spark, store, b="2")
    assert (first.number, second.number) == (1, 2) and second.entries["a"] == first.entries["a"]
    assert [read(spark, second, n) for n in "ab"] == ["1", "2"] and read(spark, first, "b") == "1"
    third = versions.commit(spark, store, lambda base: Change(drop=frozenset("a"), info={"x": 1}))
    assert "a" not in third and third.info == {"x": 1} and "b" in third
    assert versions.commit(spark, store, lambda base: Change()) == third
    with pytest.raises(FileNotFoundError):
        third.path("a")


@pytest.mark.parametrize("move", [paths.publish_if_absent, paths.rename_if_absent])
def test_a_taken_name_stays(spark, tmp_path, move):
    one, two, target = (str(tmp_path / n) for n in ("one", "two", "target"))
    for p in (one, two):
        paths.write_text(spark, p, p)
    assert move(spark, one, target) and not move(spark, two, target)
    assert paths.read_text(spark, target) == one


def test_writers_at_once_all_get_in(spark, store):
    """Each adds one to a counter that it reads; none of the additions is lost."""
    put(spark, store, counter="0")
    failures = []

    def build(base):
        count = int(read(spark, base, "counter")) + 1
        return Change(put={"counter": write(spark, store, "counter", str(count))}, reads=frozenset({"counter"}))

    def work():
        try:
            for _ in range(4):
                versions.commit(spark, store, build, attempts=200)
        except Exception as error:
            failures.append(error)

    threads = [threading.Thread(target=work) for _ in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failures and read(spark, versions.current(spark, store), "counter") == "16"
    assert versions.numbers(spark, store) == list(range(1, 18))


def test_a_change_is_made_again_only_if_its_reads_were_replaced(spark, store):
    put(spark, store, a="1", b="1")
    calls = []

    def build(reads, rival):
        def made(base):
            calls.append(base.number)
            if len(calls) == 1:
                put(spark, store, **{rival: "rival"})
            return Change(put={"a": write(spark, store, "a", "mine")}, reads=frozenset(reads))

        return made

    version = versions.commit(spark, store, build({"a"}, "b"))
    assert calls == [1] and version.number == 3 and read(spark, version, "b") == "rival"
    calls.clear()
    versions.commit(spark, store, build({"a"}, "a"))
    assert calls == [3, 4]
    calls.clear()
    versions.commit(spark, store, build({"group/"}, "group/new"))
    assert len(calls) == 2
    with pytest.raises(versions.CommitConflict):
        versions.commit(spark, store, lambda base: (put(spark, store, a="x"), Change(info={"y": 1}))[1], attempts=1)


def test_a_writer_that_dies_leaves_no_trace_for_readers(spark, store, monkeypatch):
    first = put(spark, store, a="1", b="1")

    def dying(*_):
        raise OSError("killed")

    for name in ("write_text", "publish_if_absent"):
        folders = {n: write(spark, store, n, "2") for n in "ab"}
        with monkeypatch.context() as patch:
            patch.setattr(paths, name, dying)
            with pytest.raises(OSError):
                versions.commit(spark, store, lambda base: Change(put=folders))
        seen = versions.current(spark, store)
        assert seen == first and [read(spark, seen, n) for n in "ab"] == ["1", "1"]
    assert put(spark, store, a="3").number == 2


def test_expired_versions_lose_their_own_folders_only(spark, store):
    first = put(spark, store, a="1", b="1")
    orphan = write(spark, store, "orphan", "x")
    put(spark, store, a="2")
    third = put(spark, store, a="3")
    deleted = versions.expire(spark, store, keep=2)
    assert deleted == [first.entries["a"]] and versions.numbers(spark, store) == [2, 3]
    assert [read(spark, third, n) for n in "ab"] == ["3", "1"]
    assert versions.expire(spark, store, keep=2, orphan_seconds=-10) == [orphan]
    assert [read(spark, versions.current(spark, store), n) for n in "ab"] == ["3", "1"]
