import threading

import pytest

from lodestep.session import path_exists
from lodestep.sources.schemas import MAIN_TABLES
from lodestep.sources.snapshots import Snapshots


@pytest.fixture
def shared(spark):
    """Snapshots of a source that changes, under a clock the test moves."""
    state = {"now": 1000.0, "rows": 3, "taken": 0}

    def source():
        state["taken"] += 1
        if state["rows"] is None:
            raise ValueError("source is away")
        return spark.range(state["rows"])

    out = Snapshots(spark, {name: source for name in MAIN_TABLES}, seconds=600, clock=lambda: state["now"])
    yield out, state
    out.close()
    assert out.held() == []


def rows(shared, name="users"):
    with shared.version(name) as v:
        return v.number, v.frame.count()


def test_a_changed_source_is_seen_after_expiry(spark, shared):
    snapshots, state = shared
    assert rows(snapshots) == (1, 3)
    state["rows"], state["now"] = 5, 1599.0
    assert rows(snapshots) == (1, 3) and state["taken"] == 1
    [(old, _, _)] = snapshots.held()
    state["now"] = 1600.0
    assert rows(snapshots) == (2, 5) and state["taken"] == 2
    assert not path_exists(spark, old) and len(snapshots.held()) == 1
    snapshots.expire("users")
    assert rows(snapshots) == (3, 5)


def test_a_version_stays_while_it_is_read(spark, shared):
    snapshots, state = shared
    with snapshots.version("users") as old:
        state["rows"], state["now"] = 4, 5000.0
        assert rows(snapshots) == (2, 4)
        assert old.frame.count() == 3 and sorted(n for _, n, _ in snapshots.held()) == [1, 2]
    assert [n for _, n, _ in snapshots.held()] == [2] and not path_exists(spark, old.path)


def test_a_source_that_fails_leaves_the_version(shared):
    snapshots, state = shared
    rows(snapshots)
    state["rows"], state["now"] = None, 5000.0
    with pytest.raises(ValueError):
        rows(snapshots)
    state["rows"] = 2
    assert rows(snapshots) == (2, 2) and [r for _, _, r in snapshots.held()] == [0]


def test_tables_are_taken_on_first_use_and_renewed_apart(shared):
    snapshots, state = shared
    with snapshots.tables() as t:
        assert t.users.count() == 3 and state["taken"] == 1
        state["now"] = 1300.0
        assert t.events.count() == 3 and t.users.count() == 3 and state["taken"] == 2
    state["rows"], state["now"] = 7, 1700.0
    assert rows(snapshots) == (2, 7) and rows(snapshots, MAIN_TABLES[1]) == (1, 3)


def test_sessions_on_threads_share_one_version(shared):
    snapshots, state = shared
    found = []
    threads = [threading.Thread(target=lambda: found.append(rows(snapshots))) for _ in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert found == [(1, 3)] * 6 and state["taken"] == 1


def test_an_empty_source(spark):
    snapshots = Snapshots(spark, {"users": lambda: spark.range(0)})
    assert rows(snapshots) == (1, 0)
    snapshots.close()
