import os
from concurrent.futures import ThreadPoolExecutor

import pytest

from dimload.sources import LeaseHeld, LeaseLost, files, lease
from dimload.sources.lease import _path


@pytest.fixture
def path(spark):
    path = _path(spark, "some_table", "write")
    files.delete(spark, path)
    return path


def test_one_holder_at_a_time(spark, path):
    with lease(spark, "some_table") as held:
        held.check()
        with pytest.raises(LeaseHeld, match="some_table"):
            with lease(spark, "some_table"):
                pass
        with lease(spark, "other_table"), lease(spark, "some_table", "other purpose"):
            pass
    assert not files.exists(spark, path)
    with lease(spark, "default.some_table"):
        assert files.exists(spark, path)


def test_released_when_the_load_fails(spark, path):
    with pytest.raises(RuntimeError), lease(spark, "some_table"):
        raise RuntimeError
    assert not files.exists(spark, path)


def test_waiting(spark, path):
    done = []

    def work(k):
        with lease(spark, "some_table", wait=60):
            done.append(("in", k))
            done.append(("out", k))

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(work, range(8)))
    assert len(done) == 16 and all(done[i][1] == done[i + 1][1] for i in range(0, 16, 2))


def test_a_lease_left_behind_is_taken_over(spark, path):
    files.create_text(spark, path, "gone\nan application that died")
    with pytest.raises(LeaseHeld, match="an application that died"), lease(spark, "some_table"):
        pass
    local = path.removeprefix("file:")
    os.utime(local, (1, 1))
    with lease(spark, "some_table") as held:
        held.check()
        os.utime(local, (1, 1))  # and so may this one's be
        with lease(spark, "some_table") as other:
            other.check()
            with pytest.raises(LeaseLost):
                held.check()
        assert not files.exists(spark, path)


def test_of_many_at_once_one_creates(spark, path):
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda k: files.create_text(spark, path, str(k)), range(32)))
    assert sum(made) == 1 and files.read_text(spark, path) == str(made.index(True))
    files.delete(spark, path)
