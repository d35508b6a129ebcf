"""Tables kept in the shared folder."""

import os

import pytest

from quern.operators import durable as place


def test_settled_deletes_what_was_kept_on_the_way(spark):
    held = place.durable(spark.range(3))
    before, made = set(place._kept), []

    def make():
        made.append(place.durable(spark.range(5)))
        return made[0].where("id > 1")

    done = place.settled(make)
    assert sorted(r["id"] for r in done.collect()) == [2, 3, 4]
    assert place._kept - before == {getattr(done, place._PLACE)}
    assert not os.path.exists(getattr(made[0], place._PLACE).removeprefix("file://"))
    assert held.count() == 3
    place.release(held, done)
    assert not os.path.exists(getattr(held, place._PLACE).removeprefix("file://"))


def test_a_cluster_without_a_shared_folder_is_refused(monkeypatch):
    class Conf:
        def get(self, key, default):
            return default

    class Nowhere:
        conf = Conf()

        class sparkContext:
            master = "spark://host:7077"

            class _jsc:
                @staticmethod
                def sc():
                    return Nowhere

        @staticmethod
        def getCheckpointDir():
            return Nowhere

        @staticmethod
        def isDefined():
            return False

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        place._shared(Nowhere)
