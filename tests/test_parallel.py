"""Independent steps at once: both run, both have the caller's properties, an error stops the other."""

import threading
import time

import pytest

from contentmart.plans.parallel import at_once


def test_steps_overlap_and_keep_the_callers_properties(spark):
    both = threading.Barrier(2, timeout=60)  # breaks unless both steps are under way
    context = spark.sparkContext
    context.setLocalProperty("contentmart.test", "inherited")

    def step(n):
        def run():
            both.wait()
            assert spark.range(n).count() == n
            both.wait()
            return n, context.getLocalProperty("contentmart.test")

        return run

    assert at_once(spark, step(10), step(20)) == [(10, "inherited"), (20, "inherited")]


def test_an_error_in_one_stops_the_other(spark):
    started = threading.Event()

    def slow():
        def sleep(parts):
            time.sleep(120)
            yield from parts

        started.set()
        return spark.range(2).repartition(2).mapInPandas(sleep, "id long").count()

    def fail():
        started.wait(60)
        time.sleep(2)
        raise KeyError("lost")

    begin = time.time()
    with pytest.raises(KeyError, match="lost"):
        at_once(spark, slow, fail)
    assert time.time() - begin < 60
