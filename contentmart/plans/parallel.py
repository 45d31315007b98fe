"""Independent steps of a run at once.

Each step runs in a thread of its own with the caller's job properties.  The first step that fails
stops the others: their jobs carry a tag and are cancelled.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def at_once(spark: SparkSession, *steps: Callable[[], object]) -> list:
    """Results of ``steps`` in their order; the error of the first that fails, once all have ended."""
    context, tag = spark.sparkContext, f"contentmart-{uuid.uuid4().hex}"

    def run(step: Callable[[], object]):
        context.addJobTag(tag)
        return step()

    first: list[BaseException] = []
    with ThreadPoolExecutor(len(steps)) as threads:
        # The wrapper copies the caller's properties, so it is made here, once for each thread.
        made = [threads.submit(inheritable_thread_target(spark)(run), step) for step in steps]
        done, rest = wait(made, return_when=FIRST_EXCEPTION)
        first += [e for e in (f.exception() for f in made if f in done) if e is not None]
        while rest:
            if first:
                context.cancelJobsWithTag(tag)
            _, rest = wait(rest, timeout=0.2 if first else None)
    if first:
        raise first[0]
    return [f.result() for f in made]
