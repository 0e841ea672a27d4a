"""Each scope removes its own stored steps."""

import threading
from pathlib import Path
from urllib.parse import urlparse

from clickloom.functions import storage


def place(df):
    return Path(urlparse(df.inputFiles()[0]).path).parent


def test_nested_scopes(spark):
    with storage.scope(spark):
        outer = place(storage.materialise(spark.range(3)))
        with storage.scope(spark):
            inner = place(storage.materialise(spark.range(3)))
        assert outer.exists() and not inner.exists()
    assert not outer.exists()


def test_scopes_open_in_two_threads(spark):
    stored, may_end, seen = threading.Event(), threading.Event(), {}

    def other():
        with storage.scope(spark):
            seen["path"] = place(storage.materialise(spark.range(3)))
            stored.set()
            may_end.wait(60)

    thread = threading.Thread(target=other)
    with storage.scope(spark):
        thread.start()
        assert stored.wait(60)
        own = place(storage.materialise(spark.range(3)))
    assert seen["path"].exists() and not own.exists()
    may_end.set()
    thread.join()
    assert not seen["path"].exists()
