"""Written tables and their clean-up."""

import os

from tallyspan import session


def test_written_tables_are_dropped(spark, monkeypatch):
    monkeypatch.setattr(session, "_WRITTEN", [])
    table = session.written(spark.range(3), "some")
    path = session._WRITTEN[0][1].removeprefix("file:")
    assert table.count() == 3 and os.path.isdir(path)
    session.drop_written()
    assert not os.path.exists(path) and session._WRITTEN == []
    session.drop_written()
