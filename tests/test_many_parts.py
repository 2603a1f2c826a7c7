"""Where parts are many, lines that have met them are written before they are exchanged by caption, and that table goes."""

import os

from tessera.plans import adapters


def test_lines_that_met_many_parts_are_written_once(spark, sf, monkeypatch):
    rows = lambda: sorted(tuple(r) for r in adapters.lines(spark, sf).collect())
    few, paths, write = rows(), [], adapters.written
    monkeypatch.setattr(adapters, "DIMENSION_ROWS", 10)
    monkeypatch.setattr(adapters, "written", lambda df, *name: paths.extend((out := write(df, *name)).inputFiles()) or out)
    assert rows() == few
    assert paths and not any(os.path.exists(p.removeprefix("file://")) for p in paths)
