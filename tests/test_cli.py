from conftest import YEAR, put_raw

from coinweir.__main__ import arguments, run


def test_build_sql_and_health(spark, layout, capsys):
    for body in YEAR:
        put_raw(layout, body)
    base = layout.base
    assert run(spark, arguments([base, "health"])) == 1
    assert run(spark, arguments([base, "build", "--full-refresh"])) == 0
    assert run(spark, arguments([base, "sql"])) == 0
    shown = capsys.readouterr().out
    assert shown.index("2026-03-01T00:00:00") and "Cinema" in shown and "40.02" in shown
    assert run(spark, arguments([base, "sql", "select count(*) as n from staging"])) == 0
    assert "|12 " in capsys.readouterr().out


def test_ingest_and_health(spark, layout, tmp_path, capsys):
    folder = tmp_path / "pulled"
    folder.mkdir()
    assert run(spark, arguments([layout.base, "ingest", str(folder), "--source", "reconciliation"])) == 0
    assert run(spark, arguments([layout.base, "health"])) == 1
    assert "heartbeat: alive" in capsys.readouterr().out


def test_watch(spark, layout):
    for body in YEAR:
        put_raw(layout, body)
    assert run(spark, arguments([layout.base, "watch"])) == 0
    assert run(spark, arguments([layout.base, "sql"])) == 0
