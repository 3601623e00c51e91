"""The spark-submit entry points, end to end on a small derived folder."""

from tripdemand.cli import _parser


def test_parser_accepts_every_command():
    p = _parser()
    assert p.parse_args(["batch", "--input", "i", "--warehouse", "w", "--zones", "z"]).command == "batch"
    assert p.parse_args(["stats", "--warehouse", "w"]).command == "stats"
    assert p.parse_args(["live", "--warehouse", "w", "--zones", "z", "--date", "2017-07-06",
                         "--checkpoint", "c", "--text-folder", "t"]).command == "live"
    assert p.parse_args(["replay", "--input", "i", "--date", "2024-02-01", "--output", "o"]).command == "replay"
    assert p.parse_args(["report", "overlay", "--warehouse", "w", "--borough", "Queens",
                         "--date", "2017-07-06"]).kind == "overlay"


def test_batch_and_report_commands(spark, tmp_dir):
    """`batch` then `report historical` as separate spark-submit style runs."""
    import os
    import subprocess
    import sys

    from tests.conftest import SF0001
    from tripdemand.plans import fixtures as fx

    ev = fx.table(spark, SF0001, "events")
    fx.write_trip_files(spark, f"{tmp_dir}/in", "yellow_zone", fx.zone_coded_header(),
                        fx.zone_lines(ev, keep_id=True))
    (fx.zones(spark, SF0001)
     .selectExpr("zone_code AS LocationID", "borough_name AS Borough", "'z' AS Zone",
                 "'s' AS service_zone")
     .write.option("header", True).csv(f"{tmp_dir}/zones"))
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, PYTHONPATH=repo)
    run = lambda *args: subprocess.run([sys.executable, "-m", "tripdemand.cli", *args],
                                       capture_output=True, text=True, env=env, timeout=600)
    r = run("batch", "--input", f"{tmp_dir}/in", "--warehouse", f"{tmp_dir}/wh",
            "--zones", f"{tmp_dir}/zones")
    assert r.returncode == 0, r.stderr[-2000:]
    r = run("report", "historical", "--warehouse", f"{tmp_dir}/wh", "--borough", "AMERICA",
            "--date", "2024-01-04")
    assert r.returncode == 0, r.stderr[-2000:]
    header = [line for line in r.stdout.splitlines() if "label" in line]
    assert header and "mean" in header[0]
    assert any(line.startswith("|") and ":" in line for line in r.stdout.splitlines()[2:])

    fx.zone_lines(ev).write.text(f"{tmp_dir}/stream")
    r = run("live", "--warehouse", f"{tmp_dir}/wh", "--zones", f"{tmp_dir}/zones",
            "--date", "2024-01-04", "--checkpoint", f"{tmp_dir}/ckpt",
            "--text-folder", f"{tmp_dir}/stream", "--available-now")
    assert r.returncode == 0, r.stderr[-2000:]
    r = run("report", "live", "--warehouse", f"{tmp_dir}/wh", "--borough", "AMERICA")
    assert r.returncode == 0 and "actual_trips" in r.stdout, r.stderr[-2000:]
