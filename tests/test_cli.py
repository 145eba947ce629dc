"""The command line runs a report job end to end in its own process."""

import json
import os
import subprocess
import sys
import tempfile

from conftest import ROOT

LOG = (
    "17/01/24 17:00:28 INFO A: application_1485248649253_0001 start\n"
    "17/01/24 17:05:00 WARN B: application_1485248649253_0001 x\n"
    "  at frame\n"
    "17/01/24 17:09:00 ERROR C: application_1485248649253_0001 end\n"
)


def _tree():
    d = tempfile.mkdtemp(prefix="lograft-cli-", dir="/tmp")
    app = os.path.join(d, "logs", "application_1485248649253_0001")
    os.makedirs(app)
    with open(os.path.join(app, "container_1485248649253_0001_01_000001.log"), "w") as fh:
        fh.write(LOG)
    return d


def _run(*args):
    env = dict(os.environ, PYTHONPATH=ROOT)
    return subprocess.run([sys.executable, "-m", "lograft", *args, "--master", "local[2]"],
                          capture_output=True, text=True, env=env, timeout=300, check=True)


def test_cli_levels_and_grep():
    d = _tree()
    env = dict(os.environ, PYTHONPATH=ROOT)
    out = subprocess.run(
        [sys.executable, "-m", "lograft", "levels", "--input", os.path.join(d, "logs"), "--output",
         os.path.join(d, "out"), "--master", "local[2]", "--checkpoint-dir", os.path.join(d, "ckpt")],
        capture_output=True, text=True, env=env, timeout=300, check=True,
    )
    res = json.loads(out.stdout)
    assert res["total_lines"] == 4 and res["lines_with_level"] == 3
    assert sorted(res["counts"]) == [["ERROR", 1], ["INFO", 1], ["WARN", 1]]

    _run("grep", "--input", os.path.join(d, "logs"), "--output", os.path.join(d, "grep"), "--pattern", "WARN|ERROR")
    import csv
    import glob

    rows = [r for f in glob.glob(os.path.join(d, "grep", "*.csv")) for r in csv.DictReader(open(f))]
    assert sorted(r["line"].split()[2] for r in rows) == ["ERROR", "WARN"]


def test_cli_stage_then_levels():
    d = _tree()
    _run("stage", "--input", os.path.join(d, "logs"), "--output", os.path.join(d, "parsed"))
    out = _run("levels", "--input", os.path.join(d, "parsed"), "--parsed", "--output", os.path.join(d, "out"),
               "--checkpoint-dir", os.path.join(d, "ckpt"))
    res = json.loads(out.stdout)
    assert res["total_lines"] == 4 and sorted(res["counts"]) == [["ERROR", 1], ["INFO", 1], ["WARN", 1]]
