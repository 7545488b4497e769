"""The shared folder: named by the session, by the caller, or (local masters only) a folder of the process."""

import os
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import os
from martlet.session import local_session, shared_folder
from martlet.sources.tables import write_table
spark = local_session(1, "plain"{shared})
folder = shared_folder(spark)
assert folder == shared_folder(spark.newSession()), "one folder per process"
assert os.path.isdir(folder)
assert write_table(spark.range(3), folder + "/table").count() == 3
print("folder", folder)
"""


def run_with_empty_conf(tmp_path, shared: str) -> str:
    conf = tmp_path / "conf"
    conf.mkdir()
    env = os.environ | {"SPARK_CONF_DIR": str(conf), "PYTHONPATH": REPO, "TMPDIR": str(tmp_path)}
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(shared=shared)], env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    return done.stdout.split("folder ")[-1].strip()


def test_a_local_session_without_settings_has_a_folder(tmp_path):
    assert run_with_empty_conf(tmp_path, "").startswith(str(tmp_path))


def test_the_callers_folder_wins(tmp_path):
    folder = tmp_path / "mine"
    folder.mkdir()
    assert run_with_empty_conf(tmp_path, f", shared={str(folder)!r}") == str(folder)


def test_the_fixture_names_a_folder(spark):
    assert spark.conf.get("spark.checkpoint.dir")
    with pytest.raises(Exception, match="CANNOT_MODIFY_CONFIG"):
        spark.conf.set("spark.checkpoint.dir", "/elsewhere")
