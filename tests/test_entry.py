"""The driver's entry points, with and without the optional part."""

import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__

ROOT = Path(__file__).parent.parent


def test_entry(spark):
    rows = __spark_entry__.entry(spark).collect()
    assert [r.kind for r in rows].count("missing") == 1 and sum(r.n for r in rows) > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_without_the_optional_part(tmp_path):
    for name in ("waymark", "__spark_entry__.py"):
        (shutil.copytree if (ROOT / name).is_dir() else shutil.copy)(ROOT / name, tmp_path / name)
    shutil.rmtree(tmp_path / "waymark" / "llm", ignore_errors=True)
    code = "import sys, __spark_entry__ as e; assert e.queries() and e.oracle_sql(); assert not [m for m in sys.modules if m.startswith('waymark.llm')]; assert 'pipeline' not in e.queries()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin"}, timeout=120)
