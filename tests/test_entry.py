"""The driver contract, and the independence of the core from the optional subpackage."""

import os
import subprocess
import sys

import __spark_entry__ as driver

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_flagship_has_rows(spark):
    out = driver.entry(spark)
    assert out.columns == ["user_id", "event_id", "ts", "event_type"] and out.count() > 0


def test_names_match():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_core_imports_without_the_optional_parts(tmp_path):
    for name in ("__spark_entry__.py", "bench.py", "quarry"):
        subprocess.run(["cp", "-r", f"{ROOT}/{name}", str(tmp_path)], check=True)
    subprocess.run(["rm", "-rf", str(tmp_path / "quarry/llm")], check=True)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(q.startswith('op') or q == 'pipeline' for q in e.queries()))"
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"}).stdout.split()
    assert int(said[0]) >= 50 and said[2] == "False"


def test_core_never_imports_the_optional_parts():
    for folder, _, names in os.walk(f"{ROOT}/quarry"):
        if os.path.basename(folder) != "llm":
            for name in names:
                if name.endswith(".py"):
                    with open(f"{folder}/{name}", encoding="utf-8") as f:
                        assert "quarry.llm" not in f.read(), f"{folder}/{name}"
