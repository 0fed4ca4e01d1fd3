"""The driver entry with and without the folders that the driver deletes."""

import pathlib
import shutil
import subprocess
import sys

import __spark_entry__ as entry

ROOT = pathlib.Path(entry.__file__).parent


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_imports_without_the_llm_folders(tmp_path):
    for name in ("__spark_entry__.py", "chunkloom", "querybook"):
        source = ROOT / name
        if source.is_dir():
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(source, tmp_path / name)
    code = "import __spark_entry__ as e; print(len(e.queries()), sorted(set(e.queries()) - set(e.oracle_sql())))"
    ran = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    import querybook

    assert ran.stdout.split(maxsplit=1)[0] == str(len(querybook.queries()))
