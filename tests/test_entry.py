import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).parent.parent


@pytest.mark.parametrize("missing", ["public_tokenizers", "xxhash", "corpus_pipeline", "cloudtally.llm"])
def test_other_queries_stay_without_the_text_part(missing):
    code = f"""
import sys
sys.modules[{missing!r}] = None
import __spark_entry__ as entry
names = set(entry.queries())
assert len(names) > 100 and set(entry.oracle_sql()) <= names
assert not any(n.startswith("op") and n[2].isdigit() or n == "pipeline" for n in names)
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]


def test_other_missing_modules_fail():
    code = "import sys\nsys.modules['cloudtally.plans'] = None\nimport __spark_entry__"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert done.returncode != 0 and "cloudtally.plans" in done.stderr
